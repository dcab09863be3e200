"""The driver's tables seen as a citation graph, as typed entity DataFrames and as SQL.

Regions are journals, nations their volumes, customers issues, orders articles,
parts books that articles cite by line items, suppliers authors. Every fourth
article cites another one, every third book has an author of its own, who may
be one of those that cite it. Both sides build the same rows, so that every
query over the entities can be compared.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.schema import BASE, FABIO


def iri(kind: str, prefix: str, number: Column) -> Column:
    """base + class + "/" + supplier prefix + number."""
    return F.concat(F.lit(f"{BASE}{kind}/{prefix}"), number.cast("string"))


class Corpus:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def size(self) -> int:
        """Rows of the largest table; how far joins are spread depends on it."""
        return self.table("lineitem").count()

    @cached_property
    def journal(self) -> DataFrame:
        t = self.table("region")
        return t.select(iri("br", "010", F.col("r_regionkey") + 1).alias("iri"), F.lit("Journal").alias("type"), F.col("r_name").alias("title"), F.lit(None).cast("string").alias("subtitle"), F.lit(None).cast("string").alias("pub_date"), F.lit(None).cast("string").alias("seq_id"), F.lit(None).cast("string").alias("part_of"))

    @cached_property
    def volume(self) -> DataFrame:
        t = self.table("nation")
        return t.select(iri("br", "020", F.col("n_nationkey") + 1).alias("iri"), F.lit("JournalVolume").alias("type"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("subtitle"), F.lit(None).cast("string").alias("pub_date"), F.col("n_nationkey").cast("string").alias("seq_id"), iri("br", "010", F.col("n_regionkey") + 1).alias("part_of"))

    @cached_property
    def issue(self) -> DataFrame:
        t = self.table("customer")
        return t.select(iri("br", "030", F.col("c_custkey") + 1).alias("iri"), F.lit("JournalIssue").alias("type"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("subtitle"), F.lit(None).cast("string").alias("pub_date"), F.col("c_custkey").cast("string").alias("seq_id"), iri("br", "020", F.col("c_nationkey") + 1).alias("part_of"))

    @cached_property
    def article(self) -> DataFrame:
        t, k = self.table("orders"), F.col("o_orderkey")
        title = F.when(k % 5 != 0, F.concat(F.lit("Study "), k.cast("string"), F.lit(" of "), F.col("o_orderpriority")))
        date = tx.pub_date(F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")))
        return t.select(iri("br", "040", k + 1).alias("iri"), F.lit("JournalArticle").alias("type"), title.alias("title"), F.lit(None).cast("string").alias("subtitle"), date.alias("pub_date"), F.lit(None).cast("string").alias("seq_id"), iri("br", "030", F.col("o_custkey") + 1).alias("part_of"))

    @cached_property
    def book(self) -> DataFrame:
        t = self.table("part")
        return t.select(iri("br", "050", F.col("p_partkey") + 1).alias("iri"), F.lit("Book").alias("type"), F.col("p_name").alias("title"), F.col("p_type").alias("subtitle"), F.lit(None).cast("string").alias("pub_date"), F.lit(None).cast("string").alias("seq_id"), F.lit(None).cast("string").alias("part_of"))

    @cached_property
    def br(self) -> DataFrame:
        return self.journal.union(self.volume).union(self.issue).union(self.article).union(self.book)

    @cached_property
    def embodiment(self) -> DataFrame:
        """Pages of the articles whose number is even."""
        t, k = self.table("orders"), F.col("o_orderkey")
        pages = F.concat((k % 900 + 1).cast("string"), F.lit("-"), (k % 900 + 9).cast("string"))
        return t.filter(k % 2 == 0).select(iri("br", "040", k + 1).alias("br"), tx.first_page(pages).alias("start"), tx.last_page(pages).alias("end"))

    @cached_property
    def cites(self) -> DataFrame:
        """Books by the articles of the lines that name them; every fourth article also cites the article of half its number."""
        t, k = self.table("lineitem").select("l_orderkey", "l_partkey").distinct(), F.col("o_orderkey")
        books = t.select(iri("br", "040", F.col("l_orderkey") + 1).alias("citing"), iri("br", "050", F.col("l_partkey") + 1).alias("cited"))
        articles = self.table("orders").filter((k % 4 == 0) & (k > 0))
        return books.unionByName(articles.select(iri("br", "040", k + 1).alias("citing"), iri("br", "040", F.floor(k / 2) + 1).alias("cited")))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with their place in the order, by a total order."""
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
        return self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", F.row_number().over(order).alias("pos"))

    @cached_property
    def role(self) -> DataFrame:
        """The chain of author roles of each article, one role for each line; and the one author of every third book, its least supplier."""
        number = (F.col("l_orderkey") + 1) * 1000 + F.col("pos")
        chain = Window.partitionBy("l_orderkey").orderBy("pos")
        r = self.lines.select("*", iri("ar", "060", number).alias("iri"))
        articles = r.select("iri", F.lit("author").alias("role"), iri("br", "040", F.col("l_orderkey") + 1).alias("br"), iri("ra", "070", F.col("l_suppkey") + 1).alias("ra"), "pos", F.lead("iri").over(chain).alias("next"))
        k = F.col("l_partkey")
        books = self.table("lineitem").filter(k % 3 == 0).groupBy("l_partkey").agg(F.min("l_suppkey").alias("s"))
        return articles.unionByName(books.select(iri("ar", "0160", k + 1).alias("iri"), F.lit("author").alias("role"), iri("br", "050", k + 1).alias("br"), iri("ra", "070", F.col("s") + 1).alias("ra"), F.lit(1).alias("pos"), F.lit(None).cast("string").alias("next")))

    @cached_property
    def agent(self) -> DataFrame:
        t = self.table("supplier")
        return t.select(iri("ra", "070", F.col("s_suppkey") + 1).alias("iri"), F.concat(F.lit("A"), F.col("s_nationkey").cast("string")).alias("given"), F.col("s_name").alias("family"))

    @cached_property
    def ident(self) -> DataFrame:
        """Identifier entities: iri, owner, scheme, literal."""
        parts = [
            ("orders", "o_orderkey", "040", "0810", "br", "doi", F.concat(F.lit("10.1234/"), F.col("o_orderkey").cast("string"))),
            ("region", "r_regionkey", "010", "0820", "br", "issn", F.col("r_name")),
            ("part", "p_partkey", "050", "0830", "br", "isbn", F.concat(F.lit("978-"), F.col("p_partkey").cast("string"))),
            ("supplier", "s_suppkey", "070", "0840", "ra", "orcid", F.concat(F.lit("0000-"), F.col("s_suppkey").cast("string"))),
        ]
        out = None
        for name, key, owner, prefix, kind, scheme, literal in parts:
            one = self.table(name).select(iri("id", prefix, F.col(key) + 1).alias("iri"), iri(kind, owner, F.col(key) + 1).alias("owner"), F.lit(scheme).alias("scheme"), literal.alias("literal"))
            out = one if out is None else out.union(one)
        return out

    @cached_property
    def pointer(self) -> DataFrame:
        """In-text pointers: iri, entry, article, book, and the list, sentence, paragraph and section they stand in; list is null for those outside of one.

        Two line numbers make a sentence, four a paragraph, six a section.
        """
        o, n = F.col("l_orderkey") + 1, F.col("l_linenumber")
        sentence = F.floor((n + 1) / 2)
        listed = F.when(F.col("l_returnflag") != "N", iri("pl", "0150", o * 100 + sentence * 2 + (F.col("l_linestatus") == "F").cast("int")))
        return self.lines.select(
            iri("rp", "090", o * 1000 + F.col("pos")).alias("iri"),
            iri("be", "0110", o * 1_000_000 + F.col("l_partkey")).alias("entry"),
            iri("br", "040", o).alias("article"),
            iri("br", "050", F.col("l_partkey") + 1).alias("book"),
            listed.alias("list"),
            iri("de", "0120", o * 10 + sentence).alias("sentence"),
            iri("de", "0130", o * 10 + F.floor((n + 3) / 4)).alias("paragraph"),
            iri("de", "0140", o * 10 + F.floor((n + 5) / 6)).alias("section"),
            "pos",
        )

    @cached_property
    def discourse(self) -> DataFrame:
        """Discourse elements: iri, class, parent, title."""
        p = self.pointer
        none = F.lit(None).cast("string")
        number = F.concat(F.lit("Section "), F.substring("section", -1, 1))
        return (
            p.select(F.col("section").alias("iri"), F.lit("Section").alias("class"), F.col("article").alias("parent"), number.alias("title"))
            .union(p.select("paragraph", F.lit("Paragraph"), "section", none))
            .union(p.select("sentence", F.lit("Sentence"), "paragraph", none))
            .distinct()
        )


class Faulty(Corpus):
    """The corpus with a fault planted for each consistency check; ``FAULTS`` is its SQL."""

    @cached_property
    def journal(self) -> DataFrame:
        return Corpus(self.spark, self.sf_dir).journal

    @cached_property
    def volume(self) -> DataFrame:
        """One number twice in a journal, volumes of no journal, and of one that is none."""
        n = F.col("seq_id").try_cast("int")
        v = Corpus(self.spark, self.sf_dir).volume
        return v.withColumns({"seq_id": F.when(n == 7, F.lit("2")).otherwise(F.col("seq_id")), "part_of": F.when(n % 5 == 4, F.lit(None)).when(n == 6, F.lit(f"{BASE}br/020999")).otherwise(F.col("part_of"))})

    @cached_property
    def issue(self) -> DataFrame:
        """Numbers that two issues share, issues of no volume, and a volume that has none."""
        n = F.col("seq_id").try_cast("int")
        i = Corpus(self.spark, self.sf_dir).issue
        return i.withColumns({"seq_id": F.floor(n / 40).cast("string"), "part_of": F.when((n % 100 == 77) | (F.col("part_of") == f"{BASE}br/0206"), F.lit(None)).otherwise(F.col("part_of"))})

    @cached_property
    def article(self) -> DataFrame:
        """None in the issues whose number ends in 8."""
        a = Corpus(self.spark, self.sf_dir).article
        return a.withColumn("part_of", F.when(F.col("part_of").endswith("8"), F.lit(None)).otherwise(F.col("part_of")))

    @cached_property
    def book(self) -> DataFrame:
        """Every fifth is a chapter, of another book, of a journal, or of nothing."""
        n = F.regexp_extract("iri", "/050([0-9]+)$", 1).try_cast("int")
        b = Corpus(self.spark, self.sf_dir).book
        whole = F.when(n % 15 == 0, F.lit(None)).when(n % 20 == 0, F.lit(f"{BASE}br/0102")).otherwise(F.concat(F.lit(f"{BASE}br/050"), (n + 1).cast("string")))
        return b.withColumns({"type": F.when(n % 5 == 0, "BookChapter").otherwise("Book"), "part_of": F.when(n % 5 == 0, whole)})

    @cached_property
    def cites(self) -> DataFrame:
        """Nothing cites the books whose number ends in 7."""
        return Corpus(self.spark, self.sf_dir).cites.filter(~F.col("cited").rlike("/050[0-9]*7$"))

    @cached_property
    def ident(self) -> DataFrame:
        """Literals of two entities and owners, and works that have none."""
        i = Corpus(self.spark, self.sf_dir).ident
        again = i.filter("right(iri, 2) = '07' OR right(iri, 5) = '08202'").select(F.concat("iri", F.lit("9")).alias("iri"), F.concat("owner", F.lit("9")).alias("owner"), "scheme", "literal")
        return i.filter("right(owner, 1) <> '3'").unionByName(again)


def type_iri(c: Column) -> Column:
    return F.concat(F.lit(FABIO), c)


#: The same entities for DuckDB; queries go on after it.
PREFIX = f"""
WITH journal AS (SELECT '{BASE}br/010' || (r_regionkey + 1) AS iri, 'Journal' AS type, r_name AS title, NULL::VARCHAR AS subtitle, NULL::VARCHAR AS pub_date, NULL::VARCHAR AS seq_id, NULL::VARCHAR AS part_of FROM region),
volume AS (SELECT '{BASE}br/020' || (n_nationkey + 1) AS iri, 'JournalVolume' AS type, NULL::VARCHAR AS title, NULL::VARCHAR AS subtitle, NULL::VARCHAR AS pub_date, n_nationkey::VARCHAR AS seq_id, '{BASE}br/010' || (n_regionkey + 1) AS part_of FROM nation),
issue AS (SELECT '{BASE}br/030' || (c_custkey + 1) AS iri, 'JournalIssue' AS type, NULL::VARCHAR AS title, NULL::VARCHAR AS subtitle, NULL::VARCHAR AS pub_date, c_custkey::VARCHAR AS seq_id, '{BASE}br/020' || (c_nationkey + 1) AS part_of FROM customer),
article AS (SELECT '{BASE}br/040' || (o_orderkey + 1) AS iri, 'JournalArticle' AS type, CASE WHEN o_orderkey % 5 <> 0 THEN 'Study ' || o_orderkey || ' of ' || o_orderpriority END AS title, NULL::VARCHAR AS subtitle,
  CASE WHEN month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS pub_date, NULL::VARCHAR AS seq_id, '{BASE}br/030' || (o_custkey + 1) AS part_of FROM orders),
book AS (SELECT '{BASE}br/050' || (p_partkey + 1) AS iri, 'Book' AS type, p_name AS title, p_type AS subtitle, NULL::VARCHAR AS pub_date, NULL::VARCHAR AS seq_id, NULL::VARCHAR AS part_of FROM part),
br AS (SELECT * FROM journal UNION ALL SELECT * FROM volume UNION ALL SELECT * FROM issue UNION ALL SELECT * FROM article UNION ALL SELECT * FROM book),
embodiment AS (SELECT '{BASE}br/040' || (o_orderkey + 1) AS br, (o_orderkey % 900 + 1)::VARCHAR AS start, (o_orderkey % 900 + 9)::VARCHAR AS "end" FROM orders WHERE o_orderkey % 2 = 0),
cites AS (SELECT DISTINCT '{BASE}br/040' || (l_orderkey + 1) AS citing, '{BASE}br/050' || (l_partkey + 1) AS cited FROM lineitem
  UNION ALL SELECT '{BASE}br/040' || (o_orderkey + 1), '{BASE}br/040' || (o_orderkey // 2 + 1) FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey > 0),
lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)::INT AS pos FROM lineitem),
role AS (SELECT '{BASE}ar/060' || ((l_orderkey + 1) * 1000 + pos) AS iri, 'author' AS role, '{BASE}br/040' || (l_orderkey + 1) AS br, '{BASE}ra/070' || (l_suppkey + 1) AS ra, pos,
  lead('{BASE}ar/060' || ((l_orderkey + 1) * 1000 + pos)) OVER (PARTITION BY l_orderkey ORDER BY pos) AS next FROM lines
  UNION ALL SELECT '{BASE}ar/0160' || (l_partkey + 1), 'author', '{BASE}br/050' || (l_partkey + 1), '{BASE}ra/070' || (min(l_suppkey) + 1), 1, NULL FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY l_partkey),
agent AS (SELECT '{BASE}ra/070' || (s_suppkey + 1) AS iri, 'A' || s_nationkey AS given, s_name AS family FROM supplier),
ident AS (SELECT '{BASE}id/0810' || (o_orderkey + 1) AS iri, '{BASE}br/040' || (o_orderkey + 1) AS owner, 'doi' AS scheme, '10.1234/' || o_orderkey AS literal FROM orders
  UNION ALL SELECT '{BASE}id/0820' || (r_regionkey + 1), '{BASE}br/010' || (r_regionkey + 1), 'issn', r_name FROM region
  UNION ALL SELECT '{BASE}id/0830' || (p_partkey + 1), '{BASE}br/050' || (p_partkey + 1), 'isbn', '978-' || p_partkey FROM part
  UNION ALL SELECT '{BASE}id/0840' || (s_suppkey + 1), '{BASE}ra/070' || (s_suppkey + 1), 'orcid', '0000-' || s_suppkey FROM supplier),
pointer AS (SELECT '{BASE}rp/090' || ((l_orderkey + 1) * 1000 + pos) AS iri, '{BASE}be/0110' || ((l_orderkey + 1) * 1000000 + l_partkey) AS entry, '{BASE}br/040' || (l_orderkey + 1) AS article, '{BASE}br/050' || (l_partkey + 1) AS book,
  CASE WHEN l_returnflag <> 'N' THEN '{BASE}pl/0150' || ((l_orderkey + 1) * 100 + (l_linenumber + 1) // 2 * 2 + (l_linestatus = 'F')::INT) END AS list,
  '{BASE}de/0120' || ((l_orderkey + 1) * 10 + (l_linenumber + 1) // 2) AS sentence, '{BASE}de/0130' || ((l_orderkey + 1) * 10 + (l_linenumber + 3) // 4) AS paragraph, '{BASE}de/0140' || ((l_orderkey + 1) * 10 + (l_linenumber + 5) // 6) AS section, pos FROM lines),
discourse AS (SELECT DISTINCT * FROM (SELECT section AS iri, 'Section' AS class, article AS parent, 'Section ' || right(section, 1) AS title FROM pointer UNION ALL SELECT paragraph, 'Paragraph', section, NULL FROM pointer UNION ALL SELECT sentence, 'Sentence', paragraph, NULL FROM pointer))
"""

#: The same faults; the names of the entities are theirs with a 2.
FAULTS = PREFIX + f""",
journal2 AS (SELECT * FROM journal),
volume2 AS (SELECT iri, type, title, subtitle, pub_date, CASE WHEN seq_id = '7' THEN '2' ELSE seq_id END AS seq_id, CASE WHEN CAST(seq_id AS INT) % 5 = 4 THEN NULL WHEN seq_id = '6' THEN '{BASE}br/020999' ELSE part_of END AS part_of FROM volume),
issue2 AS (SELECT iri, type, title, subtitle, pub_date, '' || (CAST(seq_id AS INT) // 40) AS seq_id, CASE WHEN CAST(seq_id AS INT) % 100 = 77 OR part_of = '{BASE}br/0206' THEN NULL ELSE part_of END AS part_of FROM issue),
article2 AS (SELECT iri, type, title, subtitle, pub_date, seq_id, CASE WHEN right(part_of, 1) = '8' THEN NULL ELSE part_of END AS part_of FROM article),
book2 AS (SELECT iri, CASE WHEN n % 5 = 0 THEN 'BookChapter' ELSE 'Book' END AS type, title, subtitle, pub_date, seq_id, CASE WHEN n % 5 <> 0 OR n % 15 = 0 THEN NULL WHEN n % 20 = 0 THEN '{BASE}br/0102' ELSE '{BASE}br/050' || (n + 1) END AS part_of FROM (SELECT *, CAST(regexp_extract(iri, '/050([0-9]+)$', 1) AS INT) AS n FROM book)),
br2 AS (SELECT * FROM journal2 UNION ALL SELECT * FROM volume2 UNION ALL SELECT * FROM issue2 UNION ALL SELECT * FROM article2 UNION ALL SELECT * FROM book2),
cites2 AS (SELECT * FROM cites WHERE NOT regexp_matches(cited, '/050[0-9]*7$')),
ident2 AS (SELECT * FROM ident WHERE right(owner, 1) <> '3' UNION ALL SELECT iri || '9', owner || '9', scheme, literal FROM ident WHERE right(iri, 2) = '07' OR right(iri, 5) = '08202')
"""
