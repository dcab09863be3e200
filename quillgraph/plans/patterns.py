"""Queries of graph patterns, aggregates and scalar functions over the corpus, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import algebra as al
from quillgraph.plans.corpus import PREFIX, Corpus
from quillgraph.schema import BASE

QUERIES, SQL = {}, {}


def query(sql: str | None = None, corpus: bool = True):
    """Registers a query under its name; ``sql`` goes on after the entities' definition."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Corpus(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PREFIX + sql if corpus else sql
        return f

    return put


@query("SELECT a.iri AS article, i.iri AS issue, i.seq_id AS number FROM article a JOIN issue i ON a.part_of = i.iri")
def bgp_article_in_issue(c):
    """[QA-01]"""
    a, i = c.article.select(F.col("iri").alias("article"), F.col("part_of").alias("issue")), c.issue.select("iri", F.col("seq_id").alias("number"))
    return al.bgp(a, i, {"issue": "iri"})


@query("SELECT br.iri, coalesce(t.title, 'No title available') AS title, d.literal AS doi FROM br LEFT JOIN (SELECT iri, title FROM br WHERE title IS NOT NULL) t USING (iri) LEFT JOIN (SELECT * FROM ident WHERE scheme = 'doi') d ON d.owner = br.iri")
def optional_title(c):
    """[QA-02, QA-07]"""
    titles = c.br.select(F.col("iri").alias("k"), "title").filter(F.col("title").isNotNull())
    dois = c.ident.filter("scheme = 'doi'").select("owner", F.col("literal").alias("doi"))
    out = al.optional(al.optional(c.br.select("iri"), titles, {"iri": "k"}), dois, {"iri": "owner"})
    return out.select("iri", F.coalesce("title", F.lit("No title available")).alias("title"), "doi")


@query("SELECT iri, title AS text FROM br WHERE title IS NOT NULL UNION ALL SELECT iri, subtitle FROM br WHERE subtitle IS NOT NULL")
def union_title_subtitle(c):
    """[QA-03]"""
    return c.br.filter("title IS NOT NULL").select("iri", F.col("title").alias("text")).unionByName(c.br.filter("subtitle IS NOT NULL").select("iri", F.col("subtitle").alias("text")))


@query("SELECT b.iri, b.title FROM br b WHERE b.type IN ('Book', 'JournalArticle') AND NOT EXISTS (SELECT 1 FROM cites WHERE cited = b.iri)")
def not_exists_uncited(c):
    """[QA-04, CC-22]"""
    return al.not_exists(c.br.filter("type IN ('Book', 'JournalArticle')").select("iri", "title"), c.cites, {"iri": "cited"})


@query("SELECT DISTINCT a.book AS book, b.book AS other FROM pointer a JOIN pointer b ON a.list = b.list AND a.book < b.book WHERE a.book <> b.book")
def filter_neq_selfjoin(c):
    """[QA-05] Books that are pointed to from one list."""
    p = c.pointer.filter("list IS NOT NULL").select("list", "book").distinct()
    a, b = p.alias("a"), p.alias("b")
    return a.join(b, (F.col("a.list") == F.col("b.list")) & (F.col("a.book") < F.col("b.book"))).select(F.col("a.book").alias("book"), F.col("b.book").alias("other")).distinct()


@query(f"SELECT iri, type, NOT starts_with(type, 'Journal') AS other FROM br WHERE starts_with(iri, '{BASE}br/0')")
def strstarts(c):
    """[QA-06]"""
    return c.br.filter(F.col("iri").startswith(f"{BASE}br/0")).select("iri", "type", (~F.col("type").startswith("Journal")).alias("other"))


@query("SELECT owner, literal FROM ident WHERE scheme = 'doi' AND literal IN ('10.1234/1', '10.1234/7', '10.1234/none')")
def values_lookup(c):
    """[QA-08]"""
    wanted = al.values(c.spark, "literal", ["10.1234/1", "10.1234/7", "10.1234/none"])
    return c.ident.filter("scheme = 'doi'").join(F.broadcast(wanted), "literal").select("owner", "literal")


@query("SELECT b.iri, b.title, coalesce(n, 0) AS citations FROM book b LEFT JOIN (SELECT cited, count(*) AS n FROM cites GROUP BY cited) c ON c.cited = b.iri")
def subselect_counts(c):
    """[QA-09]"""
    counts = c.cites.groupBy("cited").agg(F.count("*").alias("n"))
    return al.optional(c.book.select("iri", "title"), counts, {"iri": "cited"}).select("iri", "title", F.coalesce("n", F.lit(0)).alias("citations"))


def part_of(c, *kinds):
    out = None
    for k in kinds or ("volume", "issue", "article"):
        one = getattr(c, k).select(F.col("iri").alias("src"), F.col("part_of").alias("dst"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT a.iri AS src, v.part_of AS dst FROM article a JOIN issue i ON a.part_of = i.iri JOIN volume v ON i.part_of = v.iri")
def path_sequence(c):
    """[QA-11] The journal of each article, over issue and volume."""
    return al.sequence(al.sequence(part_of(c, "article"), part_of(c, "issue")), part_of(c, "volume"))


@query("SELECT dst AS src, src AS dst, n FROM (SELECT part_of AS dst, iri AS src, count(*) AS n FROM volume GROUP BY ALL)")
def path_inverse(c):
    """[QA-10]"""
    return al.inverse(part_of(c, "volume")).groupBy("src", "dst").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT src, dst FROM (SELECT sentence AS src, iri AS dst FROM pointer WHERE list IS NULL UNION ALL SELECT s.sentence, e.iri FROM (SELECT DISTINCT sentence, list FROM pointer WHERE list IS NOT NULL) s JOIN pointer e ON e.list = s.list)")
def path_alternative(c):
    """[QA-12] Pointers in the context of a sentence: by a list, or directly."""
    return al.alternative(al.sequence(context(c), element(c)), context(c).join(c.pointer.select(F.col("iri").alias("dst")), "dst", "left_semi")).distinct()


def context(c):
    """Edges from a sentence to the lists and to the pointers outside of lists in it."""
    return c.pointer.select(F.col("sentence").alias("src"), F.coalesce("list", "iri").alias("dst")).distinct()


def element(c):
    """Edges from a list to its pointers."""
    return c.pointer.filter("list IS NOT NULL").select(F.col("list").alias("src"), F.col("iri").alias("dst"))


PART_OF_SQL = "edges AS (SELECT iri AS src, part_of AS dst FROM volume UNION ALL SELECT iri, part_of FROM issue UNION ALL SELECT iri, part_of FROM article)"
CLOSED = PREFIX.replace("WITH journal", "WITH RECURSIVE journal") + f", {PART_OF_SQL}, paths AS (SELECT src, dst FROM edges UNION SELECT p.src, e.dst FROM paths p JOIN edges e ON e.src = p.dst)"


@query(f"{CLOSED} SELECT src, dst FROM paths", corpus=False)
def path_plus_ancestors(c):
    """[QA-13]"""
    return al.one_or_more(part_of(c))


@query(f"{CLOSED} SELECT src, dst FROM paths UNION SELECT iri, iri FROM br", corpus=False)
def path_star_chain(c):
    """[QA-14]"""
    return al.zero_or_more(part_of(c), c.br.select(F.col("iri").alias("node")))


@query("SELECT DISTINCT src, dst FROM (SELECT iri AS src, part_of AS dst FROM volume UNION ALL SELECT iri, iri FROM volume UNION ALL SELECT part_of, part_of FROM volume)")
def path_zero_or_one(c):
    """[QA-15]"""
    return al.zero_or_one(part_of(c, "volume"), c.volume.select(F.col("iri").alias("node")))


@query("SELECT o.owner, o.literal, b.title FROM (SELECT owner, literal FROM ident WHERE scheme = 'isbn') o JOIN book b ON b.iri = o.owner")
def anonymous_node(c):
    """[QA-16] The identifier between owner and literal is projected away."""
    return al.bgp(c.ident.filter("scheme = 'isbn'").select("owner", "literal"), c.book.select("iri", "title"), {"owner": "iri"})


@query("SELECT cited, count(*) AS n FROM cites GROUP BY cited ORDER BY n DESC, cited LIMIT 20")
def distinct_order_limit(c):
    """[QA-17]"""
    return c.cites.groupBy("cited").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "cited").limit(20)


# --- aggregates ----------------------------------------------------------------------------------


@query("SELECT r.br, string_agg(a.given || ' ' || a.family, '; ' ORDER BY r.pos) AS authors, count(*) AS n FROM role r JOIN agent a ON a.iri = r.ra GROUP BY r.br")
def group_concat_authors(c):
    """[AG-02, RS-26] Names in order of the role chain."""
    named = c.role.join(c.agent.select(F.col("iri").alias("ra"), F.concat_ws(" ", "given", "family").alias("name")), "ra")
    out = named.groupBy("br").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("all"))
    return out.select("br", F.array_join(F.transform("all", lambda x: x["name"]), "; ").alias("authors"), F.size("all").cast("long").alias("n"))


@query("SELECT book AS cited, count(*) AS mentions, count(DISTINCT article) AS citing FROM pointer GROUP BY book")
def count_distinct_cites(c):
    """[AG-01]"""
    return c.pointer.groupBy(F.col("book").alias("cited")).agg(F.count("*").alias("mentions"), F.countDistinct("article").alias("citing"))


@query("SELECT least(a.ra, b.ra) AS a, greatest(a.ra, b.ra) AS b, count(*) AS n FROM role a JOIN role b ON a.br = b.br AND a.pos < b.pos AND a.ra <> b.ra GROUP BY ALL")
def coauthor_pairs(c):
    """[AG-05] Unordered pairs of authors with the sum of their counts.

    Roles of an article are few, so its pairs are made from its sorted agents.
    """
    agents = c.role.groupBy("br").agg(F.array_sort(F.collect_list(F.struct("pos", "ra"))).alias("all"))
    pairs = agents.select(F.posexplode("all").alias("i", "x"), "all").select(F.col("x.ra").alias("a"), F.explode(F.expr("slice(all, i + 2, size(all))")).alias("y")).select("a", F.col("y.ra").alias("b"))
    return unordered_pairs(pairs.filter("a <> b").withColumn("n", F.lit(1).cast("long")), "a", "b", "n")


def unordered_pairs(df, a: str, b: str, n: str):
    """[AG-05]"""
    return df.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.sum(n).alias("n"))


@query("SELECT cited AS doi_owner, min(citing) AS first FROM cites GROUP BY cited")
def distinct_first_doi(c):
    """[AG-06]"""
    return al.least(c.cites, ["cited"], "citing").select(F.col("cited").alias("doi_owner"), F.col("citing").alias("first"))


@query("SELECT substr(a.pub_date, 1, 4) AS year, (b.iri IS NOT NULL) AS own, count(*) AS n FROM cites JOIN article a ON a.iri = citing LEFT JOIN (SELECT DISTINCT br AS iri FROM role) b ON b.iri = cited GROUP BY ALL")
def cites_per_year(c):
    """[AG-07] By year and by whether the cited work has authors of its own in the corpus."""
    known = c.role.select(F.col("br").alias("cited")).distinct().withColumn("own", F.lit(True))
    rows = al.bgp(c.cites, c.article.select("iri", "pub_date"), {"citing": "iri"}).join(known, "cited", "left")
    return rows.groupBy(F.substring("pub_date", 1, 4).alias("year"), F.coalesce("own", F.lit(False)).alias("own")).agg(F.count("*").alias("n"))


@query("SELECT j.title AS venue, count(DISTINCT c.citing) AS n FROM cites c JOIN article a ON a.iri = c.citing JOIN issue i ON i.iri = a.part_of JOIN volume v ON v.iri = i.part_of JOIN journal j ON j.iri = v.part_of GROUP BY j.title ORDER BY n DESC, venue")
def citing_venues(c):
    """[AG-08]"""
    citing = c.cites.select("citing").distinct()
    venue = path_sequence(c).join(c.journal.select(F.col("iri").alias("dst"), F.col("title").alias("venue")), "dst")
    return citing.join(venue, citing["citing"] == venue["src"]).groupBy("venue").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "venue")


@query("SELECT a.given || ' ' || a.family AS author, count(*) AS n FROM cites c JOIN (SELECT DISTINCT br, ra FROM role) r ON r.br = c.citing JOIN agent a ON a.iri = r.ra GROUP BY author ORDER BY n DESC, author")
def citing_authors(c):
    """[AG-08] From the joined list of names, split again."""
    names = c.role.join(c.agent.select(F.col("iri").alias("ra"), F.concat_ws(" ", "given", "family").alias("name")), "ra").groupBy("br").agg(al.group_concat("name", "; ", distinct=True).alias("authors"))
    rows = c.cites.join(names, c.cites["citing"] == names["br"]).select(F.explode(F.split("authors", "; ")).alias("author"))
    return rows.groupBy("author").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "author")


@query("SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents) GROUP BY term ORDER BY n DESC, term", corpus=False)
def term_census(c):
    """[AG-09, EX-15] Counted per document first, so that little is shuffled for frequent terms."""
    words = c.table("documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("term"))
    per = words.groupBy("term", "doc_id").agg(F.count("*").alias("k"))
    return per.groupBy("term").agg(F.sum("k").alias("n"), F.count("*").alias("docs")).orderBy(F.col("n").desc(), "term")


@query("SELECT article, count(DISTINCT book) AS books, min(section) AS section, string_agg(DISTINCT book, '|' ORDER BY book) AS cited FROM pointer GROUP BY article")
def group_by_concat(c):
    """[AG-04] Keys, a first value, and concatenated columns of what repeats."""
    return c.pointer.groupBy("article").agg(F.countDistinct("book").alias("books"), F.min("section").alias("section"), al.group_concat("book", "|", distinct=True).alias("cited"))


@query("SELECT count(*) AS triples FROM (SELECT DISTINCT s, p, o FROM (SELECT iri AS s, 'type' AS p, type AS o FROM br UNION ALL SELECT iri, 'title', title FROM br WHERE title IS NOT NULL UNION ALL SELECT citing, 'cites', cited FROM cites))")
def distinct_triples(c):
    """[AG-10]"""
    t = c.br.select(F.col("iri").alias("s"), F.lit("type").alias("p"), F.col("type").alias("o")).unionByName(c.br.filter("title IS NOT NULL").select(F.col("iri").alias("s"), F.lit("title").alias("p"), F.col("title").alias("o"))).unionByName(c.cites.select(F.col("citing").alias("s"), F.lit("cites").alias("p"), F.col("cited").alias("o")))
    return t.distinct().agg(F.count("*").alias("triples"))


@query("SELECT l_returnflag AS flag, round(avg(l_quantity), 6) AS mean, round(avg(CASE WHEN l_linestatus = 'F' THEN l_discount END), 6) AS mean_f, count(*) AS n FROM lineitem GROUP BY l_returnflag", corpus=False)
def conditional_means(c):
    """[AG-11]"""
    return c.table("lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(F.round(F.avg("l_quantity"), 6).alias("mean"), F.round(F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_discount"))), 6).alias("mean_f"), F.count("*").alias("n"))


# --- scalar functions ----------------------------------------------------------------------------


def part_text(c):
    k, t = F.col("p_partkey"), c.table("part")
    return t.select("p_partkey", F.when(k % 4 == 0, F.concat(F.lit("no identifier in "), F.col("p_name"))).otherwise(F.concat(F.lit("See DOI: 10."), (k + 1000).cast("string"), F.lit("/ABC%2F"), F.replace("p_name", F.lit(" "), F.lit("+")), F.lit("."), F.lit(" See https://x.example/p?k="), k.cast("string"), F.lit("/. End"))).alias("text"))


PART_TEXT = "WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'no identifier in ' || p_name ELSE 'See DOI: 10.' || (p_partkey + 1000) || '/ABC%2F' || replace(p_name, ' ', '+') || '. See https://x.example/p?k=' || p_partkey || '/. End' END AS text FROM part) "


@query(PART_TEXT + r"SELECT p_partkey, CASE WHEN instr(text, '10.') > 0 THEN trim(lower(regexp_replace(url_decode(substr(text, instr(text, '10.'))), '[\s\x00]+', '', 'g'))) END AS doi FROM t", corpus=False)
def normalise_doi(c):
    """[EX-01]"""
    return part_text(c).select("p_partkey", tx.normalise_doi(F.col("text")).alias("doi"))


@query(PART_TEXT + r"""SELECT p_partkey, nullif(regexp_replace(regexp_extract(text, '[^A-z0-9.](10\.[0-9]+(\.[0-9]+)*/[^%"# ?<>{}^\[\]`|\\+]+)', 1), '[.,]$', ''), '') AS doi FROM t""", corpus=False)
def extract_doi(c):
    """[SC-04]"""
    return part_text(c).select("p_partkey", tx.extract_doi(F.col("text")).alias("doi"))


@query(r"SELECT page_id, nullif(replace(regexp_replace(regexp_extract('at ' || url || '/. more', '(https?://([A-z0-9%&?/._~:-])+)', 1), '/?\.?$', ''), '\', ''), '') AS url FROM pages", corpus=False)
def extract_url(c):
    """[SC-05]"""
    return c.table("pages").select("page_id", tx.extract_url(F.concat(F.lit("at "), F.col("url"), F.lit("/. more"))).alias("url"))


@query("SELECT doc_id, replace(replace(url_encode(text), '%3A', ':'), '%2F', '/') AS url FROM documents", corpus=False)
def encode_url(c):
    """[SC-07]"""
    return c.table("documents").select("doc_id", tx.encode_url(F.col("text")).alias("url"))


ASCII_SQL = r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"


@query(rf"SELECT doc_id, regexp_replace(lower({ASCII_SQL}), '[^A-Za-z ]', '', 'g') AS name FROM documents", corpus=False)
def normalise_name(c):
    """[SC-01, SC-02]"""
    return c.table("documents").select("doc_id", tx.normalise_name(F.col("text")).alias("name"))


@query(rf"SELECT doc_id, regexp_replace(lower(replace({ASCII_SQL}, '/', '#')), '[^A-Za-z0-9#]', '_', 'g') AS id FROM documents", corpus=False)
def normalise_id(c):
    """[SC-03]"""
    return c.table("documents").select("doc_id", tx.normalise_id(F.col("text")).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m') WHEN month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE WHEN o_orderkey % 3 = 2 THEN 'gYear' WHEN o_orderkey % 3 = 1 THEN 'gYearMonth' WHEN month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN 'gYear' ELSE 'date' END AS kind FROM orders", corpus=False)
def pub_date(c):
    """[SC-12, RS-28]"""
    parts = F.slice(F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")), F.lit(1), (3 - F.col("o_orderkey") % 3).cast("int"))
    out = c.table("orders").select("o_orderkey", tx.pub_date(parts).alias("date"))
    return out.withColumn("kind", tx.pub_date_type(F.col("date")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey || '' AS first, CASE WHEN l_partkey % 3 = 0 THEN l_partkey ELSE l_partkey + l_suppkey END || '' AS last FROM lineitem", corpus=False)
def pages_split(c):
    """[SC-13, RS-29]"""
    k = F.col("l_partkey")
    page = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat_ws("-", k, k + 1, k + F.col("l_suppkey"))).otherwise(F.concat_ws("––", k, k + F.col("l_suppkey")))
    return c.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", tx.first_page(page).alias("first"), tx.last_page(page).alias("last"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN lpad((p_partkey % 10000)::VARCHAR, 4, '0') || '-' || lpad((p_size)::VARCHAR, 4, '0') END AS issn, '978-' || p_partkey AS isbn FROM part", corpus=False)
def issn_isbn_clean(c):
    """[SC-14, RS-22]"""
    k, size = F.col("p_partkey"), F.lpad(F.col("p_size").cast("string"), 4, "0")
    issn = F.when(k % 3 == 0, F.lit("0000–0000")).otherwise(F.concat(F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("–"), size))
    return c.table("part").select("p_partkey", F.array_join(tx.issn_list(F.array(issn, F.lit("0000-0000"))), "|").alias("issn"), F.element_at(tx.isbn_list(F.array(F.concat(F.lit("http://id.example/isbn/978–"), k.cast("string")))), 1).alias("isbn")).withColumn("issn", F.nullif("issn", F.lit("")))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' - ' || p_brand ELSE p_name END AS title FROM part", corpus=False)
def title_join(c):
    """[RS-23]"""
    return c.table("part").select("p_partkey", tx.join_titles(F.array(F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")), F.lit("  "), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")))).alias("title"))


@query(rf"SELECT iri, regexp_extract(iri, '/([a-z]{{2}})/', 1) AS kind, regexp_extract(iri, '/(0[1-9]+0)?([1-9][0-9]*)$', 1) AS prefix, CAST(regexp_extract(iri, '/(0[1-9]+0)?([1-9][0-9]*)$', 2) AS DECIMAL(38,0)) AS number, TRUE AS supplied, FALSE AS dataset FROM br")
def iri_parts(c):
    """[SC-15, SC-16, SC-17]"""
    i = F.col("iri")
    return c.br.select("iri", tx.short_name(i).alias("kind"), tx.supplier_prefix(i).alias("prefix"), tx.resource_number(i).alias("number"), tx.has_supplier_prefix(i).alias("supplied"), tx.is_dataset(i).alias("dataset"))


@query(rf"""SELECT iri, '/data/br/040/' || (((n + 9999) // 10000) * 10000) || '/' || (((n + 999) // 1000) * 1000) || '.json' AS path, '/data/br/040/' || (((n + 9999) // 10000) * 10000) || '/' || (((n + 999) // 1000) * 1000) || '/prov/se.json' AS prov,
CAST(n - ((n + 999) // 1000) * 1000 + 1000 AS DECIMAL(38,0)) AS line FROM (SELECT iri, CAST(regexp_extract(iri, '/0[1-9]+0([0-9]+)$', 1) AS BIGINT) AS n FROM article)""")
def shard_path(c):
    """[SC-18, SC-19, G-12]"""
    i = F.col("iri")
    path = lambda x: tx.shard_path(x, BASE, "/data/")
    return c.article.select("iri", path(i).alias("path"), path(F.concat(i, F.lit("/prov/se/1"))).alias("prov"), tx.local_line(i).cast("decimal(38,0)").alias("line"))


@query("SELECT o_orderkey, CAST((o_orderkey % 4) * 365 + (o_orderkey % 12) * 30 + (CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 31 END) AS INT) AS days, concat_ws(', ', CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 4) || ' year' || CASE WHEN o_orderkey % 4 > 1 THEN 's' ELSE '' END END, CASE WHEN o_orderkey % 12 > 0 THEN (o_orderkey % 12) || ' month' || CASE WHEN o_orderkey % 12 > 1 THEN 's' ELSE '' END END, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 31 > 0 THEN (o_orderkey % 31) || ' day' || CASE WHEN o_orderkey % 31 > 1 THEN 's' ELSE '' END END) AS words FROM orders", corpus=False)
def timespan_days(c):
    """[SC-23, SC-24]"""
    k = F.col("o_orderkey")
    span = F.concat(F.lit("P"), (k % 4).cast("string"), F.lit("Y"), (k % 12).cast("string"), F.lit("M"), F.when(k % 5 == 0, F.lit("")).otherwise(F.concat((k % 31).cast("string"), F.lit("D"))))
    return c.table("orders").select("o_orderkey", tx.timespan_days(span).alias("days"), tx.timespan_words(span).alias("words"))


@query("SELECT p_partkey, CASE WHEN length(p_name) > 12 THEN left(p_name, 12) || '...' ELSE p_name END AS short, upper(left(p_name, 1)) || substr(p_name, 2) AS name FROM part", corpus=False)
def truncate_label(c):
    """[SC-22]"""
    return c.table("part").select("p_partkey", tx.truncated(F.col("p_name"), 12).alias("short"), tx.capitalised(F.col("p_name")).alias("name"))


@query("SELECT p_partkey, '978-' || p_partkey || '|' || p_partkey || '|978' || p_partkey AS forms FROM part", corpus=False)
def isbn_variants(c):
    """[SC-20]"""
    return c.table("part").select("p_partkey", F.array_join(tx.isbn_variants(F.concat(F.lit("978-"), F.col("p_partkey").cast("string"))), "|").alias("forms"))


@query("SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER (PARTITION BY o_orderstatus)) / nullif(max(o_totalprice) OVER (PARTITION BY o_orderstatus) - min(o_totalprice) OVER (PARTITION BY o_orderstatus), 0), 6) AS scaled FROM orders", corpus=False)
def min_max_normalise(c):
    """[SC-25] By the extremes of each status, which an aggregation finds before the rows meet them."""
    t = c.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    edges = t.groupBy("o_orderstatus").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    return t.join(edges, "o_orderstatus").select("o_orderkey", F.round((F.col("o_totalprice") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)), 6).alias("scaled"))


@query("SELECT p_partkey, array_to_string(list_filter(string_split(trim(lower(regexp_replace(p_name || ' ' || p_type, '\\W+', ' ', 'g'))), ' '), lambda w: w <> ''), ' ') AS words FROM part".replace("\\\\", "\\"), corpus=False)
def query_words(c):
    """[SC-21]"""
    noisy = F.concat(F.col("p_name"), F.lit(" et al. https://x.example/a,b Available at: "), F.col("p_type"))
    return c.table("part").select("p_partkey", F.array_join(tx.search_words(noisy), " ").alias("words"))
