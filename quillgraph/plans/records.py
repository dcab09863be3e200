"""Queries of catalogue records and of small operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.operators import extras as xt
from quillgraph.operators import records as rc
from quillgraph.plans.corpus import PREFIX, Corpus
from quillgraph.plans.extraction import article_xml
from quillgraph.schema import WORK

QUERIES, SQL = {}, {}


def query(sql: str | None = None, corpus: bool = True):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Corpus(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PREFIX + sql if corpus else sql
        return f

    return put


def records(c):
    """Parts as catalogue records: every third in a container, every seventh without a DOI; some come twice, once fuller."""
    k = F.col("p_partkey")
    s = k.cast("string")
    t = c.table("part")
    fields = {
        "DOI": F.when(k % 7 != 0, F.concat(F.lit("10.7/P"), s)), "type": F.when(k % 3 == 0, "journal-article").when(k % 3 == 1, "edited-book").otherwise("book"), "title": F.array(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "), s), F.lit("")),
        "subtitle": F.array().cast("array<string>"), "author": F.array(F.struct(F.lit("A").alias("given"), F.col("p_brand").alias("family")), F.struct(F.lit("B").alias("given"), F.col("p_type").alias("family"))),
        "publisher": F.when(k % 5 != 0, F.col("p_brand")), "member": F.when(k % 2 == 0, (k % 10).cast("string")), "issued": F.struct(F.array(F.array((1990 + k % 30).cast("int"), (1 + k % 12).cast("int"))).alias("date-parts")),
        "page": F.when(k % 4 == 0, F.concat_ws("-", k, k + 9)), "volume": F.lit("1"), "issue": F.lit(None).cast("string"), "container-title": F.when(k % 3 == 0, F.array(F.col("p_type"))).otherwise(F.array().cast("array<string>")),
        "ISSN": F.when(k % 3 == 0, F.array(F.concat(F.lit("1000-"), F.lpad((k % 50).cast("string"), 4, "0")), F.lit("0000-0000"))), "ISBN": F.when(k % 3 != 0, F.array(F.concat(F.lit("978-"), s))), "URL": F.lit(None).cast("string"), "score": F.lit(1.0),
    }
    made = lambda of, **other: of.select(*[v.alias(n) for n, v in (fields | other).items()])
    bare = made(t.filter(k % 14 == 1), issued=F.lit(None).cast("struct<`date-parts`: array<array<int>>>"), page=F.lit(None).cast("string"))
    fuller = made(t.filter((k % 7 == 0) & (k % 3 == 1)), subtitle=F.array(F.lit("second edition")))
    return c.spark.createDataFrame([], WORK).unionByName(made(t)).unionByName(bare).unionByName(fuller).unionByName(made(t.filter(k % 21 == 0)))


#: Written from the rules: the DOI; the ISBN of works without a container; else the content, whose hash is not shown.
KEY = "CASE WHEN k % 7 <> 0 THEN 'doi|10.7/p' || k WHEN k % 3 <> 0 THEN 'isbn|978-' || k ELSE 'text' END"
CLASS = "CASE k % 3 WHEN 0 THEN 'JournalArticle' ELSE 'Book' END"
PARTS = "(SELECT p_partkey AS k, p_name, p_type, p_brand FROM part)"


def shown(name):
    """A key without the hash of a content."""
    return F.regexp_replace(name, r"^text\|[0-9a-f]{32}", "text").alias(name)


@query(f"SELECT {KEY} AS key, p_name || ' ' || k AS title FROM {PARTS}", corpus=False)
def record_keys(c):
    """[RS-34] One work for each part: those of one container stay apart, those that come twice are one."""
    return rc.works(records(c)).select(shown("key"), "title")


@query(f"SELECT {KEY} AS key, p_name || ' ' || k AS title, CASE WHEN k % 7 = 0 AND k % 3 = 1 THEN 'second edition' END AS subtitle, (1990 + k % 30) || '-' || lpad((1 + k % 12)::VARCHAR, 2, '0') AS pub_date, {CLASS} AS class, CASE WHEN k % 4 = 0 THEN '' || k END AS start, CASE WHEN k % 4 = 0 THEN '' || (k + 9) END AS \"end\", CASE WHEN k % 3 = 0 THEN p_type END AS container FROM {PARTS}", corpus=False)
def record_works(c):
    """[RS-23, RS-28, RS-29, RS-32, RS-33] Of records with one key the fullest counts."""
    return rc.works(records(c)).select(shown("key"), "title", "subtitle", "pub_date", "class", "start", "end", "container")


@query(f"""SELECT DISTINCT owner, scheme, literal FROM (SELECT {KEY} AS owner, 'doi' AS scheme, '10.7/p' || k AS literal FROM {PARTS} WHERE k % 7 <> 0
UNION ALL SELECT 'container|' || lower(p_type), 'issn', '1000-' || lpad((k % 50)::VARCHAR, 4, '0') FROM {PARTS} WHERE k % 3 = 0 UNION ALL SELECT {KEY}, 'isbn', '978-' || k FROM {PARTS} WHERE k % 3 <> 0)""", corpus=False)
def record_identifiers(c):
    """[RS-20, RS-21, RS-22]"""
    return rc.identifiers(rc.works(records(c)))


@query(f"""SELECT work, pos, role, agent FROM (SELECT {KEY} AS work, 0 AS pos, CASE WHEN k % 3 = 1 THEN 'editor' ELSE 'author' END AS role, CASE WHEN k % 6 = 1 AND k % 7 <> 0 THEN 'orcid|0-' || (k % 20) ELSE {KEY} || '#0' END AS agent FROM {PARTS}
UNION ALL SELECT {KEY}, 1, CASE WHEN k % 3 = 1 THEN 'editor' ELSE 'author' END, {KEY} || '#1' FROM {PARTS}
UNION ALL SELECT {KEY}, -1, 'publisher', CASE WHEN k % 2 = 0 THEN 'crossref|' || (k % 10) ELSE 'name|' || lower(p_brand) END FROM {PARTS} WHERE k % 5 <> 0)""", corpus=False)
def record_roles(c):
    """[RS-25, RS-26, RS-27]"""
    k = F.col("p_partkey")
    matched = c.table("part").filter("p_partkey % 6 = 1").select(F.concat(F.lit("doi|10.7/p"), k.cast("string")).alias("br"), F.lit(0).alias("pos"), F.concat(F.lit("0-"), (k % 20).cast("string")).alias("orcid"))
    return rc.contributors(rc.works(records(c)), matched)[1].select(shown("work"), "pos", "role", shown("agent"))


def documents(c):
    """Orders as reference documents; one in nine has no DOI. A reference names a part by DOI, by a DOI in its text, or not at all."""
    n, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    text = F.when(n % 3 == 1, F.concat(F.lit("See 10.7/P"), part, F.lit("."))).when(n % 3 == 2, F.lit("No identifier"))
    none = F.lit(None).cast("string")
    ref = F.struct(text.alias("bibentry"), none.alias("process_entry"), none.alias("localid"), F.when(n % 3 == 0, F.concat(F.lit("10.7/P"), part)).alias("doi"), none.alias("pmid"), none.alias("pmcid"), none.alias("url"), F.concat(F.lit("b"), F.col("pos").cast("string")).alias("xmlid"))
    lists = c.lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", ref.alias("r")))), lambda x: x["r"]).alias("references"))
    k = F.col("l_orderkey")
    return lists.select(k.cast("string").alias("doc"), F.when(k % 9 != 0, F.concat(F.lit("10.1234/"), k.cast("string"))).alias("doi"), "references")


@query("""SELECT '10.1234/' || l_orderkey AS citing, CASE WHEN l_linenumber % 3 = 2 THEN 'new|' || l_orderkey || '#' || (pos - 1) WHEN l_partkey % 4 = 0 THEN 'store/' || l_partkey WHEN l_partkey % 4 = 1 THEN 'catalogue/' || l_partkey ELSE 'new|' || l_orderkey || '#' || (pos - 1) END AS cited, (pos - 1)::INT AS pos,
CASE WHEN l_linenumber % 3 = 2 THEN NULL WHEN l_partkey % 4 = 0 THEN CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 2 END WHEN l_partkey % 4 = 1 THEN 3 END AS stage FROM lines WHERE l_orderkey % 9 <> 0 AND l_orderkey % 10 <> 3""")
def resolve_documents(c):
    """[RS-01, RS-02, RS-11, RS-15, RS-18, RS-19]"""
    k = F.col("p_partkey")
    store = c.table("part").filter(k % 4 == 0).select(F.lit("doi").alias("scheme"), F.concat(F.lit("10.7/P"), k.cast("string")).alias("literal"), F.concat(F.lit("store/"), k.cast("string")).alias("res"))
    catalogue = c.table("part").filter(k % 4 == 1).select(F.concat(F.lit("10.7/P"), k.cast("string")).alias("doi"), F.concat(F.lit("catalogue/"), k.cast("string")).alias("key"))
    cites = c.table("orders").filter("o_orderkey % 10 = 3").select(F.concat(F.lit("10.1234/"), F.col("o_orderkey").cast("string")).alias("citing"))
    return rc.resolve_documents(documents(c), catalogue, store, cites)["citations"].select("citing", "cited", "pos", "stage")


@query("SELECT doi, orcid, family FROM (SELECT '10.1234/' || o_orderkey AS doi, o_custkey % 3 AS m FROM orders) JOIN (SELECT '10.1234/' || l_orderkey AS id, '0-' || l_suppkey AS orcid, 'f' || (l_suppkey % 3) AS family, l_suppkey % 3 AS f FROM lines) ON id = doi WHERE m = 2 OR f = m")
def author_lookup(c):
    """[SRC-10] Families are given for two of three orders."""
    k = F.col("o_custkey") % 3
    refs = c.table("orders").select(F.concat(F.lit("10.1234/"), F.col("o_orderkey").cast("string")).alias("doi"), F.when(k != 2, F.array(F.concat(F.lit("F"), k.cast("string")))).alias("families"))
    s = F.col("l_suppkey")
    known = c.lines.groupBy(F.concat(F.lit("10.1234/"), F.col("l_orderkey").cast("string")).alias("id")).agg(F.collect_list(F.struct(F.concat(F.lit("0-"), s.cast("string")).alias("orcid"), F.lit("g").alias("given_names"), F.concat(F.lit("f"), (s % 3).cast("string")).alias("family_name"))).alias("authors"))
    return rc.author_ids(refs, known).select("doi", "orcid", "family")


@query("SELECT iri AS owner, literal FROM br LEFT JOIN (SELECT owner, literal FROM ident WHERE scheme = 'isbn') ON owner = iri")
def identifier_literals(c):
    """[RS-05, RS-06]"""
    return rc.literals(c.br.select(F.col("iri").alias("owner")), c.ident, "isbn")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders", corpus=False)
def group_without_aggregates(c):
    """[AG-03]"""
    return xt.grouped(c.table("orders"), ["o_orderstatus", "o_orderpriority"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'cheap|early' WHEN o_orderkey % 2 = 0 THEN 'cheap' WHEN o_orderkey % 3 = 0 THEN 'early' ELSE '' END AS errors FROM orders", corpus=False)
def error_columns(c):
    """[SNK-12]"""
    k = F.col("o_orderkey")
    return xt.with_errors(c.table("orders"), cheap=k % 2 == 0, early=k % 3 == 0).select("o_orderkey", F.array_join("errors", "|").alias("errors"))


@query("SELECT l_orderkey::VARCHAR AS doc, 'Results' AS text FROM lines GROUP BY l_orderkey")
def xpath_on_source(c):
    """[RO-15]"""
    xml = article_xml(c)
    return xt.evaluated_xpaths(xml.select("doc", F.lit("/article/body[1]/sec[1]/title[1]").alias("path")), xml).select("doc", "text")
