"""Queries of extraction, pointers, sources and streaming over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import extract as ex
from quillgraph.operators import graph as gr
from quillgraph.operators import jats
from quillgraph.plans.corpus import PREFIX, Corpus
from quillgraph.sources import files
from quillgraph.streaming import queue

QUERIES, SQL = {}, {}


def query(sql: str | None = None, corpus: bool = True):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Corpus(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PREFIX + sql if corpus else sql
        return f

    return put


def structured(c):
    """Parts as structured references; one in six has no author and only unstructured text."""
    k = F.col("p_partkey")
    return c.table("part").select(
        "p_partkey",
        F.when(k % 6 == 5, F.lit("Author Unknown")).otherwise(F.concat(F.lit("Writer "), F.col("p_brand"), F.when(k % 2 == 0, ".").otherwise(""))).alias("authorString"),
        F.when(k % 4 != 3, 1950 + k % 70).cast("int").alias("pubYear"),
        F.when(k % 9 != 8, F.concat(F.col("p_name"), F.when(k % 3 == 0, "?").otherwise(""))).alias("title"),
        F.when(k % 8 == 1, F.lit("Some Editor")).alias("editors"),
        F.when(k % 3 == 1, F.col("p_type")).alias("journalAbbreviation"),
        F.when(k % 2 == 1, (k % 40).cast("string")).alias("volume"),
        F.when(k % 4 == 1, F.lit("3")).when(k % 4 == 2, F.lit("S1")).alias("issue"),
        F.when(k % 5 < 2, F.lit("11-19")).alias("pageInfo"),
        F.when(k % 7 == 0, F.concat(F.lit("10.1/"), k.cast("string"))).alias("doi"),
        F.when(k % 12 != 11, F.concat(F.lit("<i>"), F.col("p_name"), F.lit("</i> &amp; more"))).alias("unstructuredInformation"),
    )


@query("""WITH p AS (SELECT p_partkey AS k, p_name, p_type, p_brand FROM part),
s AS (SELECT *, CASE WHEN k % 6 = 5 THEN NULL ELSE 'Writer ' || p_brand || CASE WHEN k % 2 = 0 THEN '.' ELSE '' END || CASE WHEN k % 4 <> 3 THEN ' (' || (1950 + k % 70) || ')' ELSE '' END END AS a FROM p),
t AS (SELECT *, CASE WHEN k % 9 <> 8 THEN a || CASE WHEN right(a, 1) = '.' THEN '' ELSE '.' END || ' ' || p_name || CASE WHEN k % 3 = 0 THEN '?' ELSE '' END ELSE a END AS b FROM s),
e AS (SELECT *, CASE WHEN k % 8 = 1 THEN b || CASE WHEN right(b, 1) = '.' THEN '' ELSE '.' END || ' Some Editor (Eds.)' ELSE b END AS c FROM t),
j AS (SELECT *, CASE WHEN k % 3 = 1 THEN c || CASE WHEN c LIKE '%(Eds.)' THEN ',' WHEN right(c, 1) IN ('.', '?', '!') THEN '' ELSE '.' END || ' ' || p_type ELSE c END AS d FROM e),
v AS (SELECT *, CASE WHEN k % 2 = 1 THEN d || CASE WHEN right(d, 1) IN ('.', '?', '!') THEN '' ELSE ',' END || ' ' || (k % 40) ELSE d END AS f FROM j),
i AS (SELECT *, CASE WHEN k % 4 IN (1, 2) THEN CASE WHEN regexp_matches(right(f, 1), '[0-9]') THEN f || ' (' || CASE WHEN k % 4 = 1 THEN '3' ELSE 'S1' END || ')' ELSE f || ' ' || CASE WHEN k % 4 = 1 THEN '3' ELSE 'S1' END END ELSE f END AS g FROM v),
g AS (SELECT *, CASE WHEN k % 5 < 2 THEN g || CASE WHEN right(g, 1) IN ('.', '?', '!') THEN '' ELSE ':' END || ' 11-19' ELSE g END AS h FROM i)
SELECT k AS p_partkey, CASE WHEN a IS NULL THEN CASE WHEN k % 12 <> 11 THEN p_name || ' & more' END WHEN k % 7 = 0 THEN h || CASE WHEN right(h, 1) = '.' THEN '' ELSE '.' END || ' https://doi.org/10.1/' || k ELSE h END AS entry,
CASE WHEN a IS NULL THEN CASE WHEN k % 12 <> 11 THEN TRUE END ELSE k % 4 <> 3 AND k % 9 <> 8 END AS process FROM g""", corpus=False)
def citation_text(c):
    """[EX-03, EX-04]"""
    rows = structured(c)
    entry, process = ex.citation_text({n: F.col(n) for n in rows.columns})
    return rows.select("p_partkey", entry.alias("entry"), process.alias("process"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '10.1234/' || o_orderkey WHEN o_orderkey % 3 = 0 THEN '10.5/x' || o_orderkey END AS doi, CASE WHEN o_orderkey % 2 = 0 THEN '' || o_custkey WHEN o_orderkey % 5 = 0 THEN '' || (o_custkey + 1) END AS pmid, 'PMC' || o_orderkey AS pmcid,
CASE WHEN o_orderkey % 4 = 0 THEN 'http://a.example/' || o_orderkey END AS url, CASE WHEN o_orderkey % 5 = 0 AND o_custkey <> 0 THEN 'PMID' || o_custkey WHEN o_orderkey % 7 = 0 THEN 'PMC' || o_orderkey ELSE 'DOI10.5/X' || o_orderkey END AS localid FROM orders""", corpus=False)
def reference_ids(c):
    """[EX-05, EX-06, EX-09, EX-12]"""
    k, s = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    own = {"doi": F.when(k % 3 == 0, F.concat(F.lit("doi:10.5/X"), s)), "pmid": F.when(k % 5 == 0, (F.col("o_custkey") + 1).cast("string")), "pmcid": F.when(k % 2 == 1, s).otherwise(F.concat(F.lit("pmc"), s))}
    found = {"doi": F.concat(F.lit("10.1234/"), s), "pmid": F.col("o_custkey").cast("string"), "pmcid": F.concat(F.lit("PMC"), s)}
    ids = ex.reference_ids(own, found, k % 2 == 0)
    url = ex.reference_url(F.when(k % 4 == 0, F.concat(F.lit(" http://a.example/"), s)).otherwise("see there"))
    local = ex.local_id(F.when(k % 5 == 0, F.col("o_custkey").cast("double")).otherwise(0.0), F.when(k % 7 == 0, F.concat(F.lit("PMC"), s)), F.concat(F.lit("10.5/X"), s))
    return c.table("orders").select("o_orderkey", *[v.alias(n) for n, v in ids.items()], url.alias("url"), local.alias("localid"))


@query("""SELECT 'PMID' || o_custkey AS localid, pos::INT AS pos, CASE WHEN l_linenumber % 2 = 0 THEN 'Text ' || l_partkey END AS bibentry, CASE WHEN l_linenumber % 2 = 0 THEN 'True' END AS process_entry, '10.1/' || l_partkey AS doi, CASE WHEN l_linenumber % 3 = 0 THEN 'r' || l_linenumber END AS xmlid, o_orderkey
FROM orders JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos FROM lineitem) ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 0""", corpus=False)
def extraction_table(c):
    """[SRC-05, EX-12, EX-13] References of an extraction table with a JSON column."""
    ref = F.struct(F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("Text "), F.col("l_partkey").cast("string"))).otherwise("  ").alias("entry_text"), F.concat(F.lit("10.1/"), F.col("l_partkey").cast("string")).alias("ref_doi"), F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("r"), F.col("l_linenumber").cast("string"))).otherwise("").alias("ref_xmlid"))
    lists = c.lines.groupBy("l_orderkey").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", ref.alias("r")))), lambda x: x["r"])).alias("references"))
    rows = c.table("orders").join(lists, F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.select(F.lit("").alias("cur_doi"), F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("cur_pmid"), F.lit(None).cast("string").alias("cur_pmcid"), F.col("o_orderkey").cast("string").alias("cur_name"), "references")
    out = ex.references_of(ex.read_extracted(rows), ["localid", "name"])
    return out.drop("localid").join(ex.read_extracted(rows).select("name", F.col("localid").alias("l")), "name").select(F.col("l").alias("localid"), "pos", "bibentry", "process_entry", "doi", "xmlid", F.col("name").cast("long").alias("o_orderkey"))


def fake_pointers(c):
    """Events as pointers of a text: users are articles, events pointers, and the value what stands between two."""
    from pyspark.sql import Window

    v = F.floor(F.abs(F.col("value")) * 100).cast("long") % 6
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    tail = F.when(v == 0, ", ").when(v == 1, "–").when(v == 2, ";").when(v == 3, "] and").otherwise(" text ")
    rows = c.table("events").select("user_id", "event_id", (F.row_number().over(order) - 1).alias("pos"), tail.alias("tail"), v.alias("v"))
    return rows.select(F.col("user_id").cast("string").alias("doc"), "pos", F.lit("/article/p[1]").alias("parent_path"), "tail", F.when(F.coalesce(F.lag("v").over(Window.partitionBy("user_id").orderBy("pos")), F.lit(5)) > 2, " [").otherwise(",").alias("before"), "event_id")


@query("""WITH p AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, CAST(floor(abs(value) * 100) AS BIGINT) % 6 AS v FROM events),
q AS (SELECT *, coalesce(lag(v) OVER (PARTITION BY user_id ORDER BY pos), 5) AS u FROM p), r AS (SELECT *, sum(CASE WHEN u <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos) AS n FROM q),
s AS (SELECT *, count(*) OVER (PARTITION BY user_id, n) AS k, max((u > 2)::INT) OVER (PARTITION BY user_id, n) AS o, max((v = 3)::INT) OVER (PARTITION BY user_id, n) AS c FROM r)
SELECT event_id, CASE WHEN k > 1 OR (o = 1 AND c = 1) THEN user_id || '#' || n END AS list_id, (v = 1) AS in_range FROM s""", corpus=False)
def pointer_lists(c):
    """[PT-03]"""
    return jats.pointer_lists(fake_pointers(c)).select("event_id", "list_id", "in_range")


@query("""WITH p AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, CAST(floor(abs(value) * 100) AS BIGINT) % 6 AS v FROM events),
o AS (SELECT *, (pos * 3) % 40 AS ordinal FROM p), n AS (SELECT *, lead(ordinal) OVER (PARTITION BY user_id ORDER BY pos) AS nxt FROM o)
SELECT user_id::VARCHAR AS doc, count(*) + CAST(sum(CASE WHEN v = 1 AND nxt > ordinal + 1 THEN nxt - ordinal - 1 ELSE 0 END) AS BIGINT) AS pointers, CAST(sum(CASE WHEN v = 1 AND nxt > ordinal + 1 THEN nxt - ordinal - 1 ELSE 0 END) AS BIGINT) AS unseen FROM n GROUP BY user_id""", corpus=False)
def pointer_ranges(c):
    """[PT-04, PT-05] Pointers of ranges: those that a dash stands for are put in."""
    rows = fake_pointers(c)
    refs = c.table("events").select(F.col("user_id").cast("string").alias("doc")).distinct().select("doc", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("pos")).withColumn("xmlid", F.concat(F.lit("b"), F.col("pos").cast("string")))
    named = jats.pointer_lists(rows).withColumns({"xmlid": F.concat(F.lit("b"), ((F.col("pos") * 3) % 40).cast("string")), "label": F.col("pos").cast("string"), "sentence": F.lit(""), "sentence_no": F.lit(0)})
    out = jats.expand_ranges(named, refs)
    return out.groupBy("doc").agg(F.count("*").alias("pointers"), F.count_if(F.col("label") == "in sequence").alias("unseen"))


@query("SELECT '' || user_id AS citing, '' || v AS cited, count(*) AS n, min('' || user_id || '-' || v || '/1-' || k) AS first FROM (SELECT *, count(*) OVER (PARTITION BY user_id, v) AS k FROM (SELECT user_id, CAST(floor(abs(value)) AS BIGINT) % 7 AS v FROM events)) GROUP BY ALL", corpus=False)
def pointer_entities(c):
    """[PT-11..13]"""
    from pyspark.sql import Window

    rows = c.table("events").select(F.col("user_id").cast("string").alias("doc"), F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("pos"), (F.floor(F.abs("value")).cast("long") % 7).cast("string").alias("xmlid"))
    entries = rows.select("doc", "xmlid").distinct().select("doc", "xmlid", F.col("doc").alias("citing"), F.col("xmlid").alias("cited"))
    out = jats.pointer_entities(rows, entries)
    return out.groupBy("citing", "cited").agg(F.count("*").alias("n"), F.min(F.when(F.col("oci").endswith("/1"), F.col("intrepid"))).alias("first"))


def article_xml(c):
    """Orders as articles: their first lines are references, with a pointer to each in a text of two sentences."""
    number = F.col("pos").cast("string")
    part, brand = c.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), F.col("p_brand")
    # By the text, as what is done with the articles is: then their XML is not shuffled again.
    rows = c.lines.join(part, "l_partkey").groupBy(F.col("l_orderkey").cast("string").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("pos", "l_partkey", "p_name", brand))).alias("all"))
    one = lambda x: F.concat(F.lit("<ref id='B"), x["pos"].cast("string"), F.lit("'><element-citation><person-group><name><surname>"), x["p_brand"], F.lit("</surname><given-names>A</given-names></name></person-group><article-title>"), x["p_name"], F.lit("</article-title><pub-id pub-id-type='doi'>10.1/"), x["l_partkey"].cast("string"), F.lit("</pub-id></element-citation></ref>"))
    point = lambda x: F.concat(F.lit("<xref ref-type='bibr' rid='B"), x["pos"].cast("string"), F.lit("'>"), x["pos"].cast("string"), F.lit("</xref>"))
    refs, points = F.array_join(F.transform("all", one), ""), F.array_join(F.transform("all", point), ", ")
    k = F.col("doc")
    xml = F.concat(F.lit("<!DOCTYPE article PUBLIC 'x' 'y.dtd'><article><front><article-meta><article-id pub-id-type='doi'>10.9/"), k, F.lit("</article-id></article-meta></front><body><sec><title>Results</title><p>As shown by others et al. before &mdash; ["), points, F.lit("]. Then more follows [<xref rid='B1'>1</xref>].</p></sec></body><back><ref-list>"), refs, F.lit("</ref-list></back></article>"))
    return rows.select("doc", xml.alias("xml"))


@query("SELECT l_orderkey::VARCHAR AS doc, (pos - 1)::INT AS pos, 'B' || pos AS xmlid, p_brand || ', A. ' || p_name || ', DOI: 10.1/' || l_partkey AS text, '10.1/' || l_partkey AS doi FROM lines JOIN part ON p_partkey = l_partkey")
def jats_refs(c):
    """[SRC-04, EX-02]"""
    return jats.extract_references(article_xml(c)).select("doc", "pos", "xmlid", "text", "doi")


@query("SELECT doc, pos::INT AS pos, xmlid, section, no::INT AS sentence_no FROM (SELECT l_orderkey::VARCHAR AS doc, pos - 1 AS pos, 'B' || pos AS xmlid, 'Results' AS section, 0 AS no FROM lines UNION ALL SELECT l_orderkey::VARCHAR, count(*), 'B1', 'Results', 1 FROM lines GROUP BY l_orderkey)")
def jats_pointers(c):
    """[PT-01, PT-02, PT-06]"""
    return jats.extract_pointers(article_xml(c)).select("doc", "pos", "xmlid", "section", "sentence_no")


@query("SELECT l_orderkey::VARCHAR AS doc, '10.9/' || l_orderkey AS doi FROM lines GROUP BY l_orderkey")
def jats_article_doi(c):
    """[EX-14]"""
    return jats.article_doi(article_xml(c))


@query("SELECT l_orderkey::VARCHAR AS doc, unnest([{'c': 'Paragraph', 'p': TRUE}, {'c': 'Section', 'p': FALSE}]).c AS class, unnest([{'c': 'Paragraph', 'p': TRUE}, {'c': 'Section', 'p': FALSE}]).p AS has_parent FROM lines GROUP BY l_orderkey")
def jats_discourse(c):
    """[PT-08, PT-10]"""
    return jats.discourse(jats.extract_pointers(article_xml(c))).select("doc", "class", F.col("parent").isNotNull().alias("has_parent"))


@query("SELECT 'ref' AS element, count(*) AS n FROM lines UNION ALL SELECT 'xref', count(*) + count(DISTINCT l_orderkey) FROM lines UNION ALL SELECT 'sec', count(DISTINCT l_orderkey) FROM lines")
def jats_census(c):
    """[EX-15]"""
    return jats.census(article_xml(c)).filter("attribute IS NULL AND element IN ('ref', 'xref', 'sec')").select("element", "n")


@query("SELECT iri AS s, title AS o FROM br WHERE title IS NOT NULL")
def statements_round_trip(c):
    """[SRC-11, SNK-04] Literals written as N-Quads lines and read back."""
    quads = gr.triples(c.br, "iri", {"title": ("title", "lit")})
    return files.parse_statements(quads.select(gr.ntriples(with_graph=True).alias("value"))).select("s", "o")


@query("SELECT 'br' AS kind, regexp_extract(iri, '/(0[1-9]+0)', 1) AS prefix, ((n + 9999) // 10000) * 10000 || '' AS dir_split, ((n + 999) // 1000) * 1000 || '' AS file_split, count(*) AS n FROM (SELECT iri, CAST(regexp_extract(iri, '/0[1-9]+0([0-9]+)$', 1) AS BIGINT) AS n FROM br) GROUP BY ALL")
def shard_columns(c):
    """[SNK-03]"""
    return files.with_shard(c.br.select(F.col("iri").alias("s"))).groupBy("kind", "prefix", "dir_split", "file_split").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS turn, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events", corpus=False)
def queue_replay(c):
    """[ST-03]"""
    return queue.replay(c.table("events"))


@query(r"SELECT page_id, regexp_replace(regexp_extract(url, '(https?://([A-z0-9%&?/._~:-])+)', 1), '/?\.?$', '') AS url, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages", corpus=False)
def page_hosts(c):
    """[SC-05] URLs of pages with their hosts."""
    return c.table("pages").select("page_id", tx.extract_url(F.concat(F.lit(" "), F.col("url"))).alias("url"), F.regexp_extract("url", "https?://([^/]+)", 1).alias("host"))
