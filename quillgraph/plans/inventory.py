"""Queries of the operators that the other modules of plans do not reach, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.functions import matching as mt
from quillgraph.functions import text as tx
from quillgraph.operators import evaluate as ev
from quillgraph.operators import extract as ex
from quillgraph.operators import extras as xt
from quillgraph.operators import graph as gr
from quillgraph.operators import jats
from quillgraph.operators import records as rc
from quillgraph.operators import resolve as rs
from quillgraph.plans import records, rest
from quillgraph.plans.corpus import PREFIX, Corpus
from quillgraph.plans.extraction import article_xml, fake_pointers
from quillgraph.schema import BASE
from quillgraph.sources import files
from quillgraph.sources.workspace import shared_dir
from quillgraph.streaming import queue

QUERIES, SQL = {}, {}


def query(sql: str | None = None, corpus: bool = True):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Corpus(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PREFIX + sql if corpus else sql
        return f

    return put


def text_of(name: str):
    return F.col(name).cast("string")


def folder(c, name: str) -> str:
    """A new folder for what a query writes and reads back."""
    import uuid

    return f"{shared_dir(c.spark)}/{name}-{uuid.uuid4().hex}"


# --- sources -------------------------------------------------------------------------------------


def search_pages_of(c):
    """Customers as search results, a hundred to a page; cursors fall as pages rise, as opaque tokens may."""
    k = F.col("c_custkey")
    one = F.struct(text_of("c_custkey").alias("id"), F.lit("MED").alias("source"), F.when(k % 2 == 0, F.concat(F.lit("10.3/"), k.cast("string"))).alias("doi"))
    pages = c.table("customer").groupBy(F.floor(k / 100).alias("page")).agg(F.collect_list(one).alias("result"))
    body = F.struct(F.struct("result").alias("resultList"), F.concat(F.lit("c"), (F.lit(10**9) - F.col("page")).cast("string")).alias("nextCursorMark"))
    return pages.select("page", F.to_json(body).alias("value"))


@query("SELECT 'MED-' || c_custkey AS localid, CASE WHEN c_custkey % 2 = 0 THEN '10.3/' || c_custkey END AS doi, 'c' || (1000000000 - (SELECT max(c_custkey // 100) FROM customer)) AS cursor FROM customer", corpus=False)
def search_pages(c):
    """[SRC-01, SRC-02, ST-01] Articles of all pages, and the cursor to go on from."""
    articles, cursor = ex.from_pages(search_pages_of(c))
    return articles.select("localid", "doi", F.lit(cursor).alias("cursor"))


@query("""SELECT l_orderkey::VARCHAR AS article, (pos - 1)::INT AS pos, 'Author ' || l_suppkey || ' (' || (1900 + l_partkey % 100) || '). Title ' || l_partkey || '. https://doi.org/10.5/' || l_partkey AS bibentry, TRUE AS process_entry,
CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 3 = 0 THEN '10.4/' || l_partkey ELSE '10.5/' || l_partkey END AS doi, CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 3 = 0 THEN '' || l_partkey END AS pmid FROM lines""")
def reference_lists(c):
    """[SRC-03, SRC-07, EX-03..06] Reference lists as JSON; those that match a paper take its ids."""
    k, n = F.col("l_partkey"), F.col("l_linenumber")
    ref = F.struct("pos", F.struct(text_of("l_partkey").alias("id"), F.lit("MED").alias("source"), F.when(n % 2 == 0, "Y").otherwise("N").alias("match"), F.concat(F.lit("10.5/"), k.cast("string")).alias("doi"), F.concat(F.lit("Author "), text_of("l_suppkey")).alias("authorString"), F.concat(F.lit("Title "), k.cast("string")).alias("title"), (1900 + k % 100).cast("int").alias("pubYear")).alias("r"))
    lists = c.lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(ref)), lambda x: x["r"]).alias("reference"))
    pages = lists.select(text_of("l_orderkey").alias("article"), F.to_json(F.struct(F.struct("reference").alias("referenceList"))).alias("value"))
    p = F.col("p_partkey")
    papers = c.table("part").filter(p % 3 == 0).select(F.lit("MED").alias("source"), p.cast("string").alias("id"), F.concat(F.lit("10.4/"), p.cast("string")).alias("doi"), p.cast("string").alias("pmid"), F.lit(None).cast("string").alias("pmcid"))
    return ex.reference_lists(pages, papers).select("article", "pos", "bibentry", "process_entry", "doi", "pmid")


@query("SELECT l_orderkey::VARCHAR AS name, '10.9/' || l_orderkey AS doi, count(*) AS refs FROM lines WHERE l_orderkey % 3 = 0 GROUP BY l_orderkey")
def articles_of_dataset(c):
    """[SRC-06] Article files joined to the rows of a dataset by name."""
    rows = c.table("orders").filter("o_orderkey % 3 = 0").select(text_of("o_orderkey").alias("cur_name"), F.concat(F.lit("10.9/"), text_of("o_orderkey")).alias("cur_doi"))
    refs = jats.extract_references(files.articles_of(rows, article_xml(c)).select("doc", "xml")).groupBy("doc").agg(F.count("*").alias("refs"))
    return refs.join(rows, F.col("doc") == F.col("cur_name")).select(F.col("doc").alias("name"), F.col("cur_doi").alias("doi"), "refs")


@query("SELECT lower('10.7/P' || o_custkey) AS doi, CASE WHEN n = 1 THEN name END AS bibref, o_orderkey FROM orders LEFT JOIN (SELECT p_partkey % 150 AS k, count(*) AS n, min(p_name) AS name FROM part GROUP BY 1) ON k = o_custkey", corpus=False)
def catalogue_by_doi(c):
    """[SRC-08, SRC-16] The work of a DOI, if there is exactly one."""
    k = F.col("p_partkey")
    works = c.table("part").select(F.concat(F.lit("10.7/p"), (k % 150).cast("string")).alias("id"), F.col("p_name").alias("bibref"))
    refs = c.table("orders").select(F.concat(F.lit("10.7/P"), text_of("o_custkey")).alias("doi"), "o_orderkey")
    return xt.LocalCatalogue(works, c.spark.createDataFrame([], "id string, authors array<struct<orcid: string, given_names: string, family_name: string>>")).by_doi(refs).select("doi", "bibref", "o_orderkey")


@query("SELECT iri AS s, title AS o FROM br WHERE title IN ('ASIA', 'EUROPE')")
def statements_matching(c):
    """[SRC-12]"""
    quads = gr.triples(c.br, "iri", {"title": ("title", "lit")})
    return xt.match(quads, o="ASIA").unionByName(xt.match(quads, o="EUROPE")).select("s", "o")


@query(f"SELECT s, p, o FROM (SELECT 'http://x.example/' || p_partkey AS s, 'http://p' AS p, CASE WHEN p_partkey % 4 = 0 THEN '{BASE}br/050' || (p_partkey + 1) ELSE 'http://x.example/none' || p_partkey END AS o FROM part WHERE p_partkey % 3 <> 0) UNION ALL SELECT iri, 'http://t', title FROM book")
def imported_statements(c):
    """[SRC-13, G-17] Statements of another store: without subjects done before, objects mapped to known entities."""
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    row = lambda s, p, o, kind: [none.alias("g"), s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), none.alias("o_dt")]
    there = c.book.select(*row(F.col("iri"), "http://t", F.col("title"), "lit"))
    subject = F.concat(F.lit("http://x.example/"), k.cast("string"))
    other = F.concat(F.lit("http://x.example/none"), k.cast("string"))
    more = c.table("part").select(*row(subject, "http://p", other, "iri"))
    mapping = c.table("part").filter(k % 4 == 0).select(other.alias("old"), F.concat(F.lit(f"{BASE}br/050"), (k + 1).cast("string")).alias("new"))
    done = c.table("part").filter(k % 3 == 0).select(subject.alias("s"))
    return xt.imported(there, more, mapping, done).select("s", "p", "o")


@query("SELECT 'http://o.example/terms#T' || n_nationkey AS iri, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE 'T' || n_nationkey END AS term FROM nation", corpus=False)
def vocabulary_terms(c):
    """[SRC-17]"""
    k = F.col("n_nationkey")
    return files.vocabulary_terms(c.table("nation").select(F.concat(F.lit("http://o.example/terms#T"), k.cast("string")).alias("iri"), F.when(k % 2 == 0, F.lower("n_name")).alias("label")))


# --- sinks ---------------------------------------------------------------------------------------


@query("SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'error' ELSE 'data' END AS kind, 's' || (o_orderkey % 3) AS supplier, '2024-01-01-07' AS hour, count(*) AS n FROM orders GROUP BY ALL", corpus=False)
def stored_references(c):
    """[SNK-01] Reference documents by supplier and hour, those with an empty reference apart, read back."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    ref = lambda text: F.struct(text.alias("bibentry"), *[none.alias(n) for n in ("process_entry", "localid", "doi", "pmid", "pmcid", "url", "xmlid")])
    docs = c.table("orders").select(F.concat(F.lit("10.1/"), k.cast("string")).alias("doi"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("supplier"), F.array(ref(F.lit("text")), ref(F.when(k % 5 != 0, F.lit("more")))).alias("references"))
    path = folder(c, "references")
    files.store_references(docs, path, "2024-01-01-07")
    read = lambda kind: c.spark.read.schema("doi string, supplier string, hour string").json(f"{path}/{kind}").select(F.lit(kind).alias("kind"), "supplier", "hour")
    return read("data").unionByName(read("error")).groupBy("kind", "supplier", "hour").agg(F.count("*").alias("n"))


@query(f"SELECT iri AS s, title AS o, 1 AS files FROM journal UNION ALL SELECT iri, seq_id, 1 FROM volume WHERE '{BASE}' <> ''")
def single_file(c):
    """[SNK-02] All quads in one file, read back."""
    quads = gr.triples(c.journal, "iri", {"title": ("title", "lit")}).unionByName(gr.triples(c.volume, "iri", {"seq_id": ("number", "lit")}))
    path = folder(c, "single")
    xt.single_file(quads, path)
    return files.read_statements(c.spark, path).withColumn("files", F.lit(c.spark.read.text(path).select(F.input_file_name()).distinct().count()).cast("int")).select("s", "o", "files")


@query("SELECT iri AS s, CASE WHEN n % 3 = 0 THEN '2024' ELSE '2020' END AS modified FROM (SELECT iri, CAST(seq_id AS INT) AS n FROM volume)")
def modified_dates(c):
    """[SNK-07] The modification date of what changes is taken out before the new one comes in."""
    none = F.lit(None).cast("string")
    dates = lambda rows, year: rows.select(none.alias("g"), F.col("iri").alias("s"), F.lit("modified").alias("p"), F.lit(year).alias("o"), F.lit("lit").alias("o_kind"), none.alias("o_dt"))
    old, new = dates(c.volume, "2020"), dates(c.volume.filter("cast(seq_id AS int) % 3 = 0"), "2024")
    return xt.insert_data(xt.delete_where(old, new, ["s", "p"]), new).select("s", F.col("o").alias("modified"))


@query("SELECT 'br' AS kind, count(*) AS statements, TRUE AS uploaded, FALSE AS marker FROM journal")
def staged_upload(c):
    """[SNK-08] Shards first, then all requests; no marker is left if both succeed."""
    from quillgraph.sources.workspace import exists

    quads, path = gr.triples(c.journal, "iri", {"title": ("title", "lit")}), folder(c, "staged")
    updates = quads.select(F.lit(0).cast("long").alias("batch"), "o").groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("o")), " ; ").alias("request"))
    done = files.store_and_upload(quads, updates, lambda request: True, path)
    return c.spark.read.parquet(f"{path}/shards").groupBy("kind").agg(F.count("*").alias("statements")).withColumns({"uploaded": F.lit(done), "marker": F.lit(exists(c.spark, f"{path}/_NOT_UPLOADED"))})


@query("SELECT n_nationkey::BIGINT AS batch, 'load ' || n_name AS request FROM nation WHERE n_nationkey % 4 = 1", corpus=False)
def dead_letters(c):
    """[SNK-09] Requests that the receiver refuses, kept and read back."""
    updates, path = c.table("nation").select(F.col("n_nationkey").cast("long").alias("batch"), F.concat(F.lit("load "), F.col("n_name")).alias("request")), folder(c, "dead")
    refused = {r["request"] for r in updates.filter("batch % 4 = 1").collect()}  # a few of 25 nations
    files.upload(updates, lambda request: request not in refused, path)
    return c.spark.read.schema("batch long, request string").json(path)


@query("SELECT 'shard' || c_custkey AS file, 'LOAD <file:shard' || c_custkey || '> INTO GRAPH <http://g/>' AS statement FROM customer WHERE c_custkey % 4 <> 0", corpus=False)
def pending_loads(c):
    """[SNK-11]"""
    files_ = c.table("customer").select(F.concat(F.lit("shard"), text_of("c_custkey")).alias("file"))
    return files.pending_loads(files_, c.table("customer").filter("c_custkey % 4 = 0").select(F.concat(F.lit("shard"), text_of("c_custkey")).alias("file")), "http://g/")


# --- pointers ------------------------------------------------------------------------------------


@query("""SELECT event_id, CASE WHEN user_id % 2 = 0 AND event_id % 3 <> 2 AND event_id % 5 > 0 THEN (event_id % 5 - 1)::INT ELSE (event_id % 5)::INT END AS sentence_no FROM events""", corpus=False)
def pointers_after_full_stop(c):
    """[PT-07] A bracket that opens a sentence belongs to the one before, unless the text goes on in lower case."""
    e, u = F.col("event_id"), F.col("user_id")
    rows = c.table("events").select("event_id", (e % 5).cast("int").alias("sentence_no"), F.when(u % 2 == 0, F.lit(". [")).otherwise("see ").alias("before"), F.when(e % 3 == 0, F.lit("] Next")).when(e % 3 == 1, F.lit("]")).otherwise("] and").alias("tail"), F.when(u % 2 == 0, F.lit("[1] Next")).otherwise("Text 1").alias("sentence"))
    return xt.list_before_bracket(rows).select("event_id", "sentence_no")


@query("SELECT DISTINCT sentence, context FROM (SELECT sentence, coalesce(list, iri) AS context FROM pointer)")
def context_links(c):
    """[PT-09] What a sentence is the context of: its lists, and its pointers outside of one."""
    return jats.context_links(c.pointer)


@query("""WITH p AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, CAST(floor(abs(value) * 100) AS BIGINT) % 6 AS v FROM events),
q AS (SELECT *, coalesce(lag(v) OVER (PARTITION BY user_id ORDER BY pos), 5) AS u FROM p), r AS (SELECT *, sum(CASE WHEN u <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos) AS n FROM q),
s AS (SELECT *, count(*) OVER (PARTITION BY user_id, n) AS k, max((u > 2)::INT) OVER (PARTITION BY user_id, n) AS o, max((v = 3)::INT) OVER (PARTITION BY user_id, n) AS c FROM r)
SELECT user_id::VARCHAR AS doc, CASE WHEN pos % 7 = 0 THEN 'in sequence' ELSE '' || pos END AS pointer, CASE WHEN k > 1 OR (o = 1 AND c = 1) THEN user_id || '#' || n ELSE 'not in list' END AS list FROM s""", corpus=False)
def grading_sheet(c):
    """[EV-08]"""
    rows = jats.pointer_lists(fake_pointers(c)).withColumns({"label": F.when(F.col("pos") % 7 != 0, text_of("pos")), "sentence": F.lit("")})
    return xt.grading_sheet(rows).drop("sentence")


# --- resolution ----------------------------------------------------------------------------------


@query("SELECT c_custkey::VARCHAR AS subject, n::INT AS n, c_custkey || '/prov/se/' || n AS iri FROM (SELECT c_custkey, 1 + c_custkey % 4 AS n FROM customer) WHERE c_custkey % 6 <> 0", corpus=False)
def latest_snapshots(c):
    """[RS-10] The last snapshot of each subject; those of a removal invalidate themselves."""
    k = F.col("c_custkey")
    rows = c.table("customer").select(text_of("c_custkey").alias("subject"), F.explode(F.sequence(F.lit(1), (1 + k % 4).cast("int"))).alias("n"), (k % 6 == 0).alias("gone"), (1 + k % 4).alias("last"))
    iri = lambda n: F.concat(F.col("subject"), F.lit("/prov/se/"), n.cast("string"))
    snapshots = rows.select("subject", "n", iri(F.col("n")).alias("iri"), F.when(F.col("n") > 1, iri(F.col("n") - 1)).alias("derived_from"), F.when((F.col("n") == F.col("last")) & F.col("gone"), iri(F.col("n"))).alias("invalidates"))
    return gr.latest(snapshots)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'own' WHEN o_orderkey % 3 = 0 THEN 'inner' WHEN o_orderkey % 5 = 0 THEN 'text' WHEN o_orderkey % 7 = 0 THEN 'rest' END AS res, CASE WHEN o_orderkey % 2 = 0 THEN 1 WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 7 = 0 THEN 4 END AS stage FROM orders", corpus=False)
def stage_order(c):
    """[RS-12]"""
    k = F.col("o_orderkey")
    stage = lambda n, name: c.table("orders").filter(k % n == 0).select(k.alias("ref"), F.lit(name).alias("res"))
    return rs.cascade(c.table("orders").select(k.alias("ref")), [(1, stage(2, "own")), (2, stage(3, "inner")), (3, stage(5, "text")), (4, stage(7, "rest"))]).select(F.col("ref").alias("o_orderkey"), "res", "stage")


@query("SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN 'doi' || p_partkey WHEN p_partkey % 2 = 0 THEN 'isbn' || p_partkey END AS res FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 0", corpus=False)
def record_in_store(c):
    """[RS-13] A record found by its text is looked up by its own identifiers, first known one first."""
    k, s = F.col("p_partkey"), text_of("p_partkey")
    key = lambda pos, scheme: c.table("part").select(k.alias("key"), F.lit(pos).alias("pos"), F.lit(scheme).alias("scheme"), s.alias("literal"))
    store = lambda n, scheme: c.table("part").filter(k % n == 0).select(F.lit(scheme).alias("scheme"), s.alias("literal"), F.concat(F.lit(scheme), s).alias("res"))
    return rs.first_hit(key(1, "doi").unionByName(key(2, "isbn")), store(3, "doi").unionByName(store(2, "isbn")))


def resolved(c):
    k = F.col("p_partkey")
    store = c.table("part").filter(k % 4 == 0).select(F.lit("doi").alias("scheme"), F.concat(F.lit("10.7/P"), k.cast("string")).alias("literal"), F.concat(F.lit("store/"), k.cast("string")).alias("res"))
    catalogue = c.table("part").filter(k % 4 == 1).select(F.concat(F.lit("10.7/P"), k.cast("string")).alias("doi"), F.concat(F.lit("catalogue/"), k.cast("string")).alias("key"))
    return rc.resolve_documents(records.documents(c), catalogue, store, c.spark.createDataFrame([], "citing string"))


@query("SELECT l_orderkey::VARCHAR AS doc, 'no DOI' AS error FROM lines WHERE l_orderkey % 9 = 0 GROUP BY l_orderkey")
def resolution_errors(c):
    """[RS-02, RS-16]"""
    return resolved(c)["errors"]


@query("SELECT DISTINCT 'catalogue/' || l_partkey AS res, 'doi' AS scheme, '10.7/p' || l_partkey AS literal FROM lines WHERE l_orderkey % 9 <> 0 AND l_linenumber % 3 = 0 AND l_partkey % 4 = 1")
def resolved_identifiers(c):
    """[RS-17, RS-08] DOIs given with a reference are new for what the store does not have yet."""
    return resolved(c)["identifiers"].select("res", "scheme", "literal")


@query("SELECT s_suppkey, [lower(s_name), 'none'][1 + s_suppkey % 2] AS name, (s_suppkey % 2)::INT AS distance FROM supplier", corpus=False)
def names_alike(c):
    """[NM-01, NM-02] The item of a list whose normalised name is the one looked for; the distance of two names is 0 or 1."""
    k, plain = F.col("s_suppkey"), tx.normalise_name(F.col("s_name"))
    rows = c.table("supplier").select("s_suppkey", "s_name", plain.alias("plain"), F.when(k % 2 == 0, tx.normalise_name(F.upper("s_name"))).otherwise("none").alias("wanted"))
    distance = tx.name_distance(F.col("plain"), F.col("wanted"))
    return rows.select("s_suppkey", F.when(distance == 0, F.lower("s_name")).otherwise("none").alias("name"), distance.alias("distance"))


# --- functions -----------------------------------------------------------------------------------


@query("SELECT p_partkey, replace(replace(url_encode(replace(p_name || ': ' || p_type, ':', ',')), '%3A', ':'), '%2F', '/') AS entry FROM part", corpus=False)
def clean_entries(c):
    """[SC-06]"""
    return c.table("part").select("p_partkey", tx.clean_entry(F.concat_ws(": ", "p_name", "p_type")).alias("entry"))


@query("SELECT p_partkey, p_name || '|~' AS names, CASE WHEN p_size % 2 = 0 THEN 'brand,size' ELSE 'brand' END AS keys, p_partkey % 3 = 0 AS blank, p_type || '|' || p_name AS picked FROM part", corpus=False)
def dict_paths(c):
    """[SC-08, SC-09, SC-10, SC-11] Paths through structs and arrays, maps without nulls, blank texts, elements by place."""
    k = F.col("p_partkey")
    items = F.array(F.struct(F.struct(F.col("p_name").alias("name")).alias("inner")), F.struct(F.lit(None).cast("struct<name: string>").alias("inner")))
    named = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.when(F.col("p_size") % 2 == 0, text_of("p_size")))
    return c.table("part").select(
        "p_partkey",
        F.array_join(xt.path_in(items, "inner", "name"), "|", "~").alias("names"),
        F.array_join(F.array_sort(F.map_keys(xt.without_nulls(named))), ",").alias("keys"),
        tx.is_blank(F.when(k % 3 == 0, "  ").otherwise(F.col("p_name"))).alias("blank"),
        F.array_join(xt.picked(F.array("p_name", "p_brand", "p_type"), F.array(F.lit(2), F.lit(0))), "|").alias("picked"),
    )


@query("SELECT p_partkey, [lower(p_brand), upper(p_brand)][1 + p_partkey % 2] AS doi FROM part", corpus=False)
def rest_preprocess(c):
    """[SC-26, UD-01] ``a__b`` as DOIs, in the case that the operation asks for."""
    rows = c.table("part").select("p_partkey", F.explode(tx.split_dois(F.concat_ws("__", F.lower("p_brand"), F.upper("p_brand")))).alias("doi"))
    return rows.filter(F.when(F.col("p_partkey") % 2 == 0, F.col("doi") == F.lower("doi")).otherwise(F.col("doi") == F.upper("doi")))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 AND s_nationkey IN (1, 3, 5) THEN '0' || s_nationkey || '0' ELSE '0990' END AS prefix FROM supplier", corpus=False)
def supplier_keys(c):
    """[SC-27] Prefixes of hosts by configuration, or the default one."""
    config = {"10.0.0.1": "010", "10.0.0.3": "030", "10.0.0.5": "050", "default": "0990"}
    rows = c.table("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("10.0.0."), text_of("s_nationkey"))).otherwise("elsewhere").alias("host"))
    prefix = F.coalesce(*[F.when(F.col("host") == h, F.lit(xt.supplier_key(config, h))) for h in config if h != "default"], F.lit(xt.supplier_key(config, "none")))
    return rows.select("s_suppkey", prefix.alias("prefix"))


@query("SELECT n_nationkey, lower(n_name) AS low, upper(left(n_name, 1)) || substr(n_name, 2) AS capital, CASE WHEN length(n_name) > 20 THEN left(n_name, 20) || '...' ELSE n_name END AS short FROM nation", corpus=False)
def heuristics(c):
    """[UD-02]"""
    h = xt.HEURISTICS
    return c.table("nation").select("n_nationkey", h["lower_case"](F.col("n_name")).alias("low"), h["capitalize_first"](F.col("n_name")).alias("capital"), h["short_version"](F.col("n_name")).alias("short"))


# --- graph updates, joins, REST ------------------------------------------------------------------


@query("SELECT iri AS s, title AS o FROM journal WHERE iri NOT LIKE '%2' UNION ALL SELECT iri, 'new' FROM volume WHERE CAST(seq_id AS INT) % 2 = 0")
def updated_statements(c):
    """[QA-19] Statements put in and taken out; the default graph cleared."""
    titled = gr.triples(c.journal, "iri", {"title": ("title", "lit")}).withColumn("g", F.lit("http://g/"))
    more = c.volume.filter("cast(seq_id AS int) % 2 = 0").select(F.lit("http://g/").alias("g"), F.col("iri").alias("s"), F.lit("p").alias("p"), F.lit("new").alias("o"), F.lit("lit").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"))
    loose = more.withColumn("g", F.lit(None).cast("string"))
    return xt.clear_default(xt.insert_data(xt.delete_data(titled, titled.filter("s LIKE '%2'")), more.unionByName(more).unionByName(loose))).select("s", "o")


@query("SELECT a.iri AS article, i.seq_id AS issue FROM article a JOIN issue i ON i.iri = a.part_of WHERE i.seq_id IN ('1', '2', '3')")
def small_side_first(c):
    """[QA-20] The side that proves to be small is joined first, by broadcast."""
    small = xt.small_first(c.issue.filter("seq_id IN ('1', '2', '3')").select(F.col("iri").alias("part_of"), F.col("seq_id").alias("issue")))
    return c.article.join(small, "part_of").select(F.col("iri").alias("article"), "issue")


@query("SELECT 'a b/' || p_partkey AS doi, max(p_size)::BIGINT AS size FROM part GROUP BY p_partkey", corpus=False)
def rest_postprocess(c):
    """[RO-05, RO-18] Decoded DOIs, and the first row of each."""
    k = text_of("p_partkey")
    t = c.table("part").select(F.concat(F.lit("a%20b/"), k).alias("doi"), text_of("p_size").alias("size"))
    operation = rest.Operation(build=lambda _: t.unionByName(t), types={"size": "int"}, postprocess=[lambda d: rest.decoded(d, "doi"), lambda d: rest.distinct_by(d, "doi", "size")])
    return operation("all")


@query("SELECT * FROM (VALUES (0, 'type', 'api'), (0, 'url', '/v1'), (1, 'description', 'Two' || chr(10) || 'lines'), (1, 'dois', 'str(10\\..+)'), (1, 'type', 'operation'), (1, 'url', '/metadata/{dois}')) t(section, name, value)".replace("\\\\", "\\"), corpus=False)
def rest_spec(c):
    """[RO-01]"""
    spec = rest.parse_spec("#url /v1\n#type api\n\n#url /metadata/{dois}\n#type operation\n#dois str(10\\..+)\n#description Two\nlines")
    return c.spark.createDataFrame([(i, k, v) for i, fields in enumerate(spec) for k, v in fields.items()], "section int, name string, value string")


# --- streaming -----------------------------------------------------------------------------------


def ingested(c) -> str:
    """Orders as a queue of documents, worked off in batches; one in seven has an empty reference, one in nine no DOI, and a tenth comes twice."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    ref = F.struct(F.when(k % 7 != 0, F.lit("text")).alias("bibentry"), *[none.alias(n) for n in ("process_entry", "localid", "doi", "pmid", "pmcid", "url", "xmlid")])
    docs = c.table("orders").select(F.when(k % 9 != 0, F.concat(F.lit("10.1/"), k.cast("string"))).alias("doi"), F.concat(F.lit("L"), k.cast("string")).alias("localid"), F.array(ref).alias("references"))
    root = folder(c, "queue")
    docs.repartition(6).write.option("ignoreNullFields", "false").json(f"{root}/todo")
    queue.run(c.spark, f"{root}/todo", f"{root}/work", files_per_batch=2, whole_files=False)
    docs.filter(k % 10 == 0).coalesce(1).write.mode("append").option("ignoreNullFields", "false").json(f"{root}/todo")
    queue.run(c.spark, f"{root}/todo", f"{root}/work", files_per_batch=2, whole_files=False)
    return f"{root}/work"


@query("SELECT '10.1/' || o_orderkey AS doi, (SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0) AS numbers, (SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0) AS last FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0", corpus=False)
def queue_ingest(c):
    """[ST-01..06] What the queue has done: each document once, numbers without gaps over batches and runs."""
    done = c.spark.read.parquet(f"{ingested(c)}/done")
    edges = done.agg(F.countDistinct("num").alias("numbers"), F.max("num").alias("last")).withColumn("__one", F.lit(1))
    return done.withColumn("__one", F.lit(1)).join(F.broadcast(edges), "__one").select("doi", "numbers", "last")


@query("SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'L' || o_orderkey ELSE '10.1/' || o_orderkey END AS key FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 9 = 0", corpus=False)
def queue_failed(c):
    """[ST-02, ST-03] Documents without a DOI or with an empty reference; those that come again fail again, and count once here."""
    return c.spark.read.parquet(f"{ingested(c)}/failed").select("key").distinct()


# --- evaluation ----------------------------------------------------------------------------------


@query("SELECT CASE WHEN l_linenumber % 3 = 0 THEN '10.7/P' || l_partkey ELSE '' END AS explicit_doi, CASE WHEN l_linenumber % 3 = 1 THEN 'See 10.7/P' || l_partkey || '.' WHEN l_linenumber % 3 = 2 THEN 'No identifier' ELSE '' END AS bibref FROM lines")
def flat_references(c):
    """[EV-05]"""
    return ev.flat_references(records.documents(c))


@query("SELECT * FROM (VALUES ('nations', 25::BIGINT), ('regions', 5::BIGINT)) t(name, n)", corpus=False)
def timed_queries(c):
    """[EV-06] Names and rows of timed queries; the seconds are left out here."""
    found = xt.timed({"nations": lambda: c.table("nation"), "regions": lambda: c.table("region")})
    return c.spark.createDataFrame([(name, n) for name, _, n in found], "name string, n long")


@query("SELECT t::DOUBLE AS threshold, count_if(s >= t)::BIGINT AS covered, count_if(s < t)::BIGINT AS missing FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE (p_partkey % 10) / 10 END AS s FROM part), (VALUES (0.25), (0.5), (0.75)) v(t) GROUP BY t", corpus=False)
def vocabulary_coverage(c):
    """[EV-09]"""
    k = F.col("p_partkey")
    near = c.table("part").filter(k % 4 != 0).select(k.alias("term"), F.explode(F.array((k % 10) / 10.0, F.lit(0.0))).alias("similarity"))
    return ev.coverage(c.table("part").select(k.alias("term")), near, [0.25, 0.5, 0.75])


@query("SELECT p_partkey, 0.75::DOUBLE AS similarity FROM part WHERE p_partkey % 2 = 0", corpus=False)
def term_similarity(c):
    """[TXT-04] Terms of two words: one is the same, the other half as near, as a lexicon says."""
    k = text_of("p_partkey")
    pairs = c.table("part").select(F.concat(F.lit("word"), k, F.lit(" cat")).alias("a"), F.concat(F.lit("word"), k, F.when(F.col("p_partkey") % 2 == 0, F.lit(" feline")).otherwise(" tree"), F.when(F.col("p_partkey") % 2 == 0, F.lit("")).otherwise(" stone oak")).alias("b"))
    lexicon = c.spark.createDataFrame([("cat", "feline", 0.5)], "x string, y string, similarity double")
    found = mt.sentence_similarity(pairs, lexicon, 0.5)
    return found.select(F.regexp_extract("a", "word([0-9]+)", 1).cast("long").alias("p_partkey"), "similarity")
