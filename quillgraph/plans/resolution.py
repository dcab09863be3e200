"""Queries of entity resolution, quads, updates and provenance over the corpus, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.operators import graph as gr
from quillgraph.operators import resolve as rs
from quillgraph.plans.corpus import PREFIX, Corpus
from quillgraph.schema import BASE, PREDICATES, expand

QUERIES, SQL = {}, {}
TIME = "2024-05-01T12:00:00"


def query(sql: str | None = None, corpus: bool = True):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Corpus(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PREFIX + sql if corpus else sql
        return f

    return put


def _references(c):
    """Each line item as a reference of its order: with a DOI, or only an ISBN, or neither, by its number."""
    l = c.lines  # noqa: E741
    k = F.col("l_linenumber")
    return l.select(
        F.concat_ws("-", "l_orderkey", "pos").alias("ref"),
        F.col("l_orderkey").alias("doc"),
        "pos",
        F.when(k % 3 == 0, F.concat(F.lit("10.1234/"), F.col("l_suppkey").cast("string"))).alias("doi"),
        F.when(k % 3 != 1, F.concat(F.lit("978-"), F.col("l_partkey").cast("string"))).alias("isbn"),
    )


REFS = """, refs AS (SELECT l_orderkey || '-' || pos AS ref, l_orderkey AS doc, pos, CASE WHEN l_linenumber % 3 = 0 THEN '10.1234/' || l_suppkey END AS doi, CASE WHEN l_linenumber % 3 <> 1 THEN '978-' || l_partkey END AS isbn FROM lines) """


@query(REFS + "SELECT r.ref, coalesce(d.owner, i.owner) AS res, CASE WHEN d.owner IS NOT NULL THEN 1 WHEN i.owner IS NOT NULL THEN 2 END AS stage FROM refs r LEFT JOIN (SELECT * FROM ident WHERE scheme = 'doi') d ON d.literal = r.doi LEFT JOIN (SELECT * FROM ident WHERE scheme = 'isbn') i ON i.literal = r.isbn")
def id_lookup_cascade(c):
    """[RS-03, RS-11]"""
    refs = _references(c)
    found = lambda s: refs.select("ref", F.col(s).alias("literal")).join(c.ident.filter(F.col("scheme") == s).select("literal", F.col("owner").alias("res")), "literal")
    return rs.cascade(refs, [(1, found("doi")), (2, found("isbn"))]).select("ref", "res", "stage")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN owner ELSE owner END AS res, CASE WHEN o_orderkey % 2 = 0 THEN 'batch' WHEN owner IS NOT NULL THEN 'store' END AS found_in FROM orders LEFT JOIN ident ON scheme = 'doi' AND literal = '10.1234/' || o_orderkey")
def lookup_batch_then_store(c):
    """[RS-03, SRC-08] Even orders are in the batch's index, all in the store's."""
    refs = c.table("orders").select("o_orderkey", F.lit("doi").alias("scheme"), F.concat(F.lit("10.1234/"), F.col("o_orderkey").cast("string")).alias("literal"))
    store = c.ident.select("scheme", "literal", F.col("owner").alias("res"))
    batch = store.filter("scheme = 'doi' AND CAST(substring(literal, 9, 20) AS BIGINT) % 2 = 0")
    return rs.lookup(refs, batch, store).select("o_orderkey", "res", "found_in")


@query(REFS + "SELECT key, min_by(res, p) AS res FROM (SELECT r.ref AS key, i.owner AS res, 1 AS p FROM refs r JOIN ident i ON i.scheme = 'isbn' AND i.literal = r.isbn UNION ALL SELECT r.ref, i.owner, 2 FROM refs r JOIN ident i ON i.scheme = 'doi' AND i.literal = r.doi) GROUP BY key")
def multi_id_first_hit(c):
    """[RS-04]"""
    ids = F.array(F.struct(F.lit(1).alias("pos"), F.lit("isbn").alias("scheme"), F.col("isbn").alias("literal")), F.struct(F.lit(2).alias("pos"), F.lit("doi").alias("scheme"), F.col("doi").alias("literal")))
    keys = _references(c).select(F.col("ref").alias("key"), F.explode(ids).alias("x")).select("key", "x.pos", "x.scheme", "x.literal").filter("literal IS NOT NULL")
    return rs.first_hit(keys, c.ident.select("scheme", "literal", F.col("owner").alias("res")))


@query("""SELECT res, scheme, literal FROM (SELECT *, row_number() OVER (PARTITION BY res ORDER BY ord, literal) AS rn2 FROM (SELECT 'order/' || l_orderkey AS res, 'doi' AS scheme, 'claim/' || l_partkey AS literal, l_orderkey * 1000 + pos AS ord,
row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 1000 + pos, 'order/' || l_orderkey) AS rn FROM lines WHERE l_partkey % 10 <> 0 AND l_orderkey % 50 <> 0) WHERE rn = 1) WHERE rn2 = 1""")
def first_writer_ids(c):
    """[RS-08] Orders claim the parts of their lines; one in ten literals and one in fifty orders are taken already."""
    claims = c.lines.select(F.concat(F.lit("order/"), F.col("l_orderkey").cast("string")).alias("res"), F.lit("doi").alias("scheme"), F.concat(F.lit("claim/"), F.col("l_partkey").cast("string")).alias("literal"), (F.col("l_orderkey") * 1000 + F.col("pos")).alias("ord"))
    taken = c.table("part").filter("p_partkey % 10 = 0").select(F.lit("old").alias("res"), F.lit("isbn").alias("x"), F.lit("doi").alias("scheme"), F.concat(F.lit("claim/"), F.col("p_partkey").cast("string")).alias("literal")).drop("x")
    have = c.table("orders").filter("o_orderkey % 50 = 0").select(F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("res"), F.lit("doi").alias("scheme"), F.concat(F.lit("own/"), F.col("o_orderkey").cast("string")).alias("literal"))
    return rs.first_writers(claims, taken.unionByName(have)).select("res", "scheme", "literal")


@query("SELECT l_orderkey AS doc, pos, match, (match IS NOT NULL AND match <> l_orderkey % 100 AND row_number() OVER (PARTITION BY l_orderkey, match ORDER BY stage, pos) = 1) AS considered FROM (SELECT *, CASE WHEN l_linenumber <> 4 THEN l_suppkey END AS match, l_linenumber % 3 AS stage FROM lines)")
def keep_best(c):
    """[RS-14]"""
    m = c.lines.select(F.col("l_orderkey").alias("doc"), (F.col("l_orderkey") % 100).alias("citing"), "pos", (F.col("l_linenumber") % 3).alias("stage"), F.when(F.col("l_linenumber") != 4, F.col("l_suppkey")).alias("match"))
    return rs.keep_best(m).select("doc", "pos", "match", "considered")


@query("SELECT a.iri AS article, v.seq_id AS volume, i.seq_id AS issue, v.part_of AS journal FROM article a JOIN issue i ON i.iri = a.part_of JOIN volume v ON v.iri = i.part_of")
def volume_issue_lookup(c):
    """[RS-07]"""
    i = c.issue.select(F.col("iri").alias("i"), F.col("seq_id").alias("issue"), F.col("part_of").alias("v"))
    v = c.volume.select(F.col("iri").alias("v"), F.col("seq_id").alias("volume"), F.col("part_of").alias("journal"))
    return c.article.select(F.col("iri").alias("article"), F.col("part_of").alias("i")).join(i, "i").join(v, "v").select("article", "volume", "issue", "journal")


@query("SELECT br, pos, iri AS role, next FROM role")
def role_chain(c):
    """[RS-26]"""
    return rs.role_chain(c.role.select("br", "pos", F.col("iri").alias("role")))


@query("""SELECT br, pos, orcid FROM (
WITH x AS (SELECT DISTINCT '' || l_orderkey AS br, pos, 'f' || (l_suppkey % 3) AS family, chr(97 + (l_partkey % 4)::INT) || (l_partkey % 7) AS given FROM lines),
k AS (SELECT DISTINCT '' || l_orderkey AS br, 'o' || l_suppkey AS orcid, 'f' || (l_suppkey % 3) AS family, min(chr(97 + (l_partkey % 4)::INT) || (l_partkey % 7)) AS given FROM lines WHERE pos % 2 = 0 GROUP BY l_orderkey, l_suppkey),
p AS (SELECT x.br, x.pos, x.family, k.orcid, x.given AS g1, k.given AS g2 FROM x JOIN k USING (br, family)),
n AS (SELECT br, family, count(DISTINCT pos) AS n1, count(DISTINCT orcid) AS n2 FROM p GROUP BY ALL),
d AS (SELECT p.*, (g1 <> g2)::INT AS d FROM p JOIN n USING (br, family) WHERE (n1 > 1 OR n2 > 1) AND left(g1, 1) = left(g2, 1)),
e AS (SELECT * FROM (SELECT *, min(d) OVER (PARTITION BY br, pos) AS m1, min(d) OVER (PARTITION BY br, orcid) AS m2 FROM d) WHERE d = m1 AND d = m2),
f AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY br, pos) AS c1, count(*) OVER (PARTITION BY br, orcid) AS c2 FROM e) WHERE c1 = 1 AND c2 = 1)
SELECT br, pos, orcid FROM p JOIN n USING (br, family) WHERE n1 = 1 AND n2 = 1 UNION ALL SELECT br, pos, orcid FROM f)""")
def author_match(c):
    """[RS-24, NM-03]"""
    given = F.concat(F.chr(97 + F.col("l_partkey") % 4), (F.col("l_partkey") % 7).cast("string"))
    family = F.concat(F.lit("f"), (F.col("l_suppkey") % 3).cast("string"))
    rows = c.lines.select(F.col("l_orderkey").cast("string").alias("br"), "pos", F.concat(F.lit("o"), F.col("l_suppkey").cast("string")).alias("orcid"), family.alias("family"), given.alias("given"))
    known = rows.filter("pos % 2 = 0").groupBy("br", "orcid", "family").agg(F.min("given").alias("given"))
    return rs.match_authors(rows.select("br", "pos", "family", "given"), known)


@query("""SELECT child, parent FROM (
WITH w AS (SELECT iri AS work, (c_custkey % 5)::VARCHAR AS journal, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey::VARCHAR END AS volume, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 40)::VARCHAR END AS issue FROM customer JOIN issue ON seq_id = c_custkey::VARCHAR),
k AS (SELECT *, journal || '|' || volume AS vkey, CASE WHEN issue IS NOT NULL THEN journal || '|' || coalesce(volume, '') || '|' || issue END AS ikey FROM w)
SELECT work AS child, coalesce(ikey, vkey, journal) AS parent FROM k UNION ALL SELECT DISTINCT ikey, coalesce(vkey, journal) FROM k WHERE ikey IS NOT NULL UNION ALL SELECT DISTINCT vkey, journal FROM k WHERE vkey IS NOT NULL)""")
def container_dims(c):
    """[RS-30, RS-31] Part-of edges of works with journal and volume, issue, both or neither."""
    k = F.col("c_custkey")
    works = c.table("customer").select(
        F.concat(F.lit(f"{BASE}br/030"), (k + 1).cast("string")).alias("work"), (k % 5).cast("string").alias("journal"), F.when(k % 3 != 0, F.col("c_nationkey").cast("string")).alias("volume"), F.when(k % 2 == 0, (k % 40).cast("string")).alias("issue")
    )
    return rs.containers(works)[3]


@query("SELECT 'br' AS kind, count(*) AS n, 1001 AS first, 1000 + count(*) AS last, count(*) AS distinct_numbers FROM orders UNION ALL SELECT 'ra', count(*), 1, count(*), count(*) FROM supplier", corpus=False)
def new_ids(c):
    """[RS-35] Numbers go on from the last one of each class, without gaps and repeats; which row gets which is free."""
    rows = c.table("orders").select(F.lit("br").alias("kind"), F.col("o_orderkey").cast("string").alias("key")).unionByName(c.table("supplier").select(F.lit("ra").alias("kind"), F.col("s_suppkey").cast("string").alias("key")))
    last = c.spark.sql("SELECT 'br' AS kind, 1000L AS last")
    out = rs.numbered(rows, last, "kind", [F.col("key")])
    return out.groupBy("kind").agg(F.count("*").alias("n"), F.min("num").alias("first"), F.max("num").alias("last"), F.countDistinct("num").alias("distinct_numbers"))


@query("SELECT o_orderkey AS article FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey % 7 = 0 AND c_custkey = o_custkey)", corpus=False)
def already_processed(c):
    """[EX-08] Articles without any stored id."""
    articles = c.table("orders").select(F.col("o_orderkey").alias("article"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("doi"), F.lit(None).cast("string").alias("pmid"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("localid"))
    stored = c.table("customer").filter("c_custkey % 7 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"))
    return rs.already_stored(articles, stored, ["doi", "pmid", "localid"]).select("article")


@query("SELECT s_suppkey, ['0110', '0120', '0130'][1 + CAST((row_number() OVER (ORDER BY s_suppkey) - 1) % 3 AS INT)] AS supplier FROM supplier", corpus=False)
def round_robin_supplier(c):
    """[EX-11]"""
    return rs.round_robin(c.table("supplier").select("s_suppkey"), "s_suppkey", ["0110", "0120", "0130"])


@query("SELECT l_orderkey, pos FROM lines WHERE l_orderkey <> l_partkey")
def self_citation_drop(c):
    """[EX-07]"""
    return rs.without_self_citations(c.lines, "l_orderkey", "l_partkey").select("l_orderkey", "pos")


@query("SELECT l_orderkey AS doc, pos, bool_or(l_linenumber = 5 AND l_suppkey % 10 = 0) OVER (PARTITION BY l_orderkey) AS error FROM lines")
def poisoned_list_route(c):
    """[EX-10]"""
    filled = F.when(~((F.col("l_linenumber") == 5) & (F.col("l_suppkey") % 10 == 0)), F.lit("x"))
    return rs.poisoned(c.lines.select(F.col("l_orderkey").alias("doc"), "pos", filled.alias("doi"), F.lit(None).cast("string").alias("url")), ["doi", "url"]).select("doc", "pos", "error")


# --- quads ---------------------------------------------------------------------------------------


def statements(c):
    """The corpus' works, identifiers and citations as quads, repeated where the tables repeat rows."""
    works = gr.triples(c.br, "iri", {"title": ("title", "lit"), "subtitle": ("subtitle", "lit"), "pub_date": ("date", "lit"), "seq_id": ("number", "lit"), "part_of": ("part_of", "iri")})
    ids = gr.triples(c.ident, "iri", {"literal": ("literal", "lit")})
    return gr.union(gr.type_triples(c.br, "br"), works, gr.type_triples(c.ident, "id"), ids, gr.triples(c.ident, "owner", {"iri": ("has_id", "iri")}), gr.triples(c.cites, "citing", {"cited": ("cites", "iri")}))


def quads(c):
    return gr.once(statements(c))


_P = {k: expand(v) for k, v in PREDICATES.items()}
QUADS_SQL = (
    ", t AS (SELECT iri AS s, '" + _P["type"] + "' AS p, 'http://purl.org/spar/fabio/Expression' AS o, 'iri' AS o_kind FROM br UNION ALL SELECT iri, '" + _P["type"] + "', 'http://purl.org/spar/datacite/Identifier', 'iri' FROM ident"
    + "".join(f" UNION ALL SELECT iri, '{_P[p]}', {col}, '{kind}' FROM br WHERE trim({col}) <> ''" for col, p, kind in (("title", "title", "lit"), ("subtitle", "subtitle", "lit"), ("pub_date", "date", "lit"), ("seq_id", "number", "lit"), ("part_of", "part_of", "iri")))
    + f" UNION ALL SELECT iri, '{_P['literal']}', literal, 'lit' FROM ident UNION ALL SELECT owner, '{_P['has_id']}', iri, 'iri' FROM ident UNION ALL SELECT citing, '{_P['cites']}', cited, 'iri' FROM cites), "
    + "quads AS (SELECT DISTINCT regexp_extract(s, '^(.+/[a-z]{2}/)[0-9]+$', 1) AS g, s, p, o, o_kind FROM t) "
)


@query(QUADS_SQL + "SELECT g, s, p, o, o_kind FROM quads")
def quads_export(c):
    """[G-01..07, QA-18]"""
    return quads(c).select("g", "s", "p", "o", "o_kind")


@query(QUADS_SQL + "SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '\"' || o || '\"' END || ' <' || g || '> .' AS line FROM quads")
def nquads_lines(c):
    """[SNK-04, SNK-10]"""
    return quads(c).select(gr.ntriples(with_graph=True).alias("line"))


@query(QUADS_SQL + f"SELECT p, o FROM quads WHERE s = '{BASE}br/0407'")
def construct_entity(c):
    """[QA-18]"""
    from quillgraph.operators.algebra import construct

    return construct(quads(c), c.spark.createDataFrame([(f"{BASE}br/0407",)], "s string")).select("p", "o")


@query("SELECT change, count(*) AS n, min(s) AS first FROM (SELECT 'added' AS change, iri AS s FROM article WHERE title IS NOT NULL AND right(iri, 1) = '3' UNION ALL SELECT 'removed', iri FROM article WHERE title IS NOT NULL AND right(iri, 1) IN ('3', '8')) GROUP BY change")
def graph_diff(c):
    """[G-09] Titles that end in 3 change and those that end in 8 go."""
    old = gr.triples(c.article, "iri", {"title": ("title", "lit")})
    new = gr.triples(c.article.filter("right(iri, 1) <> '8'").withColumn("title", F.when(F.col("iri").endswith("3"), F.concat("title", F.lit(" revised"))).otherwise(F.col("title"))), "iri", {"title": ("title", "lit")})
    added, removed = gr.diff(new, old)
    return added.select(F.lit("added").alias("change"), "s").unionByName(removed.select(F.lit("removed").alias("change"), "s")).groupBy("change").agg(F.count("*").alias("n"), F.min("s").alias("first"))


@query(f"""SELECT subject, before + 1 AS n, '{TIME}' AS generated, CASE WHEN before > 0 THEN subject || '/prov/se/' || before END AS derived_from, CASE WHEN removed THEN subject || '/prov/se/' || (before + 1) WHEN before > 0 THEN subject || '/prov/se/' || before END AS invalidates,
'The entity ''' || subject || ''' has been ' || CASE WHEN removed THEN 'deleted' WHEN before = 0 THEN 'created' ELSE 'extended' END || '.' AS description FROM (SELECT iri AS subject, k % 3 AS before, k % 11 = 0 AS removed FROM (SELECT iri, CAST(seq_id AS BIGINT) AS k FROM issue))""")
def snapshots(c):
    """[G-08, G-10]"""
    k = F.col("seq_id").cast("long")
    changed = c.issue.select(F.col("iri").alias("subject"), (k % 11 == 0).alias("removed"), F.lit("br").alias("kind"))
    last = c.issue.filter(k % 3 > 0).select(F.col("iri").alias("subject"), F.explode(F.sequence(F.lit(1), (k % 3).cast("int"))).alias("n"))
    return gr.snapshots(changed, last, TIME).withColumn("n", F.col("n").cast("long"))


@query(f"SELECT s, citations, identifiers, others FROM (SELECT iri AS s, EXISTS (SELECT 1 FROM cites WHERE citing = iri) AS citations, type IN ('JournalArticle', 'Journal', 'Book') AS identifiers, TRUE AS others FROM br UNION ALL SELECT iri, FALSE, FALSE, TRUE FROM ident UNION ALL SELECT iri, FALSE, TRUE, FALSE FROM agent)")
def update_flags(c):
    """[G-11]"""
    return gr.touches(quads(c))


MERGE_SQL = f"""SELECT s, p, o FROM (WITH m AS (SELECT '{BASE}br/050' || (p_partkey + 1) AS old, '{BASE}br/050' || p_partkey AS new FROM part WHERE p_partkey % 20 = 1)
SELECT DISTINCT q.s, q.p, coalesce(CASE WHEN q.o_kind = 'iri' THEN m.new END, q.o) AS o FROM quads q LEFT JOIN m ON m.old = q.o
WHERE q.s NOT IN (SELECT old FROM m) AND q.s NOT IN (SELECT i.iri FROM ident i JOIN m ON m.old = i.owner))"""


@query(QUADS_SQL + MERGE_SQL)
def merge_redirect(c):
    """[G-14] Every twentieth book is merged into the one before it; its identifier goes with it."""
    k = F.col("p_partkey")
    mapping = c.table("part").filter(k % 20 == 1).select(F.concat(F.lit(f"{BASE}br/050"), (k + 1).cast("string")).alias("old"), F.concat(F.lit(f"{BASE}br/050"), k.cast("string")).alias("new"))
    # The graph of a quad is that of its subject, so it tells no two apart.
    return gr.merge(statements(c).drop("g"), mapping).select("s", "p", "o")


@query("""SELECT work, pos, id, kept FROM (WITH i AS (SELECT l_orderkey AS work, pos, 'id' || l_orderkey || '.' || pos AS id, 'd' || l_partkey AS literal, l_partkey % 3 = 0 AS ok FROM lines),
b AS (SELECT work, arg_min(id, pos) AS keep FROM i WHERE ok GROUP BY work) SELECT i.work, i.pos, i.id, i.id = b.keep AS kept FROM i JOIN b USING (work) WHERE (SELECT count(*) FROM i j WHERE j.work = i.work) > 1)""")
def duplicate_id_repair(c):
    """[G-16]"""
    ids = c.lines.select(F.col("l_orderkey").alias("work"), "pos", F.concat(F.lit("id"), F.concat_ws(".", "l_orderkey", "pos")).alias("id"), F.concat(F.lit("d"), F.col("l_partkey").cast("string")).alias("literal"))
    valid = c.table("part").filter("p_partkey % 3 = 0").select(F.concat(F.lit("d"), F.col("p_partkey").cast("string")).alias("literal"))
    kept, removed = gr.repair_duplicates(ids, valid)
    return kept.withColumn("kept", F.lit(True)).unionByName(removed.withColumn("kept", F.lit(False))).select("work", "pos", "id", "kept")


@query(f"""SELECT (k - 1) // 10 AS batch, string_agg('INSERT DATA {{ GRAPH <{BASE}br/> {{ <' || iri || '> <{_P['number']}> "' || seq_id || '" . }} }}', ' ; ' ORDER BY k) AS request, CAST(count(*) AS INT) AS n FROM (SELECT *, CAST(seq_id AS BIGINT) + 1 AS k FROM issue) GROUP BY batch""")
def update_batches(c):
    """[SNK-05, SNK-06]"""
    lines = gr.triples(c.issue, "iri", {"seq_id": ("number", "lit")})
    number = F.regexp_extract("s", "/030([0-9]+)$", 1).cast("long")
    return gr.update_batches(gr.update_text(lines).withColumn("k", number), "k")


@query(f"SELECT * FROM (VALUES ('{BASE}br/', 'modified', '{TIME}'), ('{BASE}id/', 'modified', '{TIME}'), ('{BASE}ra/', 'modified', '{TIME}'), ('{BASE}', 'subset', '{BASE}id/'), ('{BASE}', 'subset', '{BASE}ra/'), ('{BASE}id/', 'title', 'Dataset of id'), ('{BASE}ra/', 'title', 'Dataset of ra')) v(s, p, o)", corpus=False)
def dataset_metadata(c):
    """[G-13]"""
    return gr.dataset_metadata(quads(c), c.spark.createDataFrame([(f"{BASE}br/",)], "g string"), TIME)


@query("SELECT iri, scheme, CASE WHEN scheme = 'doi' THEN lower(literal || 'X') ELSE literal || 'X' END AS literal FROM ident")
def lower_identifiers(c):
    """[G-15]"""
    return gr.lower_identifiers(c.ident.withColumn("literal", F.concat("literal", F.lit("X")))).select("iri", "scheme", "literal")
