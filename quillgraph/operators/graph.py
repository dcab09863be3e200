"""Quads, updates, diffs, merges, repairs and provenance [G-*, SNK-*]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.algebra import first_by
from quillgraph.schema import BASE, CLASSES, PREDICATES, expand
from quillgraph.sources.workspace import small, written


def triples(df: DataFrame, subject: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """[G-01..06] Unpivots columns to quads: ``{column: (predicate name, kind)}``, kind lit or iri; blanks and nulls make none.

    Each entity's graph is that of its class.
    """
    rows = [[F.lit(expand(PREDICATES[p])).alias("p"), F.col(c).cast("string").alias("o"), F.lit(kind).alias("o_kind")] for c, (p, kind) in fields.items()]
    of = [graph_of(F.col(subject)).alias("g"), F.col(subject).alias("s")]
    out = df.select(*of, *rows[0]) if len(rows) == 1 else df.select(*of, F.explode(F.array(*[F.struct(*r) for r in rows])).alias("x")).select("g", "s", "x.p", "x.o", "x.o_kind")
    return out.filter(F.trim("o") != "").withColumn("o_dt", F.lit(None).cast("string"))


def graph_of(iri: Column) -> Column:
    return F.regexp_extract(iri, "^(.+/[a-z]{2}/)[0-9]+$", 1)


def type_triples(df: DataFrame, kind: str, subject: str = "iri") -> DataFrame:
    """[G-02]"""
    return df.select(graph_of(F.col(subject)).alias("g"), F.col(subject).alias("s"), F.lit(expand(PREDICATES["type"])).alias("p"), F.lit(expand(CLASSES[kind])).alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"))


def union(*quads: DataFrame) -> DataFrame:
    out = quads[0]
    for q in quads[1:]:
        out = out.unionByName(q)
    return out


def as_set(*quads: DataFrame) -> DataFrame:
    """Union with set semantics."""
    return once(union(*quads))


def once(quads: DataFrame) -> DataFrame:
    """``quads`` with set semantics; literals of two datatypes are two.

    All columns of a quad are keys: a column that is only carried along, as a
    string is, would have Spark sort the rows.
    """
    return quads.dropDuplicates([c for c in ("g", "s", "p", "o", "o_kind", "o_dt") if c in quads.columns])


def escaped(value: Column) -> Column:
    """A literal's text as N-Triples has it."""
    out = value
    for old, new in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def ntriples(with_graph: bool = False) -> Column:
    """[SNK-04] The line of a quad, without its end."""
    literal = F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), F.when(F.col("o_dt").isNotNull(), F.concat(F.lit("^^<"), F.col("o_dt"), F.lit(">"))).otherwise(""))
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(literal)
    g = F.when(F.col("g").isNotNull() & F.lit(with_graph), F.concat(F.lit(" <"), F.col("g"), F.lit(">"))).otherwise("")
    return F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), o, g, F.lit(" ."))


def update_text(quads: DataFrame, verb: str = "INSERT", per: str = "s") -> DataFrame:
    """[SNK-05] g, <per>, update: one ``INSERT DATA`` or ``DELETE DATA`` for each entity, in order of its lines."""
    lines = quads.withColumn("line", ntriples()).groupBy("g", per).agg(F.array_join(F.array_sort(F.collect_list("line")), " ").alias("body"))
    inner = F.when(F.col("g").isNotNull(), F.concat(F.lit("GRAPH <"), F.col("g"), F.lit("> { "), F.col("body"), F.lit(" }"))).otherwise(F.col("body"))
    return lines.select("g", per, F.concat(F.lit(f"{verb} DATA {{ "), inner, F.lit(" }")).alias("update"))


def update_batches(updates: DataFrame, number: str, size: int = 10) -> DataFrame:
    """[SNK-06] batch, request, n: updates of ``size`` consecutive numbers (from 1) joined to a request."""
    rows = updates.withColumn("batch", F.floor((F.col(number) - 1) / size))
    out = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), "update"))).alias("all"))
    return out.select("batch", F.array_join(F.transform("all", lambda x: x["update"]), " ; ").alias("request"), F.size("all").alias("n"))


def diff(new: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[G-09] Added and removed statements; entity graphs have no blank nodes, so set difference is enough."""
    keys = ["g", "s", "p", "o", "o_kind"]
    return new.join(old.select(*keys), keys, "left_anti"), old.join(new.select(*keys), keys, "left_anti")


def touches(quads: DataFrame) -> DataFrame:
    """[G-11] s with what an update of it touches: citations, identifiers, others."""
    cites, ids = expand(PREDICATES["cites"]), expand(PREDICATES["has_id"])
    return quads.groupBy("s").agg(F.bool_or(F.col("p") == cites).alias("citations"), F.bool_or(F.col("p") == ids).alias("identifiers"), F.bool_or(~F.col("p").isin(cites, ids)).alias("others"))


def snapshots(changed: DataFrame, last: DataFrame, time: str) -> DataFrame:
    """[G-08, G-10, RS-10] subject, n, generated, derived_from, invalidates, description of the next snapshot of each changed subject.

    ``changed`` has subject, removed and kind, ``last`` subject and n of the latest
    snapshots. The first snapshot of a subject, and any of what is not a br, is a
    creation; later ones derive from the one before and invalidate it; the
    snapshot of a removal invalidates itself too.
    """
    rows = changed.join(last.groupBy("subject").agg(F.max("n").alias("before")), "subject", "left")
    n = F.coalesce("before", F.lit(0)) + 1
    created = (n == 1) | (F.col("kind") != "br")
    iri = lambda k: F.concat(F.col("subject"), F.lit("/prov/se/"), k.cast("string"))
    text = F.when(F.col("removed"), "deleted").when(created, "created").otherwise("extended")
    return rows.select("subject", n.alias("n"), F.lit(time).alias("generated"), F.when(~created, iri(n - 1)).alias("derived_from"), F.when(F.col("removed"), iri(n)).when(~created, iri(n - 1)).alias("invalidates"), F.concat(F.lit("The entity '"), F.col("subject"), F.lit("' has been "), text, F.lit(".")).alias("description"))


def latest(snapshots: DataFrame) -> DataFrame:
    """[RS-10] Of ``snapshots`` (subject, n, iri, derived_from, invalidates) those that none derives from or invalidates, themselves included."""
    gone = snapshots.select(F.explode(F.array_compact(F.array("derived_from", "invalidates"))).alias("iri"))
    return snapshots.join(gone, "iri", "left_anti").select("subject", "n", "iri")


def merge(quads: DataFrame, mapping: DataFrame, keep_kind: str = "br") -> DataFrame:
    """[G-14, SNK-07] Entities replaced by others: ``mapping`` (old, new).

    Objects are redirected; old entities go, and with them whatever they alone
    lead to, up to a resource of ``keep_kind``. What a surviving entity still
    points to stays. ``quads`` may repeat statements, the result does not.
    """
    links = quads.filter("o_kind = 'iri'").select(F.col("s").alias("src"), F.col("o").alias("dst")).filter(F.col("src") != F.col("dst"))
    inner = written(links.filter(~(F.col("dst").contains(f"/{keep_kind}/") & F.col("dst").rlike(f"/{keep_kind}/[0-9]+$"))), "links")
    old = mapping.select(F.col("old").alias("src"))
    # What old entities lead to over links that do not enter a kept kind.
    reach = _walked(inner, old).select(F.col("dst").alias("node")).distinct()
    # It is kept if something else points there, by a link of the same sort.
    doomed = reach.unionByName(old.select(F.col("src").alias("node"))).distinct()
    held = inner.join(doomed.withColumnRenamed("node", "src"), "src", "left_anti").join(reach.withColumnRenamed("node", "dst"), "dst", "left_semi").select(F.col("dst").alias("node")).distinct()
    gone = doomed.join(held, "node", "left_anti").unionByName(old.select(F.col("src").alias("node"))).distinct().withColumnRenamed("node", "s")
    kept = quads.join(small(written(gone, "gone")), "s", "left_anti")
    to = mapping.select(F.col("old").alias("o"), "new")
    moved = kept.join(small(to), "o", "left").withColumn("o", F.when(F.col("o_kind") == "iri", F.coalesce("new", "o")).otherwise(F.col("o"))).drop("new")
    return once(moved.select(*quads.columns))


def _walked(edges: DataFrame, roots: DataFrame, rounds: int = 30) -> DataFrame:
    """The edges that can be walked from ``roots`` (src), a round per step."""
    frontier = written(edges.join(roots.distinct(), "src", "left_semi"), "walk")
    seen = frontier
    for _ in range(rounds):
        step = edges.join(frontier.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
        frontier = written(step.join(seen, ["src", "dst"], "left_anti"), "walk")
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise RuntimeError(f"more than {rounds} steps from the roots")


def lower_identifiers(ids: DataFrame, schemes: tuple[str, ...] = ("doi",)) -> DataFrame:
    """[G-15, Q-17] Literals of the schemes in lower case."""
    return ids.withColumn("literal", F.when(F.col("scheme").isin(*schemes), F.lower("literal")).otherwise(F.col("literal")))


def repair_duplicates(ids: DataFrame, valid: DataFrame, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """[G-16, G-17] Kept and removed identifiers of works with more than one (work, pos, id, literal).

    The first literal among ``valid`` (literal) stays; a work without a valid one
    is left as it is, and so is one that is ``done`` (work).
    """
    several = ids.groupBy("work").agg(F.count("*").alias("k")).filter("k > 1").select("work")
    if done is not None:
        several = several.join(done, "work", "left_anti")
    rows = ids.join(several, "work").join(valid.select("literal").distinct().withColumn("ok", F.lit(True)), "literal", "left")
    best = first_by(rows.filter("ok"), ["work"], F.col("pos"), F.col("id")).select("work", F.col("id").alias("keep"))
    judged = rows.join(best, "work")
    columns = ["work", "pos", "id", "literal"]
    return judged.filter("id = keep").select(*columns), judged.filter("id <> keep").select(*columns)


def dataset_metadata(quads: DataFrame, known: DataFrame, time: str, base: str = BASE) -> DataFrame:
    """[G-13] s, p, o of the datasets of touched graphs: new dates, links from the root, and titles of datasets not ``known`` (g) before."""
    touched = quads.select("g").filter("g IS NOT NULL").distinct()
    dates = touched.select(F.col("g").alias("s"), F.lit("modified").alias("p"), F.lit(time).alias("o"))
    new = touched.join(known, "g", "left_anti")
    links = new.select(F.lit(base).alias("s"), F.lit("subset").alias("p"), F.col("g").alias("o"))
    titles = new.select(F.col("g").alias("s"), F.lit("title").alias("p"), F.concat(F.lit("Dataset of "), F.regexp_extract("g", "/([a-z]{2})/$", 1)).alias("o"))
    return dates.unionByName(links).unionByName(titles)
