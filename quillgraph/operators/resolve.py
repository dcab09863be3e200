"""Entity resolution by joins [RS-*, EX-*]: identifier lookup, best matches, new identifiers, containers, authors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.algebra import first_by


def lookup(refs: DataFrame, batch: DataFrame, store: DataFrame, mode: str = "both") -> DataFrame:
    """[RS-03, SRC-08] ``refs`` (scheme, literal, ...) with res and found_in: from ``batch`` first, then from ``store`` (scheme, literal, res each).

    ``mode`` is both, only_local or only_store. Where a literal has more than one
    resource, the least one counts.
    """
    out = refs.withColumns({"res": F.lit(None).cast("string"), "found_in": F.lit(None).cast("string")})
    for name, index, modes in (("batch", batch, ("both", "only_local")), ("store", store, ("both", "only_store"))):
        if mode in modes:
            one = index.groupBy("scheme", "literal").agg(F.min("res").alias("__res"))
            out = out.join(one, ["scheme", "literal"], "left")
            out = out.withColumns({"found_in": F.when(F.col("res").isNull() & F.col("__res").isNotNull(), F.lit(name)).otherwise(F.col("found_in")), "res": F.coalesce("res", "__res")}).drop("__res")
    return out


def first_hit(keys: DataFrame, index: DataFrame) -> DataFrame:
    """[RS-04, RS-13] key and res: of the identifiers of each key (key, pos, scheme, literal), the first that is known."""
    hits = keys.join(index.select("scheme", "literal", "res"), ["scheme", "literal"])
    return hits.groupBy("key").agg(F.min(F.struct("pos", "res")).alias("m")).select("key", F.col("m.res").alias("res"))


def first_writers(claims: DataFrame, existing: DataFrame, many: tuple[str, ...] = ("issn", "isbn")) -> DataFrame:
    """[RS-08] The claims (res, scheme, literal, ord) that are registered.

    A literal goes to the first that claims it; a resource has one identifier of
    a scheme, its first, unless the scheme is one of ``many``. What ``existing``
    (res, scheme, literal) holds comes before all claims.
    """
    free = claims.join(existing.select("scheme", "literal"), ["scheme", "literal"], "left_anti")
    single = existing.filter(~F.col("scheme").isin(*many)).select("res", "scheme")
    free = free.join(single, ["res", "scheme"], "left_anti")
    won = first_by(free, ["scheme", "literal"], F.col("ord"), F.col("res"))
    kept = first_by(won.filter(~F.col("scheme").isin(*many)), ["res", "scheme"], F.col("ord"), F.col("literal"))
    return kept.unionByName(won.filter(F.col("scheme").isin(*many))).select("res", "scheme", "literal", "ord")


def keep_best(matches: DataFrame, key: str = "match") -> DataFrame:
    """[RS-14] ``matches`` (doc, citing, pos, stage, <key>) with considered.

    Of the references of a document that match the same entity, the one of the
    lowest stage counts, ties by position; if the entity is the citing one, none.
    """
    best = Window.partitionBy("doc", key).orderBy("stage", "pos")
    there = F.col(key).isNotNull()
    return matches.withColumn("considered", there & ~F.col(key).eqNullSafe(F.col("citing")) & (F.row_number().over(best) == 1))


def cascade(refs: DataFrame, stages: list[tuple[int, DataFrame]]) -> DataFrame:
    """[RS-11, RS-12] ``refs`` (ref, ...) with res and stage: the result of the first stage (rank, DataFrame of ref and res) that has one."""
    out = refs.withColumns({"res": F.lit(None).cast("string"), "stage": F.lit(None).cast("int")})
    for rank, found in stages:
        one = found.groupBy("ref").agg(F.min("res").alias("__res"))
        out = out.join(one, "ref", "left")
        out = out.withColumns({"stage": F.when(F.col("res").isNull() & F.col("__res").isNotNull(), F.lit(rank)).otherwise(F.col("stage")), "res": F.coalesce("res", "__res")}).drop("__res")
    return out


def poisoned(refs: DataFrame, fields: list[str], doc: str = "doc") -> DataFrame:
    """[EX-10, RS-16, Q-14] ``refs`` with error: true for all of a document one of whose references has no field at all."""
    bad = refs.filter(F.coalesce(*[F.col(f) for f in fields]).isNull()).select(doc).distinct().withColumn("error", F.lit(True))
    return refs.join(bad, doc, "left").withColumn("error", F.coalesce("error", F.lit(False)))


def already_stored(articles: DataFrame, stored: DataFrame, ids: list[str]) -> DataFrame:
    """[EX-08, ST-02] Articles none of whose ids is among ``stored`` (id)."""
    known = articles.select("article", F.explode(F.array_compact(F.array(*[F.col(i) for i in ids]))).alias("id")).join(stored, "id", "left_semi").select("article").distinct()
    return articles.join(known, "article", "left_anti")


def numbered_in_order(df: DataFrame, key: str, name: str, chunks: int = 64) -> DataFrame:
    """``df`` with a gapless number from 1 in order of a numeric key, ties in any order, nulls last.

    Rows are dealt by the key's quantiles, numbered in each range, and shifted by
    the sizes of the ranges before, so no task sorts the whole table.
    """
    marks = df.agg(F.percentile_approx(key, [i / chunks for i in range(1, chunks)], 10_000).alias("m")).first()["m"] or []
    b = F.lit(0)
    for mark in sorted(set(marks)):
        b = b + F.when(F.coalesce(F.col(key) > mark, F.lit(True)), 1).otherwise(0)
    rows = df.withColumn("__b", b)
    starts = rows.groupBy("__b").count().withColumn("__start", F.coalesce(F.sum("count").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    out = rows.withColumn("__n", F.row_number().over(Window.partitionBy("__b").orderBy(F.col(key).asc_nulls_last()))).join(F.broadcast(starts), "__b")  # one row per chunk
    return out.withColumn(name, F.col("__start") + F.col("__n")).drop("__b", "__n", "__start")


def round_robin(df: DataFrame, key: str, suppliers: list[str]) -> DataFrame:
    """[EX-11] ``df`` with supplier, dealt in turn in order of a numeric key."""
    rows = numbered_in_order(df, key, "__turn")
    return rows.withColumn("supplier", F.element_at(F.array(*[F.lit(s) for s in suppliers]), (F.pmod(F.col("__turn") - 1, F.lit(len(suppliers))) + 1).cast("int"))).drop("__turn")


def without_self_citations(refs: DataFrame, citing: str, cited: str) -> DataFrame:
    """[EX-07]"""
    return refs.filter(~(F.col(citing).eqNullSafe(F.col(cited)) & F.col(citing).isNotNull()))


def numbered(df: DataFrame, last: DataFrame, kind: str, order: list[Column], chunks: int = 64) -> DataFrame:
    """[RS-35, ST-06] ``df`` with num: going on from the last number of each class (kind, last), without gaps, the same on every run.

    Rows are dealt by a hash of their order key, numbered in each chunk, and
    shifted by the sizes of the chunks before, so no task numbers them all.
    """
    base = last.select(F.col(kind).alias("__k"), F.col("last").alias("__last"))
    b = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sizes = b.groupBy(kind, "__b").count().withColumn("__start", F.coalesce(F.sum("count").over(Window.partitionBy(kind).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    out = b.withColumn("__n", F.row_number().over(Window.partitionBy(kind, "__b").orderBy(*order))).join(sizes, [kind, "__b"])
    out = out.join(base, F.col(kind) == F.col("__k"), "left")
    return out.withColumn("num", F.coalesce("__last", F.lit(0)) + F.col("__start") + F.col("__n")).drop("__b", "__n", "__start", "__k", "__last")


def role_chain(authors: DataFrame) -> DataFrame:
    """[RS-26] ``authors`` (br, pos, role) with next: the role after it in its work."""
    return authors.withColumn("next", F.lead("role").over(Window.partitionBy("br").orderBy("pos")))


def match_authors(authors: DataFrame, known: DataFrame) -> DataFrame:
    """[RS-24, NM-01, NM-03] br, pos, orcid of authors (br, pos, given, family; normalised) matched with known ones (br, orcid, given, family).

    A family name that is unique on both sides matches. Otherwise a given name
    matches the one that is closest among those with the same first letter, if
    each is the other's only closest.
    """
    pairs = authors.alias("a").join(known.alias("k"), (F.col("a.br") == F.col("k.br")) & (F.col("a.family") == F.col("k.family")))
    cols = [F.col("a.br"), F.col("a.pos"), F.col("k.orcid"), F.col("a.given").alias("g1"), F.col("k.given").alias("g2"), F.col("a.family")]
    pairs = pairs.select(*cols).filter("orcid IS NOT NULL")
    # Joined by work and family, so counting needs no shuffle; all that follows is within a work, and needs one.
    name = Window.partitionBy("br", "family")
    pairs = pairs.withColumns({"n1": F.size(F.collect_set("pos").over(name)), "n2": F.size(F.collect_set("orcid").over(name))})
    pairs = pairs.withColumn("unique", (F.col("n1") == 1) & (F.col("n2") == 1))
    near = ((F.col("n1") > 1) | (F.col("n2") > 1)) & (F.left("g1", F.lit(1)) == F.left("g2", F.lit(1)))
    pairs = pairs.withColumn("d", F.when(near, (F.col("g1") != F.col("g2")).cast("int"))).filter("unique OR d IS NOT NULL")
    pairs = pairs.select("br", "pos", "orcid", "unique", "d").repartition("br")
    author, other = Window.partitionBy("br", "pos"), Window.partitionBy("br", "orcid")
    pairs = pairs.withColumn("m1", F.min("d").over(author)).withColumn("m2", F.min("d").over(other)).filter("unique OR (d = m1 AND d = m2)")
    pairs = pairs.withColumn("c2", F.count("d").over(other)).withColumn("c1", F.count("d").over(author))
    return pairs.filter("unique OR (c1 = 1 AND c2 = 1)").select("br", "pos", "orcid")


def containers(works: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """[RS-07, RS-30, RS-31] Journals, volumes, issues and part-of edges of articles (work, journal, volume, issue), each made once.

    Keys are canonical: the journal, journal|volume, journal|volume|issue; a
    missing volume leaves its issue under the journal, a missing issue the work under the volume.
    """
    journal = works.filter("journal IS NOT NULL").select(F.col("journal").alias("key")).distinct()
    named = works.withColumns({"vkey": F.when(F.col("journal").isNotNull() & F.col("volume").isNotNull(), F.concat_ws("|", "journal", "volume")), "ikey": F.when(F.col("journal").isNotNull() & F.col("issue").isNotNull(), F.concat_ws("|", "journal", F.coalesce("volume", F.lit("")), "issue"))})
    volume = named.filter("vkey IS NOT NULL").select(F.col("vkey").alias("key"), "journal", "volume").distinct()
    issue = named.filter("ikey IS NOT NULL").select(F.col("ikey").alias("key"), F.coalesce("vkey", "journal").alias("parent"), "issue").distinct()
    part = named.select(F.col("work").alias("child"), F.coalesce("ikey", "vkey", "journal").alias("parent")).filter("parent IS NOT NULL")
    part = part.unionByName(issue.select(F.col("key").alias("child"), "parent")).unionByName(volume.select(F.col("key").alias("child"), F.col("journal").alias("parent")))
    return journal, volume, issue, part
