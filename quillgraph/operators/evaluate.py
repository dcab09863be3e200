"""Evaluation of retrieved identifiers against known ones [EV-*]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normal(name: str):
    return F.lower(F.trim(F.col(name)))


def above(sheet: DataFrame, threshold: float) -> DataFrame:
    """The sheet with local: the local result, null below the threshold [Q-19]."""
    return sheet.withColumn("local", F.when(F.col("local_score") >= threshold, F.col("retrieved_local_doi")))


def precision_recall(relevant: DataFrame, retrieved: DataFrame) -> DataFrame:
    """[EV-01] precision, recall and f1 over sets of ids (id), nulls left out; null where a divisor is zero."""
    want, got = relevant.select(normal("id").alias("id")).filter("id IS NOT NULL").distinct(), retrieved.select(normal("id").alias("id")).filter("id IS NOT NULL").distinct()
    flags = want.withColumn("w", F.lit(1)).join(got.withColumn("g", F.lit(1)), "id", "full")
    n = flags.agg(F.count("w").alias("w"), F.count("g").alias("g"), F.count(F.when(F.col("w").isNotNull() & F.col("g").isNotNull(), 1)).alias("b"))
    p, r = F.try_divide("b", "g"), F.try_divide("b", "w")
    return n.select(F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 6).alias("f1"))


def agreement(sheet: DataFrame, threshold: float) -> DataFrame:
    """[EV-02] How manual, local and remote results agree, in one row."""
    s = above(sheet, threshold).select(normal("manual_doi").alias("m"), normal("local").alias("l"), normal("retrieved_remote_doi").alias("r"), "local_score")
    m, l, r = F.col("m"), F.col("l"), F.col("r")  # noqa: E741
    conditions = {
        "skipped": l.isNull(), "local_right": l == m, "remote_right": r == m, "local_remote_equal": l == r, "both_right": (l == m) & (r == m), "only_local_right": (l == m) & (r != m), "only_remote_right": (r == m) & (l != m),
        "both_wrong_same": (l != m) & (r != m) & (l == r), "both_wrong_different": (l != m) & (r != m) & (l != r), "local_supplements": F.contains(l, m) & (l != m), "remote_supplements": F.contains(r, m) & (r != m),
    }
    means = [F.round(F.avg(F.when(c, F.col("local_score"))), 6).alias(n) for n, c in (("mean_score_right", l == m), ("mean_score_wrong", l != m))]
    return s.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()], *means)


def is_training(name: str):
    """[EV-03] Four in five, by a hash of the id."""
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % 5 != 0


def threshold_sweep(sheet: DataFrame, train: bool = True, thresholds: int = 50) -> DataFrame:
    """[EV-03] threshold and f1 over sets of ids, on the training or the other part.

    An id counts at all thresholds up to its best score, so one aggregation per id
    and a sum over thresholds replace a pass for each.
    """
    rows = sheet.filter(is_training("manual_doi") if train else ~is_training("manual_doi"))
    want = rows.select(normal("manual_doi").alias("id")).distinct()
    best = rows.filter("retrieved_local_doi IS NOT NULL").groupBy(normal("retrieved_local_doi").alias("id")).agg(F.max("local_score").alias("score"))
    hits = best.join(want.withColumn("hit", F.lit(1)), "id", "left").groupBy(F.least(F.floor("score"), F.lit(thresholds - 1)).cast("int").alias("top")).agg(F.count("*").alias("got"), F.count("hit").alias("both"))
    steps = hits.filter("top >= 0").select(F.explode(F.sequence(F.lit(0), F.col("top"))).alias("threshold"), "got", "both").groupBy("threshold").agg(F.sum("got").alias("got"), F.sum("both").alias("both"))
    one = want.agg(F.count("*").alias("want")).withColumn("__one", F.lit(1))
    return steps.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one").select("threshold", F.round(2.0 * F.col("both") / (F.col("got") + F.col("want")), 6).alias("f1"))


def best_threshold(sweep: DataFrame) -> int | None:
    """[EV-03] The first threshold of the best f1."""
    row = sweep.orderBy(F.col("f1").desc(), "threshold").first()
    return None if row is None else row["threshold"]


def prefiltered(sheet: DataFrame, catalogue: DataFrame) -> DataFrame:
    """[EV-04] Distinct rows whose manual id is known and in the catalogue (id)."""
    return sheet.filter("manual_doi <> '???'").join(catalogue.select(F.col("id").alias("manual_doi")), "manual_doi", "left_semi").dropDuplicates()


def mismatches(rows: DataFrame, known: str, found: str) -> DataFrame:
    """[EV-07]"""
    return rows.filter(normal(known) != normal(found))


def flat_references(documents: DataFrame) -> DataFrame:
    """[EV-05] explicit_doi and bibref of every reference of reference documents, empty where there is none."""
    refs = documents.select(F.explode("references").alias("r"))
    return refs.select(F.coalesce("r.doi", F.lit("")).alias("explicit_doi"), F.coalesce("r.bibentry", F.lit("")).alias("bibref"))


def coverage(terms: DataFrame, similar: DataFrame, thresholds: list[float]) -> DataFrame:
    """[EV-09] For each threshold, how many terms (term) have a similar one (term, similarity), and how many have none."""
    best = terms.select("term").distinct().join(similar.groupBy("term").agg(F.max("similarity").alias("best")), "term", "left")
    counts = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.coalesce("best", F.lit(-1.0)) >= t).alias("covered"), F.count_if(F.coalesce("best", F.lit(-1.0)) < t).alias("missing")) for t in thresholds]
    return best.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("x")).select("x.*")
