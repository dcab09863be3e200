"""Mixing sources to target weights, with DataFrame functions only.

Words are counted per source, each source gets a target, and every document is
taken floor(rate) times plus once more with probability equal to the fraction
(rate = target / words of the source), decided by a hash of its id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import WORD, table

#: The weights that sources take in turn, and the most a source may be repeated.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Source tables up to this many rows are broadcast (under 10 MB); larger ones are joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words of a text as BIGINT; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed, key and the text's MD5; null keys count as ``null``, null texts as empty.

    So texts under a null or repeated key are drawn each for itself.
    """
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with target.

    Targets share the sum of all sizes by weight; none is above ``most`` times
    its source's size, and what is cut off is shared again by weight. With the
    sources sorted by cap / weight, the common level is the first (and so the
    largest) one below the cap / weight of its row; no loop is needed. A source without words gets 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    tightest = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, rest = tightest.rowsBetween(Window.unboundedPreceding, -1), tightest.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest))
    rows = rows.withColumn("level", F.max(F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))).over(everything))
    return rows.select("source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")), F.lit(0.0)).alias("target"))


def with_copies(rows: DataFrame, seed: str) -> DataFrame:
    """``rows`` (source, size, draw) with source_size, target and copies; only the targets, one row per source, are joined."""
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "__source")
    if targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return rows.join(targets, F.col("source").eqNullSafe(F.col("__source")), "left").withColumn("copies", copies.cast("long")).drop("__source")


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Sizes, targets and copies of every row of ``docs`` (doc_id, text, source): all columns but text, with size, source_size, target, copies, taken.

    Null text: size 0, taken 0. Null source: a source of its own, last in
    order. Rows alike in doc_id and text fall alike; those alike in one of them
    only, or with null ids, are drawn each for itself. An empty table gives no
    rows. Of columns named like the results, the results win.
    """
    new = ("text", "size", "source_size", "target", "copies", "taken", "draw")
    rows = docs.select(*[c for c in docs.columns if c not in new], word_count(F.col("text")).alias("size"), unit_hash(F.col("doc_id"), F.col("text"), seed).alias("draw"))
    return with_copies(rows, seed).drop("draw").withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` takes it, with the columns of ``docs``.

    Null texts and null sources, repeated ids and rows as in ``mix``; a document
    without words is taken like the others of its source, and none is where the
    source has no words. An empty table gives no rows. Of extra columns, names
    may clash with those of ``mix``. The text stays with its row.
    """
    names = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    kept = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("source"), word_count(F.col("text")).alias("size"), unit_hash(F.col("doc_id"), F.col("text"), seed).alias("draw"))
    rows = with_copies(kept, seed).filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * 3 AS cap,
             [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS w FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
             / CAST(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level FROM w),
t AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), (SELECT max(level) FROM l WHERE cap / w > level) * w), 0) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             CAST(('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || digest), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
