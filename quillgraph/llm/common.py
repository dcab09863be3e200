"""What the operators of this subpackage share: paths in the shared folder, tables, gapless numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.sources.workspace import shared_dir, written

__all__ = ["WORD", "new_path", "numbered", "partitions", "shared_dir", "table", "written"]

#: Runs of anything but ASCII white space; the words of every contract here.
WORD = r"[^\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession, expected_bytes: int = 0) -> int:
    """What the session asks for, or one for each 64 MB that are expected, if that is more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), expected_bytes >> 26)


def numbered(df: DataFrame, groups: list[str], order: list[Column], name: str, buckets: int = 64) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps within each group.

    A group is dealt over ``buckets`` by a hash of the order columns, numbered
    in each bucket, then shifted by the sizes of the buckets before it, so that
    no task needs a whole group. Rows alike in all order columns get different
    numbers. ``buckets`` should grow with the largest group.
    """
    b = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*[f"__g{i}" for i in range(len(groups))]).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    sizes = b.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__b").alias("__c")).count()
    starts = sizes.withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    same = F.col("__b") == F.col("__c")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inner = Window.partitionBy(*groups, "__b").orderBy(*order)
    out = b.withColumn("__n", F.row_number().over(inner)).join(starts, same, "left")
    return out.withColumn(name, F.col("__start") + F.col("__n") - 1).select(*df.columns, name)
