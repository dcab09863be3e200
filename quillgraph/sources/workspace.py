"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one or two short strings that are broadcast at most (about 200 MB).
SMALL = 1_000_000
#: Rows of the largest table that a task of a chain of joins should meet.
EACH = 500_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a new folder where that is unset and the master is local.

    Elsewhere an unset folder is an error: each executor would write to its own
    disk, and what is read back would be a part.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quillgraph-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(rows: DataFrame, most: int = SMALL) -> DataFrame:
    """With a broadcast hint if there are few, so that what they meet is not shuffled and sorted for them."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def dealt(rows: DataFrame, key: str, total: int, each: int | None = None) -> DataFrame:
    """``rows`` dealt by ``key`` over as many partitions as ``total`` rows need; as they are where the session has enough."""
    n = total // (each or EACH)
    return rows if n <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(n, key)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, in any file system that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
