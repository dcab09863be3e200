"""Incremental ingestion with Structured Streaming [ST-*].

A folder of reference documents is the queue. Each micro-batch drops what is
stored already, routes failures, gives numbers that go on from the last ones,
and appends to tables; checkpointed offsets take the place of a saved cursor.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillgraph.operators.resolve import numbered
from quillgraph.schema import DOCUMENT
from quillgraph.sources.workspace import exists, written


def documents(spark: SparkSession, folder: str, files_per_batch: int | None = None, archive: str | None = None, whole_files: bool = True) -> DataFrame:
    """[ST-01, ST-03] The queue as a stream, a document a file (or a line); finished files go to ``archive`` if there is one."""
    reader = spark.readStream.schema(DOCUMENT).option("multiLine", whole_files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A table, empty where there is none yet."""
    if exists(spark, path):
        return spark.read.schema(ddl).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])


class Ingest:
    """[ST-02, ST-06] The work of a micro-batch, over tables under ``root``: stored ids, done and failed documents, last numbers."""

    IDS = ("doi", "pmid", "pmcid", "localid")

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = lambda n: f"{self.root}/{n}/batch={batch_id}"
        batch = batch.withColumn("key", F.coalesce(*self.IDS))
        stored = _table(spark, f"{self.root}/stored", "id string, batch int").filter(F.col("batch") != batch_id).select("id")
        fresh = batch.filter("key IS NOT NULL")
        if not stored.isEmpty():
            ids = fresh.select("key", F.explode(F.array_compact(F.array(*self.IDS))).alias("id"))
            fresh = fresh.join(ids.join(stored, "id", "left_semi").select("key").distinct(), "key", "left_anti")
        bad = F.col("doi").isNull() | F.coalesce(F.exists("references", lambda r: F.coalesce(*[r[n] for n in ("bibentry", "doi", "pmid", "pmcid", "url", "xmlid")]).isNull()), F.lit(False))
        # Written, so that what follows neither sorts the batch again nor keeps another one of equal keys than before.
        fresh = written(fresh.dropDuplicates(["key"]).withColumn("bad", bad), "queue")
        failed = batch.filter("key IS NULL").unionByName(fresh.filter("bad").drop("bad"))
        done = fresh.filter("NOT bad").drop("bad")
        last = _table(spark, f"{self.root}/done", "num long, batch int").filter(F.col("batch") != batch_id).agg(F.coalesce(F.max("num"), F.lit(0)).alias("last")).withColumn("kind", F.lit("br"))
        numbers = numbered(done.withColumn("kind", F.lit("br")), last, "kind", [F.col("key")]).drop("kind")
        # Each batch has folders of its own, written over if it comes again after a failure.
        numbers.write.mode("overwrite").parquet(path("done"))
        failed.write.mode("overwrite").parquet(path("failed"))
        done.select(F.explode(F.array_compact(F.array(*self.IDS))).alias("id")).distinct().write.mode("overwrite").parquet(path("stored"))


def run(spark: SparkSession, folder: str, root: str, files_per_batch: int | None = None, stop_marker: str | None = None, whole_files: bool = True) -> int:
    """[ST-04, ST-05] Works off the queue and ends; returns the number of micro-batches.

    A marker file is looked for before each batch. If it is there the batch
    fails before any work and is never committed, so the next run without the
    marker begins with it: nothing is lost.
    """
    ingest, count, stopped = Ingest(root), 0, False

    def each(batch: DataFrame, batch_id: int) -> None:
        nonlocal count, stopped
        if stop_marker and exists(spark, stop_marker):
            stopped = True
            raise RuntimeError(f"stopped by {stop_marker}")
        ingest(batch, batch_id)
        count += 1

    query = documents(spark, folder, files_per_batch, whole_files=whole_files).writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not stopped:
            raise
    return count


def replay(events: DataFrame) -> DataFrame:
    """[ST-03] The order in which a queue of events (user_id as folder, ts, event_id) is worked off: sorted within each folder, with the step before."""
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events.select("user_id", "event_id", F.row_number().over(order).alias("turn"), F.lag("event_id").over(order).alias("before"))
