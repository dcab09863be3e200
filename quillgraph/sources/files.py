"""Readers and writers: extraction tables, article XML, quads, sharded output, uploads [SRC-*, SNK-*]."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import graph as gr
from quillgraph.schema import DOCUMENT
from quillgraph.sources.workspace import exists, written


def read_extraction_table(spark: SparkSession, path: str) -> DataFrame:
    """[SRC-05] Tab-separated rows; references are JSON."""
    return spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').schema("cur_doi string, cur_pmid string, cur_pmcid string, cur_name string, references string").csv(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """[SRC-04, SRC-06] doc (file name) and xml of a folder of article files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xml,nxml}").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("doc"), F.decode("content", "UTF-8").alias("xml"))


def articles_of(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """[SRC-06] Rows of an extraction dataset (cur_name, ...) with the XML of the article file of that name; rows without one go."""
    return rows.join(articles.select("doc", "xml"), F.col("cur_name") == F.col("doc"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """[DM-4] Reference documents, one JSON object a file or a line."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).json(path)


# Fixed value: the form of a statement's line.
STATEMENT = r'^<([^>]*)> <([^>]*)> (<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@[A-Za-z0-9-]+)?)(?: <([^>]*)>)? \.\s*$'


def parse_statements(lines: DataFrame) -> DataFrame:
    """[SRC-11] Quads from N-Triples or N-Quads lines (value); other lines are left out."""
    at = lambda k: F.regexp_extract("value", STATEMENT, k)
    rows = lines.filter(F.col("value").rlike(STATEMENT))
    text = at(5)
    # Escaped backslashes first, out of the way of what follows them.
    for old, new in (("\\\\", "\0"), ("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ('\\"', '"'), ("\0", "\\")):
        text = F.replace(text, F.lit(old), F.lit(new))
    is_iri = at(3).startswith("<")
    return rows.select(F.nullif(at(7), F.lit("")).alias("g"), at(1).alias("s"), at(2).alias("p"), F.when(is_iri, at(4)).otherwise(text).alias("o"), F.when(is_iri, "iri").otherwise("lit").alias("o_kind"), F.nullif(at(6), F.lit("")).alias("o_dt"))


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    return parse_statements(spark.read.text(path))


def read_jsonld(spark: SparkSession, path: str) -> DataFrame:
    """[SRC-11] Quads from flattened JSON-LD of the form that :func:`write_jsonld` writes."""
    rows = spark.read.schema("`@id` string, g string, p string, `@value` string, `@type` string, ref string").json(path)
    return rows.select("g", F.col("@id").alias("s"), "p", F.coalesce("ref", "@value").alias("o"), F.when(F.col("ref").isNotNull(), "iri").otherwise("lit").alias("o_kind"), F.col("@type").alias("o_dt"))


def write_jsonld(quads: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows = quads.select(F.col("s").alias("@id"), "g", "p", F.when(F.col("o_kind") == "lit", F.col("o")).alias("@value"), F.col("o_dt").alias("@type"), F.when(F.col("o_kind") == "iri", F.col("o")).alias("ref"))
    rows.write.mode(mode).json(path)


def write_statements(quads: DataFrame, path: str, with_graph: bool = True) -> None:
    """[SNK-04, SNK-10]"""
    quads.select(gr.ntriples(with_graph).alias("value")).write.mode("overwrite").text(path)


def with_shard(quads: DataFrame, per_dir: int = 10_000, per_file: int = 1000) -> DataFrame:
    """[SNK-03] Partition columns of each subject's shard; filters on them prune files."""
    n = tx.resource_number(F.col("s"))
    prefix = F.when(tx.supplier_prefix(F.col("s")) != "", tx.supplier_prefix(F.col("s"))).otherwise("_")
    return quads.withColumns({"kind": F.coalesce(tx.short_name(F.col("s")), F.lit("dataset")), "prefix": prefix, "dir_split": F.coalesce(tx.dir_split(n, per_dir), F.lit(0)).cast("string"), "file_split": F.coalesce(tx.file_split(n, per_file), F.lit(0)).cast("string")})


def store_shards(quads: DataFrame, path: str, merge: bool = True) -> None:
    """[SNK-03] Writes quads by shard. Touched shards are merged with what is there (as a set), or replaced; others stay.

    The rows are dealt by shard first, so that each shard is one file.
    """
    spark = quads.sparkSession
    keys = ["kind", "prefix", "dir_split", "file_split"]
    rows = with_shard(quads)
    if merge and exists(spark, path):  # the first time there is nothing to merge with
        old = spark.read.schema(rows.schema).parquet(path).select(*quads.columns, *keys).join(rows.select(*keys).distinct(), keys, "left_semi")
        rows = written(rows.unionByName(old).distinct(), "shards")
    rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def store_references(documents: DataFrame, path: str, hour: str) -> None:
    """[SNK-01] Reference documents as JSON by supplier and hour; those with an empty reference go to the error folder."""
    bad = F.exists("references", lambda r: F.coalesce(*[r[n] for n in ("bibentry", "doi", "pmid", "pmcid", "url", "xmlid")]).isNull())
    rows = documents.withColumns({"hour": F.lit(hour), "failed": F.coalesce(bad, F.lit(False))})
    for failed, name in ((False, "data"), (True, "error")):
        rows.filter(F.col("failed") == failed).drop("failed").write.mode("append").partitionBy("supplier", "hour").json(f"{path}/{name}")


def upload(updates: DataFrame, send: Callable[[str], bool], path: str) -> tuple[int, int]:
    """[SNK-09] Sends update requests (batch, request) in order by ``send``; the failed ones are written to ``path``. Returns sent and failed.

    The order of requests matters, so one sender takes them, a partition at a
    time; each holds many entities, and only those that fail are kept.
    """
    failed, sent = [], 0
    for r in updates.orderBy("batch").toLocalIterator():
        if send(r["request"]):
            sent += 1
        else:
            failed.append((r["batch"], r["request"]))
    if failed:
        updates.sparkSession.createDataFrame(failed, "batch long, request string").write.mode("append").json(path)
    return sent, len(failed)


def store_and_upload(quads: DataFrame, updates: DataFrame, send: Callable[[str], bool], path: str) -> bool:
    """[SNK-08] Stores the shards, then uploads all or nothing; returns whether it uploaded.

    The shards are written to a folder of their own and counted there. If that
    fails or rows are missing, nothing is sent and a marker
    (``_NOT_UPLOADED``) with the reason is left; a later call that succeeds takes
    it away. Requests that the receiver refuses are kept under ``errors`` as by
    :func:`upload`, with the marker.
    """
    spark = quads.sparkSession
    marker, reason = f"{path}/_NOT_UPLOADED", None
    try:
        store_shards(quads, f"{path}/shards", merge=False)
        wanted, there = quads.count(), spark.read.parquet(f"{path}/shards").count()
        reason = f"{there} of {wanted} statements stored" if there < wanted else None
    except PySparkException as e:
        reason = f"not stored: {type(e).__name__}"
    if reason is None:
        failed = upload(updates, send, f"{path}/errors")[1]
        reason = f"{failed} requests refused" if failed else None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(marker)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if reason is None:
        system.delete(hadoop, False)
        return True
    with_reason = system.create(hadoop, True)
    with_reason.writeBytes(reason)
    with_reason.close()
    return False


def fetch(url: str, tries: int = 6, wait: float = 10.0, timeout: float = 30.0, opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[str, str | None]:
    """[SRC-14] Status (ok, not_found or error) and text or messages. Not found is an answer, and ends the tries; each kind of error is told once."""
    errors: list[str] = []
    for k in range(tries):
        if k:
            sleep(wait)
        try:
            with opener(url, timeout=timeout) as r:
                return "ok", r.read().decode()
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return "not_found", None
            said = f"HTTP status {e.code}"
        except TimeoutError:
            said = "timeout"
        except OSError as e:
            said = f"failure: {type(e).__name__}"
        if said not in errors:
            errors.append(said)
    return "error", " | ".join(errors)


class Throttle:
    """[SRC-15] At most so many calls a second."""

    def __init__(self, per_second: float, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.last = 1 / per_second, clock, sleep, None

    def __call__(self) -> None:
        now = self.clock()
        if self.last is not None and now < self.last + self.gap:
            self.sleep(self.last + self.gap - now)
            now = self.last + self.gap
        self.last = now


def vocabulary_terms(rows: DataFrame) -> DataFrame:
    """[SRC-17] iri and term of vocabulary entries (iri, label): the label, else the last part of the IRI."""
    return rows.select("iri", F.coalesce("label", F.element_at(F.split("iri", "[/#]"), -1)).alias("term"))


def pending_loads(files: DataFrame, reports: DataFrame, graph: str) -> DataFrame:
    """[SNK-11] LOAD statements of files (file) that no report (file) names."""
    return files.join(reports, "file", "left_anti").select("file", F.concat(F.lit("LOAD <file:"), F.col("file"), F.lit(f"> INTO GRAPH <{graph}>")).alias("statement"))
