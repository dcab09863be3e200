"""Exact top-k search by inner product: tiled matrix products, partial selection, merging of top lists.

Vectors are packed into tiles (one row holds the ids and the matrix of up to
``TILE`` vectors), tiles into shards, queries into groups. Each cell of the
grid of query groups and shards is one unit of work of bounded size: the
queries of a group meet the tiles of a shard one by one in a matrix product,
each tile's scores are partially selected, and the lists are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import partitions, table, written

TILE = 4096
SHARD_ROWS = 65_536
QUERY_ROWS = 16_384
#: Lists of a query are merged in rounds of so many shards.
FAN_IN = 64
TILE_SCHEMA = "shard int, tile string, n int, d int, wide boolean, ids binary, cells binary"


def _packed(shard: int, tile: str, ids: np.ndarray, cells: np.ndarray) -> dict:
    wide = bool(cells.size and np.abs(cells).max() >= 1 << 24)
    return {"shard": shard, "tile": tile, "n": len(ids), "d": cells.shape[1], "wide": wide, "ids": ids.astype("<i8").tobytes(), "cells": cells.astype("<f8" if wide else "<f4").tobytes()}


def _cells(row: dict) -> np.ndarray:
    return np.frombuffer(row["cells"], "<f8" if row["wide"] else "<f4").reshape(row["n"], row["d"])


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


ARROW_TILE = pa.schema([("shard", pa.int32()), ("tile", pa.string()), ("n", pa.int32()), ("d", pa.int32()), ("wide", pa.bool_()), ("ids", pa.binary()), ("cells", pa.binary())])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import uuid

    def flush(shard, held):
        d = max(len(v) for _, v in held)
        cells = np.zeros((len(held), d))
        for i, (_, v) in enumerate(held):
            cells[i, : len(v)] = v
        return _rows([_packed(shard, uuid.uuid4().hex, np.array([i for i, _ in held], "i8"), cells)], ARROW_TILE)

    held: dict[int, list] = {}
    for batch in batches:
        ids, shards, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
        starts, values = vectors.offsets.to_numpy(), np.asarray(vectors.values)
        for i, (vec_id, shard) in enumerate(zip(ids.tolist(), shards.tolist())):
            rows = held.setdefault(shard, [])
            rows.append((vec_id, values[starts[i] : starts[i + 1]]))
            if len(rows) == TILE:
                yield flush(shard, held.pop(shard))
    for shard, rows in held.items():
        yield flush(shard, rows)


def tiles_of(vectors: DataFrame, scale: int = 64, shard_rows: int | None = None) -> tuple[DataFrame, int, int]:
    """The tiles as a written table, the number of shards, the number of vectors.

    Components become floor(scale * x). A row takes no part if its vec_id or
    vector is null or a component is null, infinite or not a number.
    """
    x = F.transform("embedding", lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != float("inf")))
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    count = rows.count()
    spark = vectors.sparkSession
    # Enough shards for all cores, of no more than SHARD_ROWS rows, and of a tile at least.
    shards = max(1, -(-count // (shard_rows or SHARD_ROWS)), min(2 * spark.sparkContext.defaultParallelism, -(-count // TILE)))
    rows = rows.select("vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), x.alias("x"))
    return written(rows.repartition(min(shards, partitions(spark)), "shard").mapInArrow(_tiles, TILE_SCHEMA), "topk-tiles"), shards, count


def _exact_dot(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integers as int64: by single or double precision where every partial sum is exact, else digit by digit."""
    d = min(q.shape[1], c.shape[1])
    q, c = q[:, :d], c[:, :d]
    bound = (float(np.abs(q).max()) if q.size else 0.0) * (float(np.abs(c).max()) if c.size else 0.0) * d
    if bound < 1 << 24:
        return (q.astype("f4") @ c.astype("f4").T).astype("i8")
    if bound < 1 << 53:
        return (q.astype("f8") @ c.astype("f8").T).astype("i8")
    # Row by row: only pairs whose own bound is too large are done with whole numbers of any length.
    most_q, most_c = np.abs(q).max(axis=1, initial=0), np.abs(c).max(axis=1, initial=0)
    out = np.zeros((len(q), len(c)), "i8")
    fine = most_c * max(most_q.min(initial=0), 1.0) * d < 1 << 53
    big_q = np.flatnonzero(most_q * most_c[fine].max(initial=0) * d >= 1 << 53)
    fine_q = np.setdiff1d(np.arange(len(q)), big_q)
    exact = lambda a, b: np.clip(whole(a).dot(whole(b).T), -(1 << 63), (1 << 63) - 1).astype("i8")
    out[np.ix_(fine_q, np.flatnonzero(fine))] = (q[fine_q].astype("f8") @ c[fine].astype("f8").T).astype("i8")
    out[np.ix_(fine_q, np.flatnonzero(~fine))] = exact(q[fine_q], c[~fine])
    out[big_q] = exact(q[big_q], c)
    return out


def whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers of any length."""
    return np.array([int(v) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the k highest scores, ties to smaller ids; int64 scores, ids of the same shape."""
    n = scores.shape[1]
    if n > 2 * k:
        # All above the k-th highest score, then as many of those equal to it as have the smallest ids.
        edge = np.partition(scores, n - k, axis=1)[:, n - k]
        keep = scores >= edge[:, None]
        width = int(keep.sum(axis=1).max())
        if width < n:
            at = np.argsort(~keep, axis=1, kind="stable")[:, :width]
            real = np.take_along_axis(keep, at, 1)
            scores = np.where(real, np.take_along_axis(scores, at, 1), np.iinfo("i8").min)
            ids = np.where(real, np.take_along_axis(ids, at, 1), np.iinfo("i8").max)
    order = np.lexsort((ids, -scores.astype("f8") if np.abs(scores).max(initial=0) < 1 << 53 else ~scores))[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _searcher(k: int):
    out_schema = pa.schema([("shard", pa.int32()), ("tile", pa.string()), ("place", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    none = np.iinfo("i8").min

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, tops, shard = None, [], [], None

        def done():
            for (name, qids, places, _), top in zip(queries, tops):
                if top is None:
                    continue
                scores, ids = top
                real = ids != np.iinfo("i8").max
                rep = real.sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rep.sum(), shard, "i4")), pa.array([name] * int(rep.sum()), pa.string()), pa.array(np.repeat(places, rep).astype("i4")), pa.array(np.repeat(qids, rep)), pa.array(ids[real]), pa.array(scores[real])], schema=out_schema)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["qgroup"], row["shard"]) != cell:
                    yield from done()
                    cell, queries, tops, shard = (row["qgroup"], row["shard"]), [], [], row["shard"]
                ids, cells = np.frombuffer(row["ids"], "<i8"), _cells(row)
                if row["kind"] == 0:
                    queries.append((row["tile"], ids, np.frombuffer(row["places"], "<i4"), cells))
                    tops.append(None)
                    continue
                for i, (name, qids, places, q) in enumerate(queries):
                    scores = _exact_dot(q, cells)
                    ids2 = np.broadcast_to(ids, scores.shape)
                    if name == row["tile"]:  # a row is not its own neighbour
                        scores[np.arange(len(places)), places] = none
                        ids2 = ids2.copy()
                        ids2[np.arange(len(places)), places] = np.iinfo("i8").max
                    best = _best(scores, ids2, k)
                    tops[i] = best if tops[i] is None else _best(np.hstack([tops[i][0], best[0]]), np.hstack([tops[i][1], best[1]]), k)
        yield from done()

    return search


def _queries_of(every: int):
    schema = pa.schema([*ARROW_TILE, ("places", pa.binary())])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                places = np.flatnonzero(ids % every == 0)
                if len(places):
                    yield _rows([row | _packed(row["shard"], row["tile"], ids[places], _cells(row)[places].astype("f8")) | {"places": places.astype("<i4").tobytes()}], schema)

    return pick


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, query_rows: int = QUERY_ROWS, shard_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every row whose vec_id is divisible by ``every``.

    Candidates are all rows but the query's own; rows with the same vec_id are
    rows of their own, and then the query's row is known by its place. Ties go to
    the smaller vec_id. Vectors of unequal length are compared over the shorter
    length. Scores beyond BIGINT are clipped to it. An empty table gives no rows;
    columns besides vec_id and embedding are ignored.
    """
    tiles, shards, count = tiles_of(vectors, scale, shard_rows)
    groups = max(1, -(-count // (every * query_rows)))
    queries = tiles.mapInArrow(_queries_of(every), TILE_SCHEMA + ", places binary")
    grid = queries.withColumn("qgroup", F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("kind", F.lit(0))
    other = tiles.withColumn("places", F.lit(None).cast("binary")).withColumn("qgroup", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1))
    cells = grid.unionByName(other).repartition(min(groups * shards, 4 * partitions(vectors.sparkSession)), "qgroup", "shard").sortWithinPartitions("qgroup", "shard", "kind")
    lists = cells.mapInArrow(_searcher(k), "shard int, tile string, place int, query_id long, vec_id long, score long")
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        best = Window.partitionBy("tile", "place", "shard").orderBy(F.col("score").desc(), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
    best = Window.partitionBy("tile", "place").orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), 20, 20, 64)


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
