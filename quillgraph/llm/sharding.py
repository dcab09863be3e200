"""Sharding of documents by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts) sorted by size enter the bin with the least room that
still holds them, found in a balanced tree of remaining capacities. All groups
of one size are dealt in runs, as a bin that was the tightest stays so until it
holds no more of them; so the packing works on the histogram of group sizes,
and groups then look up their bin by their number among those of their size.
With a fixed capacity this minimises the number of shards. To fill a fixed
number of shards evenly, the least capacity at which the packing needs no more
shards is found by bisection (the multifit scheme).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import numbered, table, written

#: The bisection ends within this share of the capacity.
CLOSE = 1_000_000


class RoomTree:
    """Bins by remaining room, an AVL tree of (room, bin) keys; add, remove and tightest fit in O(log n)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # node: [key, left, right, height]

    @staticmethod
    def _fix(n):
        tall = lambda x: x[3] if x else 0

        def up(x):
            x[3] = 1 + max(tall(x[1]), tall(x[2]))
            return x

        def turn(x, side):  # the child on `side` comes up
            y = x[side]
            x[side], y[3 - side] = y[3 - side], x
            up(x)
            return up(y)

        lean = tall(n[1]) - tall(n[2])
        if abs(lean) > 1:
            side = 1 if lean > 0 else 2
            if tall(n[side][3 - side]) > tall(n[side][side]):
                n[side] = turn(n[side], 3 - side)
            return turn(n, side)
        return up(n)

    def add(self, key: tuple[int, int]) -> None:
        def put(n):
            if n is None:
                return [key, None, None, 1]
            side = 1 if key < n[0] else 2
            n[side] = put(n[side])
            return self._fix(n)

        self.root = put(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def least(n):
            return n[0] if n[1] is None else least(n[1])

        def cut(n, key):
            if n[0] == key:
                if n[1] is None or n[2] is None:
                    return n[1] or n[2]
                n[0] = least(n[2])
                n[2] = cut(n[2], n[0])
            else:
                side = 1 if key < n[0] else 2
                n[side] = cut(n[side], key)
            return self._fix(n)

        self.root = cut(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest key with room for ``size``."""
        n, best = self.root, None
        while n:
            if n[0][0] >= size:
                best, n = n[0], n[1]
            else:
                n = n[2]
        return best


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most_bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Packs (size, count) entries, largest first, into runs (size, count, bin). None if more than ``most_bins`` are needed.

    The same bins as item by item: once an item is in the tightest bin, that bin
    is the tightest for the next item of the size, as long as it has room. A size
    above the capacity gets a bin of its own. Runs number at most the distinct
    sizes and a few for each bin.
    """
    rooms, bins, out = RoomTree(), 0, []
    smallest = min((size for size, _ in sizes), default=0)
    for size, left in sizes:
        while left:
            key = rooms.tightest(size)
            if key is None:
                if bins == most_bins:
                    return None
                room, own = max(capacity, size), bins
                bins += 1
            else:
                rooms.remove(key)
                room, own = key
            take = min(left, room // size)
            left -= take
            out.append((size, take, own))
            if room - take * size >= smallest:
                rooms.add((room - take * size, own))
    return out


def even_bins(sizes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """Packs (size, count) entries, largest first, into runs (size, count, bin) over ``bins`` bins of nearly equal sums.

    A size above the fair share of what is left takes a bin alone; the rest is
    packed at the least capacity that needs no more than the bins left.
    """
    alone, left, rest = 0, sum(s * n for s, n in sizes), [list(x) for x in sizes]
    out = []
    while rest and alone < bins - 1 and rest[0][0] * (bins - alone) >= left:
        out.append((rest[0][0], 1, alone))
        left -= rest[0][0]
        rest[0][1] -= 1
        alone += 1
        if not rest[0][1]:
            del rest[0]
    if not rest:
        return out
    low = high = max(rest[0][0], -(-left // (bins - alone)))
    step = max(1, low // CLOSE)
    while (best := best_fit_decreasing(rest, high, bins - alone)) is None:
        low, high, step = high + 1, high + step, 2 * step
    while high - low > low // CLOSE:
        middle = (low + high) // 2
        found = best_fit_decreasing(rest, middle, bins - alone)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return out + [(s, n, alone + b) for s, n, b in best]


class Places:
    """The bin of each group, by its size and its number among those of the size: three flat arrays."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        # Runs in order of size, groups numbered through: a run is where its first group is.
        runs = sorted(runs, key=lambda r: r[0])
        sizes, counts = np.array([r[0] for r in runs], np.int64), np.array([r[1] for r in runs], np.int64)
        self.starts = np.cumsum(counts) - counts
        self.bins = np.array([r[2] for r in runs], np.int32)
        first = np.flatnonzero(np.diff(sizes, prepend=-1))
        self.sizes, self.bases = sizes[first], self.starts[first]

    def __call__(self, size: np.ndarray, number: np.ndarray) -> np.ndarray:
        at = self.bases[np.searchsorted(self.sizes, size)] + number
        return self.bins[np.searchsorted(self.starts, at, "right") - 1]


def shard(docs: DataFrame, shards: int | None = 8, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (doc_id, text), equal texts together.

    With ``capacity`` (bytes): as few shards of that capacity as best fit
    decreasing finds; ``shards`` does not count. Else ``shards`` shards of nearly
    equal sizes. size: UTF-8 bytes of the text plus 1; null text counts as
    empty, and so belongs to the group of the empty text. Rows with the same
    doc_id are rows of their own, repeated rows too. An empty table gives no
    rows; columns besides doc_id and text are ignored. slot is gapless from 0 in
    each shard. A group larger than a shard stays whole and has a shard to
    itself. The driver holds a row for each distinct group size: as sizes that
    differ sum up to the whole, these are fewer than the square root of twice
    the bytes of the table, whatever the number of groups.
    """
    text, spark = F.coalesce(F.col("text"), F.lit("")), docs.sparkSession
    # Written with a number of their own, so that rows alike can be told apart below, and texts are read once.
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("__key"), F.monotonically_increasing_id().alias("__row"))
    rows = written(rows, "shard-rows")
    groups = written(rows.groupBy("__key").agg(F.sum("size").alias("n")), "shard-groups")
    counts = {r["n"]: r["count"] for r in groups.groupBy("n").count().collect()}
    sizes = sorted(counts.items(), reverse=True)
    places = spark.sparkContext.broadcast(Places(best_fit_decreasing(sizes, capacity) if capacity else even_bins(sizes, shards)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.value(batch.column("n").to_numpy(), batch.column("number").to_numpy()) if batch.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("__key"), pa.array(found, pa.int32())], names=["__group", "shard"])

    numbers = numbered(groups, ["n"], [F.col("__key")], "number", max(16, max(counts.values(), default=0) // 100_000))
    # Written, so that the join shuffles both sides itself and can split the rows of a very common text.
    placed = written(numbers.mapInArrow(place, "__group long, shard int"), "shard-places")
    most = rows.count() // max(1, len(set(places.value.bins.tolist())))
    rows = rows.join(placed, F.col("__key") == F.col("__group")).select("doc_id", "size", "text_crc32", "shard", "__row")
    return numbered(rows, ["shard"], [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("__row")], "slot", max(64, 2 * most // 100_000)).drop("__row")


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, 8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
