"""Packing of tokenised documents into sequences by non-negative least squares over length patterns.

Patterns of two or three lengths that fill a sequence exactly are enumerated,
their repeat counts are fitted to the histogram of lengths by non-negative
least squares and rounded down, and what is left of the histogram is packed by
best fit decreasing. All this works on the histogram, whose size is bounded by
the sequence length; documents then look up their place by their number among
the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import numbered, table, written

SEQUENCE = 2048
END = 0
#: The special string of the vocabulary; texts that hold it go through the tokenizers library, which gives it its own id.
SPECIAL = "<|endoftext|>"
#: Two lengths of a three-length pattern are multiples of so many tokens, unless the sequence is short.
GRID = 32
STEPS = 400


def tokenizer_files() -> tuple[str, str]:
    """Paths of the vocabulary: for the tokenizers library, and the same as tiktoken ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(files: tuple[str, str]):
    """text -> ids. The ranks give the same ids as the tokenizers library several times faster."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(files[1], "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast, full = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(files[0])
    return lambda text: full.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)


def cuts(n: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all full but the first, which may be shorter."""
    first = n % sequence or sequence
    return [(0, first), *[(s, sequence) for s in range(first, n, sequence)]]


def pieces(docs: DataFrame, sequence: int = SEQUENCE, files: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of ``docs`` (doc_id, text); with ``ids`` (little-endian 32-bit) if asked for."""
    files = files or tokenizer_files()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(files)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                for k, (start, length) in enumerate(cuts(len(ids), sequence)):
                    part = ids[start : start + length].tobytes()
                    rows.append((doc_id, k, start, length, zlib.crc32(part), part)[: len(fields)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(fields), schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def patterns(histogram: np.ndarray, sequence: int) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to ``sequence`` and all occur."""
    grid = GRID if sequence >= 16 * GRID else 1
    a = np.arange(1, sequence // 2 + 1)
    pairs = np.stack((sequence - a, a, 0 * a), 1)
    b, c = np.meshgrid(np.arange(1, sequence), np.arange(grid, sequence, grid))
    b, c = b.ravel(), c.ravel()
    d = sequence - b - c
    keep = (d > 0) & ((d % grid == 0) | (b % grid == 0)) & (b >= c) & (c >= d)
    found = np.concatenate((pairs, np.stack((b[keep], c[keep], d[keep]), 1)))
    there = histogram > 0
    there[0] = True
    return found[there[found].all(axis=1)]


def least_squares(found: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 with the least squared error between the lengths that the patterns use and the histogram; accelerated projected gradient."""
    n = len(histogram)
    real = histogram.astype(float).copy()
    real[0] = 0

    def used(x):
        total = sum(np.bincount(found[:, j], x, n) for j in range(3))
        total[0] = 0
        return total

    # A bound on the largest eigenvalue: the most patterns a length is in, times the lengths in a pattern.
    step = 1 / (3 * max(1.0, used(np.ones(len(found))).max()))
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(steps):
        error = used(y) - real
        error[0] = 0
        new = np.maximum(0, y - step * error[found].sum(axis=1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, y, t = new, new + (t - 1) / t2 * (new - x), t2
    return x


def fit(histogram: np.ndarray, sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use no length more often than the histogram has it, and ``histogram`` less what they use."""
    found = patterns(histogram, sequence)
    out = []
    if len(found):
        x = least_squares(found, histogram)
        for p in np.argsort(-x, kind="stable"):
            lengths = tuple(int(v) for v in found[p] if v)
            wanted = int(round(x[p]))
            if wanted < 1:
                break
            need = {v: lengths.count(v) for v in lengths}
            repeats = min(wanted, *[int(histogram[v]) // k for v, k in need.items()])
            if repeats > 0:
                for v, k in need.items():
                    histogram[v] -= k * repeats
                out.append((lengths, repeats))
    return out


def best_fit(histogram: np.ndarray, sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over counts: bins of the same content are one entry (lengths, bins)."""
    by_room: dict[int, list] = defaultdict(list)
    rooms = np.zeros(sequence + 1, bool)  # which remaining rooms there are

    def put(lengths, bins):
        room = sequence - sum(lengths)
        by_room[room].append((lengths, bins))
        rooms[room] = True

    for length in range(sequence, 0, -1):
        left = int(histogram[length])
        while left:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                lengths, bins = by_room[room].pop()
                take = min(bins, left)
                if take < bins:
                    by_room[room].append((lengths, bins - take))
                rooms[room] = bool(by_room[room])
                put((*lengths, length), take)
                left -= take
            else:
                each = sequence // length
                if left >= each:
                    put((length,) * each, left // each)
                    left %= each
                else:
                    put((length,) * left, 1)
                    left = 0
    return [x for group in by_room.values() for x in group]


def plan(counts: dict[int, int], sequence: int = SEQUENCE) -> tuple[dict[int, np.ndarray], int]:
    """For each length, rows (first number, sequence of that number, offset) by number; and the count of sequences."""
    histogram = np.zeros(sequence + 1, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    packed = fit(histogram, sequence)
    packed += best_fit(histogram, sequence)
    taken: dict[int, int] = defaultdict(int)
    places: dict[int, list] = defaultdict(list)
    sequences = 0
    for lengths, repeats in packed:
        offset = 0
        for length in lengths:
            places[length].append((taken[length], sequences, offset))
            taken[length] += repeats
            offset += length
        sequences += repeats
    return {k: np.array(v, np.int64) for k, v in places.items()}, sequences


def pack(docs: DataFrame, sequence: int = SEQUENCE, files: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text).

    A document is its tokens and an end token; null text counts as empty, and is
    the end token alone. Rows with the same doc_id are packed each for itself.
    Texts of any length are encoded whole, one at a time. An empty table gives no rows; other columns are ignored. ``with_ids`` adds
    the tokens: the sequence itself is its pieces in order of offset.
    """
    made = written(pieces(docs, sequence, files, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # a row per length: ``sequence`` at most
    places, _ = plan(counts, sequence)
    shared = docs.sparkSession.sparkContext.broadcast(places)  # a few thousand rows: bounded by the sequence length
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            ids, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                rows = shared.value[int(v)]
                k = np.searchsorted(rows[:, 0], number[at], "right") - 1
                ids[at], offsets[at] = rows[k, 1] + number[at] - rows[k, 0], rows[k, 2]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n, _ in fields], pa.array(ids), pa.array(offsets)], schema=schema)

    buckets = max(64, max(counts.values(), default=0) // 100_000)
    rows = numbered(made, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "number", buckets)
    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
