"""SimHash near-duplicates: fingerprints and their bit-sliced comparison.

Fingerprints within 2 bits of each other agree on two of four blocks of 16
bits, and of the 32 bits left, on two of four blocks of 8. So each distinct
fingerprint is dealt to 36 buckets, in each of which 48 bits are equal. A bucket
thus holds at most 65,536 fingerprints, whatever the data. Within a bucket the bits are
stored vertically, 64 fingerprints to a block of 64 bit planes; distances to a
query are counted by carry-save addition of planes, and a block is abandoned
once all its counters exceed the radius.

Pairs of texts alike by 0.8 or more over five words differ in more bits than
such buckets can find. For these, texts get fingerprints of 1,024 bits, whose
distance tells the likeness closely enough, and meet in blocks by bands of the
least hashes of their shingles. A block is compared with one of its members
first, in linear time; those within the radius are linked by that, and only the
others are held against the whole block, bit-sliced, in cells of bounded size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import partitions, table, written

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Near copies: words to a shingle, 64-bit words of a fingerprint, bands and the least hashes that make the key of one.
NEAR_SHINGLE = 5
NEAR_WORDS = 16
BANDS = 12
BAND_ROWS = 5
#: Sets of a Jaccard likeness of 0.8 stand at an angle of 0.152 of a half turn, which is 155 of 1,024 bits on
#: average, with a deviation of 11.5: this one beyond it.
NEAR_RADIUS = 166
#: Members of a block on each side of a cell.
CELL = 512


def shingle_hashes(text: str | None, shingle: int) -> tuple[bytes, np.ndarray]:
    """The words of a text in lower case, joined, and the XXH64 of each shingle of them (fewer words: of all; none: no hash)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII case and white space only
    joined = b" ".join(words)
    if len(words) <= shingle:
        return joined, np.array([xxhash.xxh64_intdigest(joined, SEED)] * bool(words), np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    return joined, np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash over XXH64 of word shingles; a bit is set if it is set in over half of the hashes. No words: 0."""
    hashes = shingle_hashes(text, shingle)[1]
    return int(majority(hashes)) if len(hashes) else 0


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits set in over half of the hashes (along the first axis), counted by carry-save addition: of three words of one weight, their sum and carry remain."""
    n, planes, at = len(hashes), [hashes], 0
    while at < len(planes):
        words, carries = planes[at], []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * third :]))
        if len(words) == 2:
            carries.append(words[:1] & words[1:])
            words = words[:1] ^ words[1:]
        planes[at] = words
        if carries:
            planes.append(np.concatenate(carries))
        at += 1
    # Per bit: is the count above / equal to n // 2 so far, from the highest plane.
    half, none = n // 2, np.zeros(hashes.shape[1:], np.uint64)
    above, equal = none, ~none
    for k in range(max(len(planes), half.bit_length()) - 1, -1, -1):
        plane = planes[k][0] if k < len(planes) and len(planes[k]) else none
        if half >> k & 1:
            equal = equal & plane
        else:
            above, equal = above | (equal & plane), equal & ~plane
    return above


def bucket_masks() -> list[int]:
    """The 36 masks of 48 bits."""
    masks = []
    for two in itertools.combinations(range(4), 2):
        outer = sum(0xFFFF << 16 * i for i in two)
        rest = [i for i in range(4) if i not in two]
        parts = [0xFF << 16 * i + 8 * j for i in rest for j in (0, 1)]
        masks += [outer | a | b for a, b in itertools.combinations(parts, 2)]
    return masks


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes of blocks of 64 fingerprints: [block, bit] words whose lane i belongs to the block's i-th fingerprint."""
    bits = np.unpackbits(prints.reshape(-1, 64, prints.shape[1] if prints.ndim > 1 else 1).view(np.uint8), axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1).copy(), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def near_lanes(queries: np.ndarray, blocks: np.ndarray, planes: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """For each query and its block (an index into planes), the lanes within RADIUS bits as a word.

    ``ones`` and ``twos`` count differing planes per lane, ``over`` the lanes
    beyond the radius. Pairs whose lanes are all over are dropped on the way.
    """
    out = np.zeros(len(queries), np.uint64)
    live = np.arange(len(queries))
    q, at = queries, blocks
    ones = twos = np.zeros(len(q), np.uint64)
    over = ~lanes[at]
    zero, full = np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(64):
        differ = planes[at, k] ^ np.where((q >> np.uint64(k)) & np.uint64(1), full, zero)
        carry = ones & differ
        ones = ones ^ differ
        over = over | (twos & (carry | ones)) if RADIUS == 2 else over
        twos = twos | carry
        if k % 8 == 7:
            stay = over != full
            if not stay.all():
                live, q, at, ones, twos, over = live[stay], q[stay], at[stay], ones[stay], twos[stay], over[stay]
            if not len(live):
                return out
    out[live] = ~over
    return out


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, over edges u - v."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        while (jump := root[root]).tolist() != root.tolist():
            root = jump
        if (root == before).all():
            return root


def linked(keys: np.ndarray, prints: np.ndarray, pairs_at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets: (fingerprint, least fingerprint reachable in its bucket) of each one that is linked to another.

    ``keys`` must be sorted and tell the buckets apart; ``prints`` distinct and
    sorted within each.
    """
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    first, sizes = first[sizes > 1], sizes[sizes > 1]
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    width = -(-sizes // 64)  # blocks per bucket
    block0 = np.concatenate(([0], np.cumsum(width)[:-1]))
    member = np.arange(sizes.sum()) - np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    bucket = np.repeat(np.arange(len(first)), sizes)
    row = first[bucket] + member
    place = block0[bucket] * 64 + member
    padded, used = np.zeros(int(width.sum()) * 64, np.uint64), np.zeros(int(width.sum()) * 64, np.uint8)
    padded[place], used[place] = prints[row], 1
    planes = planes_of(padded)
    lanes = np.packbits(used.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
    root = np.arange(len(padded))
    # Every member against every block of its bucket, a bounded number of pairs at a time.
    tasks = np.cumsum(width[bucket])
    done = 0
    while done < len(row):
        base = tasks[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(tasks, base + pairs_at_once, "right")))
        w = width[bucket[done:end]]
        who = np.repeat(np.arange(done, end), w)
        block = np.repeat(block0[bucket[done:end]], w) + (np.arange(len(who)) - np.repeat(np.cumsum(w) - w, w))
        found = near_lanes(prints[row[who]], block, planes, lanes)
        hit = np.flatnonzero(found)
        bits = np.unpackbits(found[hit].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
        at, lane = np.nonzero(bits)
        u, v = place[who[hit[at]]], block[hit[at]] * 64 + lane
        apart = u > v
        if apart.any():
            root = root[roots(len(root), np.concatenate((np.arange(len(root)), u[apart])), np.concatenate((root, v[apart])))]
        done = end
    moved = np.flatnonzero(root != np.arange(len(root)))
    return padded[moved], padded[root[moved]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (bucket, key, fp): links of each bucket; a bucket that spans batches is held until it is whole."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held = [np.zeros(0, np.int64)] * 3

    def links(which, keys, prints):
        ids = np.cumsum(np.concatenate(([0], (which[1:] != which[:-1]) | (keys[1:] != keys[:-1]))))
        a, b = linked(ids, prints.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    for batch in batches:
        held = [np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64))) for h, c in zip(held, ("bucket", "key", "fp"))]
        if not len(held[0]):
            continue
        last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield links(*(h[:cut] for h in held))
            held = [h[cut:] for h in held]
    if len(held[0]):
        yield links(*held)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, rid (a hash of doc_id and text) and fp (the fingerprint as a signed BIGINT) of every row of docs (doc_id, text)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(found.view(np.int64))], names=["doc_id", "rid", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), "text")
    return rows.mapInArrow(score, "doc_id long, rid long, fp long")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node and root (the least node reachable) over edges (a, b), for every node that has one; large-star and small-star rounds.

    Each round is a written table; the number of rounds grows with the logarithm of the longest path.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        # Large star: every neighbour above a node is linked to the least node around it.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # What is joined to the edges it was taken from is written: then the join shuffles both sides, and can split a node of many edges.
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("m", "a").alias("m")), "least")
        large = both.join(least, both["a"] == least["n"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "large")
        # Small star: every neighbour below a node, and the node, are linked to the least of them.
        low = written(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), "low")
        small = large.join(low, large["a"] == low["n"]).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        new = written(small, "edges")
        same = new.count() == edges.count() and not new.join(edges, ["a", "b"], "left_anti").limit(1).count()
        edges = new
        if same:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"the components are not settled after {rounds} rounds")


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, rid, fp and root (a fingerprint that names the component) of every row of ``docs`` (doc_id, text)."""
    prints = written(fingerprints(docs), "simhash")
    # Unsigned order in Python and signed order here differ, which is no matter: any order of nodes will do.
    distinct = prints.select("fp").distinct()
    signed = [m - (1 << 64) if m >> 63 else m for m in bucket_masks()]
    dealt = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("bucket"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])).alias("x")).select("x.bucket", "x.key", "fp")
    sorted_ = dealt.repartition(partitions(docs.sparkSession, 720 * prints.count()), "bucket", "key").sortWithinPartitions("bucket", "key", "fp")
    root = components(sorted_.mapInArrow(_compare, "a long, b long"))
    return prints.join(root, prints["fp"] == root["node"], "left").select("doc_id", "rid", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over fingerprints that differ
    in at most RADIUS bits. Texts without words, null texts among them, have
    fingerprint zero and link like any other. Null doc_ids never become a
    component_id unless a component has no other. Rows with the same doc_id are
    rows of their own. An empty table gives no rows; other columns are ignored.
    """
    rows = placed(docs)
    # Written, so that the join shuffles both sides itself and can split the rows of a very large component.
    least = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "r"), "least")
    out = rows.join(least, rows["root"] == least["r"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near copies -----------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit words mixed up, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


_PLACES = mixed(np.arange(1, 1 + NEAR_WORDS, dtype=np.uint64))
_XORS = mixed(np.arange(1001, 1001 + BANDS * BAND_ROWS, dtype=np.uint64))
_ODDS = mixed(np.arange(2001, 2001 + BANDS * BAND_ROWS, dtype=np.uint64)) | np.uint64(1)
_WEIGHTS = mixed(np.arange(3001, 3001 + BAND_ROWS, dtype=np.uint64)) | np.uint64(1)


def sketch(text: str | None, at_once: int = 1 << 13) -> tuple[int, np.ndarray, np.ndarray]:
    """128-bit hash of a text's words, its wide fingerprint, and the keys of its blocks.

    The fingerprint is taken over distinct shingles, as Jaccard likeness is.
    Texts without words have fingerprint zero and keys of their own.
    """
    joined, hashes = shingle_hashes(text, NEAR_SHINGLE)
    least = np.full(len(_XORS), np.iinfo("u8").max, np.uint64)
    if len(hashes):
        hashes = np.unique(hashes)
        wide = majority(mixed(hashes[:, None] ^ _PLACES[None, :]))
        for i in range(0, len(hashes), at_once):
            least = np.minimum(least, ((hashes[i : i + at_once, None] ^ _XORS[None, :]) * _ODDS[None, :]).min(axis=0))
    else:
        wide = np.zeros(NEAR_WORDS, np.uint64)
    keys = mixed((mixed(least).reshape(BANDS, BAND_ROWS) * _WEIGHTS[None, :]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    return xxhash.xxh3_128_intdigest(joined), wide, keys


def wide_lanes(queries: np.ndarray, blocks: np.ndarray, planes: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """As near_lanes, for fingerprints of several words and any radius.

    Eight planes at a time are added up by carry-save adders, and their sums go
    into a counter of bit planes; lanes whose counter exceeds the radius are
    over, and pairs all of whose lanes are over are dropped after each 64 planes.
    """
    out = np.zeros(len(queries), np.uint64)
    live, q, at = np.arange(len(queries)), queries, blocks
    zero, full = np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF)
    depth = (64 * queries.shape[1]).bit_length()
    counter = [np.zeros(len(q), np.uint64) for _ in range(depth)]

    def adder(a, b, c):
        half = a ^ b
        return half ^ c, (a & b) | (half & c)

    for word in range(queries.shape[1]):
        for low in range(0, 64, 8):
            d = [planes[at, 64 * word + k] ^ np.where((q[:, word] >> np.uint64(k)) & np.uint64(1), full, zero) for k in range(low, low + 8)]
            counter[0], two_a = adder(counter[0], d[0], d[1])
            counter[0], two_b = adder(counter[0], d[2], d[3])
            counter[0], two_c = adder(counter[0], d[4], d[5])
            counter[0], two_d = adder(counter[0], d[6], d[7])
            counter[1], four_a = adder(counter[1], two_a, two_b)
            counter[1], four_b = adder(counter[1], two_c, two_d)
            counter[2], carry = adder(counter[2], four_a, four_b)
            for k in range(3, depth):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
        above, equal = np.zeros(len(q), np.uint64), np.full(len(q), full)
        for k in range(depth - 1, -1, -1):
            if radius >> k & 1:
                equal = equal & counter[k]
            else:
                above, equal = above | (equal & counter[k]), equal & ~counter[k]
        within = ~above & lanes[at]
        stay = within != zero
        if not stay.all():
            live, q, at, within, counter = live[stay], q[stay], at[stay], within[stay], [c[stay] for c in counter]
        if not len(live):
            return out
    out[live] = within
    return out


def cell_links(cell: np.ndarray, side: np.ndarray, node: np.ndarray, prints: np.ndarray, radius: int = NEAR_RADIUS, pairs_at_once: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node linked to it): what connects rows of side 0 with those of side 1 of their cell within ``radius`` bits.

    ``cell`` is sorted. Many small cells are compared at once: each has blocks of
    64 of its side 1, which all of its side 0 meet.
    """
    zeros, ones = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    ids, first, counts = np.unique(cell[ones], return_index=True, return_counts=True)
    zeros = zeros[np.isin(cell[zeros], ids)]
    width = -(-counts // 64)
    block0 = np.cumsum(width) - width
    slots = np.repeat(block0 * 64 - first, counts) + np.arange(len(ones))
    padded, used, row_of = np.zeros((int(width.sum()) * 64, prints.shape[1]), np.uint64), np.zeros(int(width.sum()) * 64, np.uint8), np.zeros(int(width.sum()) * 64, np.int64)
    padded[slots], used[slots], row_of[slots] = prints[ones], 1, ones
    planes, lanes = planes_of(padded), np.packbits(used.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
    own = np.searchsorted(ids, cell[zeros])
    nodes, places = np.unique(node, return_inverse=True)
    root = np.arange(len(nodes))
    # Every row of side 0 against every block of its cell, a bounded number of pairs at a time.
    tasks, done = np.cumsum(width[own]), 0
    while done < len(zeros):
        base = tasks[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(tasks, base + pairs_at_once, "right")))
        w = width[own[done:end]]
        who = np.repeat(zeros[done:end], w)
        block = np.repeat(block0[own[done:end]], w) + (np.arange(len(who)) - np.repeat(np.cumsum(w) - w, w))
        found = wide_lanes(prints[who], block, planes, lanes, radius)
        hit = np.flatnonzero(found)
        at, lane = np.nonzero(np.unpackbits(found[hit].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little"))
        u, v = places[who[hit[at]]], places[row_of[block[hit[at]] * 64 + lane]]
        if len(u):
            root = root[roots(len(root), np.concatenate((np.arange(len(root)), u)), np.concatenate((root, v)))]
        done = end
    moved = np.flatnonzero(root != np.arange(len(root)))
    return nodes[moved], nodes[root[moved]]


def _binary_words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _cells_within(radius: int):
    """Rows sorted by (cell, side): the links of the cells that are whole in a batch, or were held until they were."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(held):
        key, i, j, side, node, prints = held
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        a, b = cell_links(np.cumsum(new), side, node, prints, radius)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "i", "j", "side", "node")] + [_binary_words(batch.column("fp"))]
            held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            other = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]) | (held[2] != held[2][-1]))
            if len(other):
                cut = int(other[-1]) + 1
                yield links([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield links(held)

    return compare


def sketches(docs: DataFrame) -> DataFrame:
    """ident (128 bits of doc_id and text), doc_id, h1, h2 (hash of the words), fp and keys of every row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("ident", pa.binary()), ("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("fp", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(x.as_py()) for x in batch.column("text")]
            high, low = (np.array([x[0] >> shift & (1 << 64) - 1 for x in found], np.uint64).view(np.int64) for shift in (64, 0))
            yield pa.RecordBatch.from_arrays([batch.column("ident"), batch.column("doc_id"), pa.array(high), pa.array(low), pa.array([x[1].tobytes() for x in found], pa.binary()), pa.array([x[2].view(np.int64) for x in found], pa.list_(pa.int64()))], schema=schema)

    return docs.select(_ident().alias("ident"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "ident binary, doc_id long, h1 long, h2 long, fp binary, keys array<long>")


def _ident():
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("null"))).cast("binary")))


def near_links(nodes: DataFrame, radius: int = NEAR_RADIUS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect what is within ``radius`` bits in a common block, of ``nodes`` (node, fp, keys), a written table."""
    dealt = nodes.select("node", F.explode("keys").alias("key"))
    blocks = dealt.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1")
    blocks = blocks.join(nodes.select(F.col("node").alias("__p"), F.col("fp").alias("pivot_fp")), F.col("pivot") == F.col("__p")).select(F.col("key").alias("__key"), "n", "pivot", "pivot_fp")
    blocks = written(blocks, "blocks")  # so that joins by key shuffle both sides and can split a large block
    inside = written(dealt.join(blocks.select("__key"), F.col("key") == F.col("__key")).select("node", "key"), "block-members")
    inside_rows = inside.count()
    inside = inside.withColumnRenamed("node", "__n").join(nodes.select("node", "fp"), F.col("__n") == F.col("node")).select("key", "node", "fp")
    inside = inside.join(blocks, F.col("key") == F.col("__key")).select("key", "node", "fp", "n", "pivot", "pivot_fp")

    def against_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.bitwise_count(_binary_words(batch.column("fp")) ^ _binary_words(batch.column("pivot_fp"))).sum(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(apart <= radius, pa.bool_())], names=["key", "node", "fp", "n", "pivot", "near"])

    judged = written(inside.mapInArrow(against_pivot, "key long, node long, fp binary, n long, pivot long, near boolean"), "block-judged")
    direct = judged.filter("near AND node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    # What is near the pivot is connected already; the others meet the whole block, in cells.
    far = written(judged.filter("NOT near").groupBy("key").agg(F.count("*").alias("m")).withColumnRenamed("key", "__key"), "block-rest")
    left = judged.join(far, F.col("key") == F.col("__key")).select("key", "node", "fp", "near", F.ceil(F.col("m") / cell).cast("int").alias("rows"), F.ceil(F.col("n") / cell).cast("int").alias("columns"))
    chunk = lambda of: F.pmod(F.xxhash64("node", F.lit(7)), F.col(of)).cast("int")
    one = left.filter("NOT near").select("key", chunk("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(0).alias("side"), "node", "fp")
    two = left.select("key", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), chunk("columns").alias("j"), F.lit(1).alias("side"), "node", "fp")
    cells = one.unionByName(two).repartition(partitions(nodes.sparkSession, 320 * inside_rows), "key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return direct.unionByName(cells.mapInArrow(_cells_within(radius), "a long, b long"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near copies the one of smallest doc_id.

    Near copies are texts whose wide fingerprints over five words differ in at
    most NEAR_RADIUS bits, which stands for a likeness of 0.8 or more, among
    those that share a block; groups are what such links connect. Texts of the
    same words (lower case) are copies; those without words, null and empty
    ones among them, are copies of each other. Of documents with the same
    doc_id the one of smallest hash stays, of rows alike in doc_id and text
    one. Null doc_ids stay only where their group has no other. An empty table
    gives no rows. Texts count whole, of any length.
    """
    names = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    rows = written(sketches(docs.select("doc_id", "text")).withColumn("rid", F.monotonically_increasing_id()), "sketches")
    # Written, as a text that many rows have is a hot key.
    first = written(rows.groupBy("h1", "h2").agg(F.min("rid").alias("node")).withColumnsRenamed({"h1": "__h1", "h2": "__h2"}), "words")
    nodes = written(rows.join(first.select("node"), F.col("rid") == F.col("node")).select("node", "fp", "keys"), "nodes")
    root = components(near_links(nodes)).withColumnRenamed("node", "__n")
    found = rows.select("ident", "doc_id", "h1", "h2").join(first, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))).join(root, F.col("node") == F.col("__n"), "left")
    best = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("ident").alias("r"))
    kept = found.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(best).alias("first")).select(F.col("first.r").alias("__r"))
    # Rows alike go before the join, each map task on its own first.
    whole = docs.select(*[F.col(c).alias(n) for c, n in names.items()], _ident().alias("__ident")).dropDuplicates(["__ident"])
    return whole.join(kept, F.col("__ident") == F.col("__r")).select(*[F.col(n).alias(c) for c, n in names.items()])


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
