"""Removal of long repeated substrings with suffix arrays built by induced sorting.

Every window of ``WINDOW`` bytes is dealt to a bucket by its minimiser: the
8-byte gram in it with the least hash. Equal windows have equal minimisers, so
a bucket sees all windows it needs and no document meets another one by itself.
Grams that a sample shows to be in many documents are passed over where the
window has another, lest the contexts of a common phrase meet in one bucket.
Neighbouring windows with the same minimiser travel as one segment. Each bucket
is a shard: its segments are concatenated, their suffix array is made by induced
sorting, and permuted common prefixes tell which windows are equal. A window
that also starts in a document with a smaller id marks its bytes for removal.

Before that, 128-bit fingerprints settle what is equal as a whole: of equal
segments only one is kept, and the windows of the others are those of that one.
So whole copies are found by fingerprints, and a segment that shares neither
half of its context with another text is alone; the suffix arrays sort what
remains, one of each text that may share a window with a different one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import partitions, table

WINDOW = 50
GRAM = 8
SPAN = WINDOW - GRAM + 1  # grams in a window
HALF = (WINDOW - GRAM) // 2  # a window has so many bytes before its minimiser or after it
#: Minimisers are sought in so many bytes at a time, segments gathered from so many, buckets aim at so many,
#: and the segments of one or more buckets that may have something in common make a shard of about so many.
PART_BYTES = 1 << 19
BATCH_BYTES = 8 << 20
BUCKET_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
SWELL = 3.3  # bytes of segments to a byte of text
MOST_BUCKETS = (1 << 31) - 1  # a bucket's number is an int
#: Document id that stands for null; nothing is smaller because of it.
NO_ID = np.iinfo("i8").max
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers
_AT = np.uint64((1 << 22) - 1)
_LATE = np.uint64(1 << 63)
#: At most so many frequent grams are passed over, found in about so many documents. They change where
#: windows meet, and no result.
FREQUENT = 4096
FREQUENT_SAMPLE = 3000


# --- suffix arrays -------------------------------------------------------------------------------


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one. The last symbol must be the only smallest one."""
    n = len(s)
    is_s = np.zeros(n, bool)
    is_s[-1] = True
    if n > 1:
        rise, change = s[:-1] < s[1:], np.flatnonzero(s[:-1] != s[1:])
        is_s[:-1] = rise[change[np.searchsorted(change, np.arange(n - 1))]]
    return is_s


def _induce_by_bucket(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffix array induced from ``lms`` (sorted by first symbol at least), a whole bucket of symbols at a time.

    All that a bucket induces into others is moved with a few array operations;
    what it induces into itself comes in rounds, one for each repetition of the symbol.
    """
    n, k = len(s), len(starts) - 1
    sa = np.full(n, -1, np.int32)
    ends = starts[1:]
    first = s[lms]
    per = np.bincount(first, minlength=k)
    sa[np.arange(len(lms)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(ends - per, per)] = lms

    def spread(found, want_s):
        """Predecessors of the wanted type in order of their symbols, the symbols, and the place of each among its like."""
        prev = found - 1
        prev = prev[prev >= 0]
        prev = prev[is_s[prev] == want_s]
        symbols = s[prev]
        order = np.argsort(symbols, kind="stable")
        prev, symbols = prev[order], symbols[order]
        counts = np.bincount(symbols, minlength=k)
        return prev, symbols, np.arange(len(prev)) - (np.cumsum(counts) - counts)[symbols], counts

    head = starts[:-1].copy()
    for c in range(k):
        low = starts[c]
        while low < head[c]:
            prev, symbols, place, counts = spread(sa[low : head[c]], False)
            low = head[c]
            sa[head[symbols] + place] = prev
            head += counts
        if per[c]:
            prev, symbols, place, counts = spread(sa[ends[c] - per[c] : ends[c]], False)
            sa[head[symbols] + place] = prev
            head += counts
    tail = ends.copy()
    sa[0] = n - 1  # the sentinel
    tail[0] -= 1
    for c in range(k - 1, -1, -1):
        high = ends[c]
        while tail[c] < high:
            prev, symbols, place, counts = spread(sa[tail[c] : high][::-1], True)
            high = tail[c]
            sa[tail[symbols] - 1 - place] = prev
            tail -= counts
        if starts[c] < head[c]:
            prev, symbols, place, counts = spread(sa[starts[c] : head[c]][::-1], True)
            sa[tail[symbols] - 1 - place] = prev
            tail -= counts
    return sa


def _induce_one_by_one(rises: list[int], falls: list[int], first: list[int], lms: list[int], starts: list[int]) -> list[int]:
    """The same in two linear scans, for large alphabets whose buckets are small.

    ``falls[i]`` and ``rises[i]`` are the symbol before i if that position is of
    type L or S, else -1; one more entry, -1, is for places not filled yet.
    ``first`` are the first symbols of ``lms``. Iterators over a list see what
    is put into it ahead of them.
    """
    sa = [-1] * (len(rises) - 1)
    tail = starts[1:]
    for i, c in zip(reversed(lms), reversed(first)):
        tail[c] -= 1
        sa[tail[c]] = i
    head = starts[:-1]
    for i in sa:
        c = falls[i]
        if c >= 0:
            sa[head[c]] = i - 1
            head[c] += 1
    tail = starts[1:]
    for i in reversed(sa):
        c = rises[i]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = i - 1
    return sa


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``s`` (values below ``symbols``, the last one 0 and the only 0) by induced sorting.

    Suffixes are classified, the leftmost-smaller (LMS) substrings sorted by one
    induction and named, the string of their names is sorted recursively unless
    the names are all different, and the whole array is induced from that.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    is_s = suffix_types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = is_s[1:] & ~is_s[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    starts = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=symbols))))
    vector = n > 64 * symbols
    if vector:
        induce = lambda order: _induce_by_bucket(s, is_s, order, starts)
    else:
        rises, falls = np.full(n + 1, -1), np.full(n + 1, -1)
        before = s[:-1].astype(np.int64)
        rises[1:n], falls[1:n] = np.where(is_s[:-1], before, -1), np.where(is_s[:-1], -1, before)
        as_lists = rises.tolist(), falls.tolist()
        induce = lambda order: np.array(_induce_one_by_one(*as_lists, s[order].tolist(), order.tolist(), starts.tolist()), np.int32)
    found = induce(lms[np.argsort(s[lms], kind="stable")])
    ordered = found[is_lms[found]]
    # Names: equal LMS substrings get equal ones. Each reaches to the next LMS position and includes it.
    length = np.zeros(n, np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    live = np.flatnonzero(length[a] == length[b])
    same = np.zeros(len(a), bool)
    at = 0
    while len(live):
        over = length[a[live]] <= at
        same[live[over]] = True
        live = live[~over]
        live = live[s[a[live] + at] == s[b[live] + at]]
        at += 1
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(lms):
        name_at = np.zeros(n, np.int32)
        name_at[ordered] = names
        ordered = lms[suffix_array(name_at[lms], int(names[-1]) + 1)]
    return induce(ordered)


def window_groups(texts: np.ndarray, begin: np.ndarray, windows: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Equal windows of segments of ``texts``: (segment and place of each window, group) in an order that has groups together.

    A segment has ``windows`` windows, the first one at ``begin``. Returns
    segment * 2**16 + place, and whether each one starts a group.
    """
    size = windows + window - 1
    at = np.concatenate(([0], np.cumsum(size + 1)))
    n = int(at[-1]) + 1
    s = np.ones(n + window, np.uint16)  # 1: between segments; 0: at the end
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    s[np.repeat(at[:-1], size) + inner] = texts[np.repeat(begin, size) + inner].astype(np.uint16) + 2
    s[n - 1] = 0
    sa = suffix_array(s[:n], 258)
    # Permuted common prefixes up to the window's length, all segments side by side: each window starts
    # from the prefix of the window before it, less one.
    before = np.zeros(n, np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n - 1
    common = np.zeros(n, np.int32)
    order = np.argsort(-windows, kind="stable")
    top, base, prefix = windows[order], at[:-1][order], np.zeros(len(windows), np.int32)
    for k in range(int(top[0]) if len(top) else 0):
        some = int(np.searchsorted(-top, -k, "left"))  # those with more than k windows
        i = base[:some] + k
        j = before[i].astype(np.int64)
        h = np.maximum(prefix[:some] - 1, 0)
        live = np.arange(some)
        while len(live):
            live = live[h[live] < window]
            live = live[s[i[live] + h[live]] == s[j[live] + h[live]]]
            h[live] += 1
        prefix[:some] = h
        common[i] = h
    starts_window = np.zeros(n, bool)
    owner = np.repeat(np.arange(len(windows)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts_window[at[:-1][owner] + place] = True
    code = np.zeros(n, np.int64)
    code[at[:-1][owner] + place] = owner * (1 << 16) + place
    kept = sa[starts_window[sa]]
    return code[kept], common[kept] < window


# --- segments ------------------------------------------------------------------------------------


def _powers(n: int, odd: int) -> np.ndarray:
    out = np.full(n, odd, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """128-bit polynomial fingerprints of pieces of a byte array, of which a few megabytes at a time are best."""

    odds = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
    tables: dict = {}

    def __init__(self, data: np.ndarray, want: int = 2):
        n = len(data) + 1
        if len(self.tables.get("up", [[]])[0]) < n:
            room = 1 << n.bit_length()
            self.tables["up"] = [_powers(room, x) for x in self.odds]
            self.tables["down"] = [_powers(room, pow(x, -1, 1 << 64)) for x in self.odds]
        wide = data.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for up in self.tables["up"][:want]:
            sums = np.zeros(n, np.uint64)
            np.cumsum(wide * up[: n - 1], out=sums[1:])
            self.sums.append(sums)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        out = []
        for sums, down in zip(self.sums, self.tables["down"]):
            x = (sums[end] - sums[begin]) * down[begin]
            x ^= x >> np.uint64(29)
            out.append(x * _B ^ (end - begin).astype(np.uint64))
        return out


def grams_of(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    grams = np.ndarray((len(data) - GRAM + 1,), "<u8", data, 0, (1,)) * _A
    grams ^= grams >> np.uint64(32)
    grams *= _B
    return grams


def segments(data: np.ndarray, ends: np.ndarray, frequent: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """begin, windows, place of the minimiser after begin, and its hash, of the segments of texts that end at ``ends``.

    The minimiser of a window is its leftmost gram of the least 41-bit hash, with
    ``frequent`` ones (sorted) behind all others; it depends on the window's bytes
    alone.
    """
    n, none = len(data), np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none.astype(np.uint64)
    grams = grams_of(data)
    least = (grams >> np.uint64(1) & ~_AT) | np.arange(len(grams), dtype=np.uint64)
    if len(frequent):
        low = np.zeros(1 << 16, bool)
        low[frequent & np.uint64(0xFFFF)] = True
        some = np.flatnonzero(low[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.minimum(np.searchsorted(frequent, grams[some]), len(frequent) - 1)
        least[some[frequent[found] == grams[some]]] |= _LATE
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    at = (least & _AT).astype(np.int64)  # of each window
    # Windows that cross the end of a text are none; there are WINDOW - 1 of them between the runs of two texts.
    fine = np.ones(len(at), bool)
    cross = (ends[:-1, None] - np.arange(1, WINDOW)[None, :]).ravel()
    fine[cross[(cross >= 0) & (cross < len(at))]] = False
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (fine[1:] != fine[:-1])
    begin = np.flatnonzero(new)
    windows = np.diff(np.append(begin, len(at)))
    keep = fine[begin]
    begin, windows = begin[keep], windows[keep]
    return begin, windows, at[begin] - begin, grams[at[begin]]


def gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of pieces, one after another."""
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return data[np.repeat(begin, size) + inner]


def runs_of(order_keys: list[np.ndarray]) -> np.ndarray:
    """Whether each of sorted rows differs from the one before it in any key."""
    new = np.ones(len(order_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in order_keys])
    return new


ROWS = pa.schema([("bucket", pa.int32()), ("ranges", pa.binary()), ("part", pa.binary())])
ROWS_DDL = "bucket int, ranges binary, part binary"


def joined_ranges(doc: np.ndarray, rid: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """The ranges in order of document, overlapping and touching ones of a document made one."""
    if not len(doc):
        return [doc, rid, low, high]
    order = np.lexsort((low, rid, doc))
    doc, rid, low, high = doc[order], rid[order], low[order], high[order]
    new_doc = runs_of([doc, rid])
    # The reach of all before in the same document: documents are set apart by more than any text is long.
    apart = np.cumsum(new_doc) * (1 << 40)
    reach = np.maximum.accumulate(high + apart) - apart
    new = new_doc.copy()
    new[1:] |= low[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return [doc[first], rid[first], low[first], reach[np.append(first[1:], len(low)) - 1]]


def bucket_of(doc: np.ndarray, buckets: int) -> np.ndarray:
    return ((doc.astype(np.uint64) * _A >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def pieces_of(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run of a sorted array, whatever the range of its values."""
    begin = np.flatnonzero(runs_of([values]))
    return list(zip(values[begin].tolist(), begin.tolist(), np.append(begin[1:], len(values)).tolist()))


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    """(bucket, ranges, part) as Arrow."""
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], schema=ROWS)


def packed_ranges(columns: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Ranges by buckets of documents."""
    columns = joined_ranges(*columns)
    if not len(columns[0]):
        return
    bucket = bucket_of(columns[0], buckets)
    order = np.argsort(bucket, kind="stable")
    squeeze = zstandard.ZstdCompressor(level=3)
    rows = [(b, _packed([c[order[i:j]] for c in columns], RANGE_KINDS, squeeze), None) for b, i, j in pieces_of(bucket[order])]
    for i in range(0, len(rows), 1000):
        yield _rows_of(rows[i : i + 1000])


#: The columns of a part, one entry per segment in order of document: text bytes, windows, place of the
#: minimiser, document, row, start; and those of packed ranges: document, row, low, high.
PART_KINDS = ("u1", "u1", "u1", "<i8", "<i8", "<i8")
RANGE_KINDS = ("<i8", "<i8", "<i8", "<i8")


def _packed(columns: list[np.ndarray], kinds: tuple[str, ...], squeeze: zstandard.ZstdCompressor) -> bytes:
    """Columns by byte planes, which zstandard shortens much better than whole numbers; documents as steps."""
    doc = kinds.index("<i8")
    columns = [*columns[:doc], np.diff(columns[doc], prepend=0), *columns[doc + 1 :]]
    planes = [np.ascontiguousarray(np.asarray(x, k)).view(np.uint8).reshape(len(x), -1).T.tobytes() for x, k in zip(columns, kinds)]
    return np.array([len(x) for x in columns], "<i8").tobytes() + squeeze.compress(b"".join(planes))


def _unpacked(part: bytes, kinds: tuple[str, ...], expand: zstandard.ZstdDecompressor) -> list[np.ndarray]:
    sizes = np.frombuffer(part[: 8 * len(kinds)], "<i8")
    raw, out, at = expand.decompress(part[8 * len(kinds) :]), [], 0
    for n, kind in zip(sizes.tolist(), kinds):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    doc = kinds.index("<i8")
    out[doc] = np.cumsum(out[doc])
    return out


def frequent_grams(rows: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """Sorted hashes of the grams that are in most documents of a sample of ``rows`` (doc_id, text), bounded in number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for text in batch.column("text"):
                data = np.frombuffer((text.as_py() or "").encode()[: 1 << 20], np.uint8)
                if len(data) >= WINDOW:
                    found.append(np.unique(grams_of(data)))
        grams, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        # Only those that a share of the documents here has; at least two.
        keep = n >= max(2, len(found) // 200)
        yield pa.RecordBatch.from_arrays([pa.array(grams[keep].view(np.int64)), pa.array(n[keep])], names=["gram", "n"])

    total = rows.count()
    h = F.xxhash64("doc_id", "text")
    share = F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, FREQUENT_SAMPLE / max(1, total)))
    # Rows alike count once, however often they come.
    seen = rows.filter(share).groupBy(h.alias("h")).agg(F.first("text").alias("text")).select("text").coalesce(max(1, min(8, total // 500))).mapInArrow(count, "gram long, n long")
    top = seen.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "gram").limit(most)
    return np.sort(np.array([r["gram"] for r in top.collect()], np.int64).view(np.uint64))


def _cutter(buckets: int, sample: bytes, frequent: np.ndarray = np.zeros(0, np.uint64)):
    """Texts to segments by bucket. Of equal segments in a batch, only those of the smallest document travel: the others are found already."""

    def units(batches):
        for batch in batches:
            for doc, rid, text in zip(batch.column("doc_id").to_pylist(), batch.column("rid").to_pylist(), batch.column("text")):
                data = (text.as_py() or "").encode()
                for offset in range(0, max(len(data) - WINDOW + 1, 0), PART_BYTES):
                    yield NO_ID if doc is None else doc, rid, offset, data[offset : offset + PART_BYTES + WINDOW - 1]

    def flush(parts):
        squeeze = zstandard.ZstdCompressor(level=5, dict_data=zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        base, found = 0, []
        for datas, docs, rids, offsets in parts:
            data, lengths = np.frombuffer(b"".join(datas), np.uint8), np.array([len(x) for x in datas])
            ends = np.cumsum(lengths)
            begin, windows, place, minimiser = segments(data, ends, frequent)
            owner = np.searchsorted(ends, begin, "right")
            hashes = Hasher(data)(begin, begin + windows + WINDOW - 1)
            found.append((*hashes, begin + base, windows, place, minimiser, np.array(docs)[owner], np.array(rids)[owner], begin - (ends - lengths)[owner] + np.array(offsets)[owner]))
            base += len(data)
        data = np.frombuffer(b"".join(b"".join(p[0]) for p in parts), np.uint8)
        h1, h2, begin, windows, place, minimiser, doc, rid, start = (np.concatenate(x) for x in zip(*found))
        bucket = (minimiser % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, h2, h1))
        new = runs_of([h1[order], h2[order]])
        least = doc[order][new][np.cumsum(new) - 1]
        known = doc[order] > least
        again = order[known]
        yield from packed_ranges([doc[again], rid[again], start[again], start[again] + windows[again] + WINDOW - 1], buckets)
        sent = order[~known]
        sent = sent[np.lexsort((start[sent], doc[sent], bucket[sent]))]
        out, size = [], 0
        for b, i, j in pieces_of(bucket[sent]):
            own = sent[i:j]
            texts = gather(data, begin[own], windows[own] + WINDOW - 1)
            part = _packed([texts, windows[own], place[own], doc[own], rid[own], start[own]], PART_KINDS, squeeze)
            out.append((b, None, part))
            size += len(part)
            if size > 8 << 20:
                yield _rows_of(out)
                out, size = [], 0
        yield _rows_of(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total, now, size = [], 0, ([], [], [], []), 0
        for doc, rid, offset, data in units(batches):
            if size and size + len(data) > PART_BYTES:
                parts.append(now)
                now, size = ([], [], [], []), 0
                if total >= BATCH_BYTES:
                    yield from flush(parts)
                    parts, total = [], 0
            for held, x in zip(now, (data, doc, rid, offset)):
                held.append(x)
            size += len(data)
            total += len(data)
        if size:
            parts.append(now)
        if parts:
            yield from flush(parts)

    return cut


def candidates(parts: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of the segments of one bucket: ranges known to be repeated, and what may be so in part.

    The former are doc, rid, low and high of segments that a smaller document has
    as a whole. The latter are distinct texts (bytes, windows, smallest document)
    that share enough with another one, and the rows of that document (which
    text, doc, rid, start).
    """
    texts, windows, place, doc, rid, start = (np.concatenate(x) for x in zip(*parts))
    windows, place = windows.astype(np.int64), place.astype(np.int64)
    size = windows + WINDOW - 1
    begin = np.cumsum(size) - size
    # Windows of two texts can only be equal if both have the same bytes from HALF before the minimiser to its end, or from it to HALF behind it.
    left, right = place >= HALF, size - place >= GRAM + HALF
    h1, h2, left_key, right_key = (np.zeros(len(size), np.uint64) for _ in range(4))
    edges = np.searchsorted(begin, np.arange(0, len(texts), PART_BYTES))
    for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(size)]):
        if i < j:
            base, own = begin[i], slice(i, j)
            hashes, b, p = Hasher(texts[base : begin[j - 1] + size[j - 1]]), begin[own] - base, place[own]
            h1[own], h2[own] = hashes(b, b + size[own])
            left_key[own] = hashes(b + np.where(left[own], p - HALF, 0), b + np.where(left[own], p + GRAM, 0))[0]
            right_key[own] = hashes(b + np.where(right[own], p, 0), b + np.where(right[own], p + GRAM + HALF, 0))[0]
    order = np.lexsort((doc, h2, h1))
    new = runs_of([h1[order], h2[order]])
    heads = order[new]  # one of each text, of the smallest document
    text_of = np.empty(len(order), np.int64)
    text_of[order] = np.cumsum(new) - 1
    known = doc > doc[heads][text_of]
    shared = np.zeros(len(heads), bool)
    for key, there in ((left_key[heads], left[heads]), (right_key[heads], right[heads])):
        some = np.flatnonzero(there)
        by = np.argsort(key[some], kind="stable")
        first = runs_of([key[some[by]]])
        alone = first & np.append(first[1:], True)
        shared[some[by[~alone]]] = True
    number = np.cumsum(shared) - 1
    rows = np.flatnonzero(~known & shared[text_of])
    chosen = heads[shared]
    return (
        [doc[known], rid[known], start[known], start[known] + size[known]],
        [gather(texts, begin[chosen], size[chosen]), windows[chosen], doc[chosen], number[text_of[rows]], doc[rows], rid[rows], start[rows]],
    )


def repeated(shard: list[list[np.ndarray]]) -> list[np.ndarray]:
    """doc, rid, low, high of windows of the candidates of some buckets that smaller documents have too."""
    shift = np.cumsum([0] + [len(x[1]) for x in shard])
    texts, windows, least, _, doc, rid, start = (np.concatenate(x) for x in zip(*shard))
    text_of = np.concatenate([x[3] + n for x, n in zip(shard, shift)])
    size = windows + WINDOW - 1
    codes, first = window_groups(texts, np.cumsum(size) - size, windows)
    owner, at = codes >> 16, codes & 0xFFFF
    lowest = np.minimum.reduceat(least[owner], np.flatnonzero(first))[np.cumsum(first) - 1]
    hit = lowest < least[owner]
    owner, at = owner[hit], at[hit]
    rows = np.argsort(text_of, kind="stable")
    edges = np.searchsorted(text_of[rows], np.arange(len(windows) + 1))
    many = edges[owner + 1] - edges[owner]
    row = rows[np.repeat(edges[owner], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
    low = start[row] + np.repeat(at, many)
    return joined_ranges(doc[row], rid[row], low, low + WINDOW)


def _finder(buckets: int, sample: bytes, most: int = 1_000_000):
    """Rows sorted by bucket to ranges by buckets of documents; one bucket and one shard at a time are held."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)), zstandard.ZstdDecompressor()
        held: list[list[np.ndarray]] = []
        parts: list[list[np.ndarray]] = []
        shard: list[list[np.ndarray]] = []
        current, ranges_held, shard_bytes = None, 0, 0

        def hold(found):
            nonlocal ranges_held
            if len(found[0]):
                held.append(found)
                ranges_held += len(found[0])

        def close(last=False):
            nonlocal parts, shard, shard_bytes
            if parts:
                known, some = candidates(parts)
                hold(known)
                parts = []
                if len(some[1]):
                    shard.append(some)
                    shard_bytes += len(some[0])
            if shard and (last or shard_bytes >= SHARD_BYTES):
                hold(repeated(shard))
                shard, shard_bytes = [], 0

        def flush():
            nonlocal ranges_held
            if held:
                yield from packed_ranges([np.concatenate(x) for x in zip(*held)], buckets)
                held.clear()
                ranges_held = 0

        for batch in batches:
            for bucket, ranges, part in zip(*(batch.column(c).to_pylist() for c in ("bucket", "ranges", "part"))):
                if bucket != current:
                    close()
                    current = bucket
                    if ranges_held > most:
                        yield from flush()
                if part is not None:
                    parts.append(_unpacked(part, PART_KINDS, expand))
                if ranges is not None:
                    hold(_unpacked(ranges, RANGE_KINDS, plain))
        close(last=True)
        yield from flush()

    return find


DOC_RANGES = pa.schema([("doc", pa.int64()), ("rid", pa.int64()), ("__ranges", pa.binary())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket of documents to one row per document with all its ranges."""
    plain = zstandard.ZstdDecompressor()
    held: list[list[np.ndarray]] = []
    current = None

    def close():
        if not held:
            return
        doc, rid, low, high = joined_ranges(*[np.concatenate(x) for x in zip(*held)])
        held.clear()
        pairs = np.stack((low, high), 1).astype("<i8")
        cut = np.flatnonzero(runs_of([doc, rid]))
        blobs = [pairs[a:b].tobytes() for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)])]
        for i in range(0, len(cut), 5000):
            own = cut[i : i + 5000]
            yield pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(rid[own]), pa.array(blobs[i : i + 5000], pa.binary())], schema=DOC_RANGES)

    for batch in batches:
        for bucket, ranges in zip(batch.column("bucket").to_pylist(), batch.column("ranges").to_pylist()):
            if bucket != current:
                yield from close()
                current = bucket
            held.append(_unpacked(ranges, RANGE_KINDS, plain))
    yield from close()


def spans_of(blob: bytes | None) -> list[list[int]]:
    return [] if blob is None else np.frombuffer(blob, "<i8").reshape(-1, 2).tolist()


def repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``__ranges``: packed byte ranges that smaller documents have too."""
    spark = docs.sparkSession
    names = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    # A row is known by its doc_id, and by a hash of its text too if some doc_id comes twice.
    again = docs.groupBy(F.col("doc_id").cast("long")).count().filter("count > 1").limit(1).count()
    keys = F.col("doc_id").cast("long"), F.xxhash64("text") if again else F.lit(0).cast("long")
    rows = docs.select(keys[0].alias("doc_id"), "text", keys[1].alias("rid"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffled = partitions(spark, total)
    buckets = min(max(shuffled, int(total * SWELL / BUCKET_BYTES)), MOST_BUCKETS)
    # A bounded sample of text as a dictionary for what is shipped; it changes sizes, not results.
    sample = "\n".join(r[0] for r in rows.select(F.substring("text", 1, 1500)).filter("text IS NOT NULL").limit(40).collect()).encode() or b"none"
    sent = rows.mapInArrow(_cutter(buckets, sample, frequent_grams(rows)), ROWS_DDL)
    found = sent.repartition(shuffled, "bucket").sortWithinPartitions("bucket").mapInArrow(_finder(buckets, sample), ROWS_DDL)
    ranges = found.repartition(shuffled, "bucket").sortWithinPartitions("bucket").mapInArrow(_merge, "doc long, rid long, __ranges binary")
    whole = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.coalesce(keys[0], F.lit(int(NO_ID))).alias("__doc"), keys[1].alias("__rid"))
    out = whole.join(ranges, (F.col("__doc") == F.col("doc")) & (F.col("__rid") == F.col("rid")), "left")
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "__ranges")


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text).

    Each byte covered by a string of WINDOW bytes that also starts in a document
    with a smaller doc_id goes. Null text is empty. A null doc_id is larger than
    any other; rows with the same doc_id (null among them) remove nothing from
    each other. Texts under WINDOW bytes stay whole. An empty table gives no
    rows; other columns are ignored.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for batch in batches:
            rows = []
            for text, blob in zip(batch.column("text"), batch.column("__ranges")):
                data, spans = (text.as_py() or "").encode(), spans_of(blob.as_py())
                kept, at = hashlib.sha256(), 0
                for low, high in spans:
                    kept.update(data[at:low])
                    at = high
                kept.update(data[at:])
                rows.append((len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=names)

    found = repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept_text(text: str | None, spans: list[list[int]]) -> str | None:
    """The text without the spans; characters cut through go whole."""
    if not spans:
        return text
    data, out, at = text.encode(), [], 0
    for low, high in spans:
        out.append(data[at:low])
        at = high
    out.append(data[at:])
    return "".join(x.decode("utf-8", "ignore") for x in out)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) with the repeated bytes taken out of their texts; documents left empty by that go.

    A character that is cut through goes whole. n_chars, if there is one, follows the text.
    """
    inner = repeats(docs)
    at = inner.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for text, blob in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                spans = spans_of(blob.as_py())
                texts.append(kept_text(text.as_py(), spans))
                gone.append(bool(spans) and not texts[-1])
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.bool_())], names=[*batch.schema.names[:-1], "__gone"])

    schema = T.StructType([*inner.schema.fields[:-1], T.StructField("__gone", T.BooleanType())])
    out = inner.mapInArrow(cut, schema).filter(~F.col("__gone"))
    return out.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents").select("doc_id", "text"))
