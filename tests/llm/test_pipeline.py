"""Each stage of the pipeline against a plain version of it, on the stage's own input."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from quillgraph.llm import langid, packing

from .test_dedup import plain_near_groups

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def plain_language_id(spark, docs, rows):
    contents = langid.dictionaries(docs)
    coders = [zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False) for x in contents.values()]
    out = []
    for r in rows:
        letters = " ".join("".join(c if c.isalpha() else " " for c in (r[1] or "").lower()).split()).encode()
        if letters:
            least, after = sorted(len(c.compress(letters + b" " * 128)) for c in coders)[:2]
            if after - least >= 0.03 * min(least, 1024):
                out.append(r)
    return out


def plain_near_duplicates(spark, docs, rows):
    groups = {}
    for r, g in zip(rows, plain_near_groups(rows)):
        groups.setdefault(g, []).append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def plain_repeated_passages(spark, docs, rows):
    key = lambda d: (d is None, d or 0)
    first = {}
    for r in rows:
        data = (r[1] or "").encode()
        for i in range(len(data) - 49):
            w = data[i : i + 50]
            first[w] = min(first.get(w, key(r[0])), key(r[0]))
    out = []
    for r in rows:
        data = (r[1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key(r[0]):
                gone[i : i + 50] = True
        # Maximal kept runs are decoded each for itself, so characters cut through go.
        runs, text = np.flatnonzero(np.diff(np.concatenate(([1], gone[:-1].astype(int), [1])))), ""
        for a, b in zip(runs[::2], runs[1::2]):
            text += data[a:b].decode("utf-8", "ignore")
        if not gone.any():
            out.append((*r[:4], len(r[1]) if r[1] is not None else None))
        elif text:
            out.append((r[0], text, r[2], r[3], len(text)))
    return out


def plain_mix(spark, docs, rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, free, left = {}, set(names), sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            targets |= {s: level * weights[s] for s in free}
            break
        targets |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    out = []
    for r in rows:
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        own = hashlib.md5((r[1] or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}:{own}".encode()).hexdigest()[:13], 16) / (1 << 52)
        out += [r] * (int(rate) + (u < rate - int(rate)))
    return out


@pytest.fixture()
def mixed_prose(spark, rows):
    """The rows with prose of a second language among them, and a few that a classifier must reject."""
    other = [(1000 + i, " ".join(f"{'zxqwv'[j % 5]}{'üöäß'[(i + j) % 4]}{'kptk'[j % 4]}" for j in range(60 + i)), "de", f"s{i % 3}", 0) for i in range(12)]
    odd = [(2000, "123 456 !!", "en", "s1", 10), (2001, None, "en", "s1", None)]
    return spark.createDataFrame(rows + other + odd, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, mixed_prose, tmp_path):
    plain = {"language_id": plain_language_id, "near_duplicates": plain_near_duplicates, "repeated_passages": plain_repeated_passages, "mixing": plain_mix}
    assert [n for n, _ in corpus_pipeline.STAGES] == [*plain, "packing"]
    docs = mixed_prose
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = rows_of(docs)
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        path = f"file://{tmp_path}/{name}"
        out.write.parquet(path)
        found, expected = Counter(rows_of(spark.read.parquet(path))), Counter(plain[name](spark, docs, given))
        assert found == expected, name
        assert name == "mixing" or 0 < sum(found.values()) < len(given) or name == "repeated_passages"
        docs = spark.read.parquet(path)
    encode = packing.encoder(packing.tokenizer_files())
    expected = Counter()
    for doc_id, text, *_ in rows_of(docs):
        ids = np.array([*encode(text or ""), 0], "<u4")
        for k, (start, length) in enumerate(packing.cuts(len(ids))):
            expected[doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == expected
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_run(spark, mixed_prose, tmp_path):
    """The whole, twice: the same pieces, whatever the partitions."""
    seen = []
    for n in (1, 5):
        mixed_prose.repartition(n).write.parquet(f"file://{tmp_path}/{n}/documents.parquet")
        seen.append(Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, f"file://{tmp_path}/{n}").collect()))
    assert seen[0] == seen[1] and seen[0]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_on_no_documents(spark, empty, tmp_path):
    empty.write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").collect() == []
