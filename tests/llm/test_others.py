"""Sharding, mixing, language ID, WARC, packing, quality and top-k search against plain versions and round trips."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quillgraph.llm import langid, mixing, packing, quality, sharding, topk, warc


def plain_best_fit(sizes, capacity, most=None):
    """Item by item, largest first: the sums of the bins, or None if there are too many."""
    rooms, sums = [], []
    for s in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= s]
        if not fits:
            if len(rooms) == most:
                return None
            rooms.append(max(capacity, s))
            sums.append(0)
            fits = [(rooms[-1], len(rooms) - 1)]
        i = min(fits)[1]
        rooms[i] -= s
        sums[i] += s
    return sums


def sums_of(runs):
    sums = Counter()
    for s, n, b in runs:
        sums[b] += s * n
    return [sums[b] for b in sorted(sums)]


def test_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randint(20, 60)
        sizes = [rng.randint(1, rng.choice((5, 25))) for _ in range(rng.randint(0, 120))]
        entries = sorted(Counter(sizes).items(), reverse=True)
        runs = sharding.best_fit_decreasing(entries, capacity)
        assert sums_of(runs) == plain_best_fit(sizes, capacity)
        most = rng.randint(1, 30)
        assert (sharding.best_fit_decreasing(entries, capacity, most) is None) == (plain_best_fit(sizes, capacity, most) is None)


def plain_even(sizes, bins):
    sizes, alone = sorted(sizes, reverse=True), []
    while sizes and len(alone) < bins - 1 and sizes[0] * (bins - len(alone)) >= sum(sizes):
        alone.append(sizes.pop(0))
    if not sizes:
        return alone
    left = bins - len(alone)
    low = high = max(sizes[0], -(-sum(sizes) // left))
    step = 1
    while plain_best_fit(sizes, high, left) is None:
        low, high, step = high + 1, high + step, 2 * step
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if plain_best_fit(sizes, middle, left) is not None else (middle + 1, high)
    return alone + plain_best_fit(sizes, high, left)


def test_even_bins():
    sizes = [500, 90, 3, 3] + [7] * 200
    sums = sums_of(sharding.even_bins(sorted(Counter(sizes).items(), reverse=True), 4))
    assert sums == plain_even(sizes, 4) and sums[0] == 500 and max(sums[1:]) - min(sums[1:]) <= 8
    assert sharding.even_bins([], 4) == [] and sharding.even_bins([(9, 2)], 4) == [(9, 1, 0), (9, 1, 1)]


@pytest.mark.parametrize("shards", [3, 8, 5000])
def test_sharding(docs, rows, empty, shards):
    found = sharding.shard(docs, shards).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    where, sums, groups = {}, Counter(), Counter()
    for r in found:
        where.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        sums[r["shard"]] += r["size"]
        groups[r["size"], r["text_crc32"]] += r["size"]
    assert all(len(s) == 1 for s in where.values())
    # The same shards as best fit decreasing of the groups one by one, at the same capacity.
    assert [sums[k] for k in sorted(sums)] == plain_even(list(groups.values()), shards) and max(sums) < shards
    for k in sums:
        slots = sorted(r["slot"] for r in found if r["shard"] == k)
        assert slots == list(range(len(slots)))
    assert sharding.shard(empty, shards).collect() == []


def test_shards_of_fixed_capacity(docs, empty):
    sums, groups = Counter(), Counter()
    for r in sharding.shard(docs, capacity=3000).collect():
        sums[r["shard"]] += r["size"]
        groups[r["size"], r["text_crc32"]] += r["size"]
    assert [sums[k] for k in range(len(sums))] == plain_best_fit(groups.values(), 3000)
    assert all(n <= 3000 or n in groups.values() for n in sums.values())
    assert sharding.shard(empty, capacity=10).collect() == []


def test_many_sizes_in_few_shards(spark):
    """Sizes with many groups that are dealt over several shards, and one text that a third of the rows have."""
    rows = [(i, f"{i:05d}" + "x" * (i % 3)) for i in range(4000)] + [(i, "hot") for i in range(2000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    sums = Counter()
    for r in found:
        sums[r["shard"]] += r["size"]
    assert len(found) == 6000 and len({r["shard"] for r in found if r["text_crc32"] == zlib.crc32(b"hot")}) == 1
    rest = sorted(sums.values())[:-1] if 2000 * 4 * 8 > sum(sums.values()) else sorted(sums.values())
    assert len(sums) == 8 and max(rest) - min(rest) <= 8


def test_mixing(docs, rows, empty, spark):
    found = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, free, left = {}, set(names), sum(sizes.values())
    while True:
        level = left / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    targets |= {s: level * weights[s] for s in free}
    assert len(found) == len(rows)
    for r in found:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = targets[r["source"]] / sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] and int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 3
    assert Counter(map(str, found)) == Counter(map(str, mixing.mix(docs.repartition(3)).collect()))
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["copies"] for r in found)
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).collect() == []
    # Texts under null or repeated ids are drawn each for itself.
    many = spark.createDataFrame([(None if i % 2 else 7, f"word{i} " * 5, "a") for i in range(2000)] + [(i, "w " * 10, "b") for i in range(1000)], "doc_id long, text string, source string")
    some = mixing.mix(many).groupBy("source", "doc_id").sum("taken", "size").filter("source = 'a'").collect()
    target = mixing.mix(many).filter("source = 'a'").first()["target"]
    assert abs(sum(r["sum(taken)"] for r in some) - target) < 0.1 * target and all(r["sum(taken)"] for r in some)
    silent = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.mix(silent).collect()] == [(0, 0.0), (0, 0.0)]


def test_language_id(spark, empty):
    rng = random.Random(0)
    parts = {"xx": ["ban", "ko", "lu", "ter", "mi"], "yy": ["sch", "orf", "est", "ung", "ig"], "zz": ["ío", "què", "çal", "ñar", "üx"]}
    word = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(rng.randint(8, 200))), lang) for i in range(400) for lang in [rng.choice("xxx yyy zzz".split())[:2]]]
    more = [(900, None, "xx"), (901, "", "yy"), (902, "12 34 !!", "zz"), (903, rows[0][1], None), (None, rows[1][1], "xx"), (0, rows[0][1], rows[0][2]), (904, rows[2][1] * 400, rows[2][2])]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "'q' AS rejected")
    contents = langid.dictionaries(docs)
    assert set(contents) == set(parts) and all(len(x) <= langid.DICTIONARY_BYTES for x in contents.values())
    found = langid.identify(docs, contents).collect()
    assert len(found) == len(rows) + len(more)
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    unknown = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert unknown == {900, 901, 902} and all(r["rejected"] for r in found if r["lang_pred"] == "und")
    assert langid.dictionaries(empty) == {} and langid.identify(empty, {}).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}


def test_language_id_rejects_narrow_margins(spark):
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    vocabulary = {lang: [word(letters) for _ in range(300)] for lang, letters in (("a", "abcdefgh"), ("b", "ijklmnop"), ("c", "qrstuvwx"))}
    prose = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    contents = {lang: prose(lang, 3000).encode() for lang in vocabulary}
    clear = [(i, prose("abc"[i % 3], rng.randint(3, 300))) for i in range(60)]
    half = [(100 + i, prose("a", 100) + " " + prose("b", 100)) for i in range(10)]
    strange = [(200 + i, " ".join("".join(rng.choice("yzäöüß") for _ in range(6)) for _ in range(150))) for i in range(10)]
    docs = spark.createDataFrame(clear + half + strange, "doc_id long, text string")
    found = {r["doc_id"]: r for r in langid.identify(docs, contents).collect()}
    assert all(found[i]["lang_pred"] == "abc"[i % 3] and not found[i]["rejected"] for i, _ in clear)
    assert sum(found[i]["rejected"] for i, _ in half) >= 8  # as much of one as of the other
    assert all(found[i]["rejected"] for i, _ in strange)  # a language that was not learned
    # Two dictionaries all but equal among four: a tie, whatever the score.
    tied = contents | {"d": contents["a"], "e": contents["a"][:-8]}
    for r in langid.identify(docs, tied).collect():
        assert r["rejected"] == (r["doc_id"] >= 100 or r["doc_id"] % 3 == 0) or 100 <= r["doc_id"] < 200
    one, score, margin = langid.Classifier({"a": contents["a"]})(clear[0][1])
    assert one == "a" and score == 1 and margin > 0.1  # against no dictionary
    assert langid.Classifier({"a": contents["a"]})(strange[0][1])[2] < langid.NARROW


def test_language_id_learns_from_a_bounded_sample(spark):
    """Rows that come again and again, and null ids, add nothing to what is collected."""
    rows = [(None, "the same text over and over", "en")] * 500 + [(i, f"text number {i}", "fr") for i in range(500)]
    found = langid.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=50)
    assert found.get("en", b"") in (b"", b"the same text over and over") and 20 < found["fr"].count(b"number") < 90


def plain_warc(rows):
    first = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(first.get(html, page), page)
    return sorted(((p, len((h or "").encode()), "response" if h not in first or first[h] == p else "revisit", None if h not in first or first[h] == p else first[h]) for p, _, h in rows), key=str)


def test_warc_round_trip(spark, monkeypatch):
    rng = random.Random(4)
    body = lambda n: "".join(rng.choice("<p>abc é日\r\n\0") for _ in range(n))
    same, short, long = body(400), "x" * 60, body(300_000)
    rows = [(i, f"http://h{i}.example/ä?q={i}\r\nX: y", body(rng.randint(0, 900))) for i in range(40)]
    rows += [(50, None, same), (47, "u", same), (99, "u", same), (60, "u", short), (61, "u", short), (62, "", None), (63, None, ""), (64, "u", long), (65, "u", long)]
    rows += [(None, "u", same), (None, "u", body(200)), (47, "u", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload")
    for size in (1 << 27, 1 << 12):  # one archive for each task, then many
        monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
        found = warc.round_trip(pages).collect()
        assert sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found), key=str) == plain_warc(rows)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_members_and_index(tmp_path):
    import gzip
    import json

    made = [warc.record_bytes(i, "http://a/", "response", None, "0" * 64, b"\r\n\r\nbody" * i) for i in range(5)]
    (tmp_path / "in.gz").write_bytes(gzip.compress(b"".join(made[:2])) + gzip.compress(b"".join(made[2:])))
    where = lambda n: f"file://{tmp_path}/{n}"
    assert warc.normalise(where("in.gz"), where("out.gz"), where("index")) == 5
    data = (tmp_path / "out.gz").read_bytes()
    entries = [json.loads(x) for x in (tmp_path / "index").read_text().splitlines()]
    assert [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in entries] == made
    (tmp_path / "cut.gz").write_bytes((tmp_path / "in.gz").read_bytes()[:-30])
    with pytest.raises((ValueError, zlib.error)):
        warc.normalise(where("cut.gz"), where("o"), where("i"))


def test_foreign_records(spark, tmp_path):
    """Archives of others: a warcinfo, headers without blanks, folded ones, digests of other kinds or none, more blank lines."""
    import base64
    import gzip
    import hashlib
    import json

    http = b"HTTP/1.1 200 OK\r\ncontent-length:5\r\n\r\nhello"
    sha1 = base64.b32encode(hashlib.sha1(b"hello").digest())
    made = [
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 12\r\n\r\nsoftware: x\n\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type:response\r\nwarc-record-id:<urn:uuid:1>\r\nContent-Length:%d\r\n\r\n%s\r\n\r\n" % (len(http), http),
        b"WARC/1.1\r\nContent-Length: %d\r\nWARC-Record-ID: <urn:page:5>\r\nWARC-Target-URI: http://a/\r\n  folded\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\n\r\n%s\r\n\r\n" % (len(http), sha1, http),
        b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    ]
    (tmp_path / "in.gz").write_bytes(gzip.compress(made[0] + b"\r\n\r\n" + b"".join(made[1:])))
    where = lambda n: f"file://{tmp_path}/{n}"
    assert warc.normalise(where("in.gz"), where("out.gz"), where("index")) == 4
    entries = [json.loads(x) for x in (tmp_path / "index").read_text().splitlines()]
    data = (tmp_path / "out.gz").read_bytes()
    assert [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in entries] == made
    assert [(e["id"], e["type"], e["digest"]) for e in entries] == [(None, "warcinfo", None), ("<urn:uuid:1>", "response", None), ("<urn:page:5>", "response", f"sha1:{sha1.decode()}"), ("<urn:uuid:2>", "metadata", None)]
    found = warc.read_back(spark.createDataFrame([(where("out.gz"), where("index"), 4)], "archive string, index string, n long")).collect()
    digest = hashlib.sha256(b"hello").hexdigest()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 5, digest, "response", None), (5, 5, digest, "response", None)], key=str)
    assert not warc.digest_fits("sha1:" + "A" * 32, b"hello") and not warc.digest_fits("sha256:" + "0" * 64, b"hello") and warc.digest_fits(None, b"")
    (tmp_path / "bad.gz").write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nxx"))
    with pytest.raises(ValueError, match="no content length"):
        warc.normalise(where("bad.gz"), where("o"), where("i"))


def test_encoders_agree():
    from tokenizers import Tokenizer

    files = packing.tokenizer_files()
    encode, full = packing.encoder(files), Tokenizer.from_file(files[0])
    rng = random.Random(6)
    texts = ["", " ", "a<|endoftext|>b", "it's we'll I'M", "x" * 5000, "1234567 89", "\n\n \t x\r\n"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(1, 0x250), rng.randrange(0x400, 0xD7FF), rng.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(60)]
    for t in texts:
        assert list(encode(t)) == full.encode(t, add_special_tokens=False).ids, t


def test_cuts():
    assert packing.cuts(1, 8) == [(0, 1)] and packing.cuts(8, 8) == [(0, 8)] and packing.cuts(19, 8) == [(0, 3), (3, 8), (11, 8)]


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_sequences(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 50))}
    places, sequences = packing.plan(counts, 64)
    used = Counter()
    for length, n in counts.items():
        rows = places[length]
        for number in range(n):
            k = np.searchsorted(rows[:, 0], number, "right") - 1
            used[(int(rows[k, 1] + number - rows[k, 0]), int(rows[k, 2]))] += length
    by = {}
    for (sequence, offset), length in used.items():
        by.setdefault(sequence, []).append((offset, length))
    assert len(by) == sequences
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sequences <= 1.25 * max(-(-sum(k * n for k, n in counts.items()) // 64), sum(n for k, n in counts.items() if k > 32)) + 1


def test_packing(docs, rows, empty):
    found = packing.pack(docs, with_ids=True).collect()
    encode = packing.encoder(packing.tokenizer_files())
    got, now = Counter(), []
    for r in sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["piece"])):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] <= 4 * 2048
    single = Counter(r[0] for r in rows)
    for doc in {r[0] for r in rows if single[r[0]] == 1}:
        own = sorted((r for r in found if r["doc_id"] == doc), key=lambda r: r["piece"])
        ids = b"".join(r["ids"] for r in own)
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own[:-1]]))
        got[tuple(np.frombuffer(ids, "<u4").tolist())] += 1
        now.append(doc)
    assert got == Counter(tuple([*encode(r[1] or ""), 0]) for r in rows if r[0] in now)
    # Rows with repeated and null ids: the same pieces as each row cut by itself.
    pieces = Counter((r[0], k, start, zlib.crc32(np.array([*encode(r[1] or ""), 0], "<u4")[start : start + n].tobytes())) for r in rows for k, (start, n) in enumerate(packing.cuts(len(encode(r[1] or "")) + 1)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in found) == pieces
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]])) and sum(n for _, n in parts) <= 2048
    assert packing.pack(empty).collect() == []


def test_quality(spark, empty):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) + ("" if good else rng.choice(["!!", " |", ""])) for _ in range(rng.randint(10, 80)))
        rows.append((i, text))
        labels.append((i, int(good), 0))
    rows += [(2000, None), (2001, ""), (2002, words[0] * 30_000), (None, "x"), (3, rows[3][1])]
    labels += [(None, 1, 0), (5, None, 0), (7, 2, 0), (99_999, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS y", "2 AS quality", "3 AS score")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.score(docs, quality.learn(docs, table)).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert quality.score(empty, quality.learn(empty, table)).collect() == []
    one = quality.learn(docs, table.filter("quality = 1"))
    assert {r["score"] for r in quality.score(docs, one).collect()} == {1.0}


def test_quality_against_plain_version(spark):
    """Vectors, pooling and the network's output, each from its definition."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abc") for _ in range(3)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice([*words, "7", "X!", "Long", "aa"]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2 + [(4, 1), (5, 0)], "doc_id long, quality int")  # 4 and 5 have both labels
    numbers, vectors, model = quality.learn(docs, labels, per_class=10_000, vocabulary=8)
    training = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 and i not in (4, 5)]
    ids_of = lambda text: quality.row_numbers(text, numbers).tolist()
    counts = Counter(w for t in training for w in quality.TOKEN.findall(t))
    assert set(numbers) == {*quality.SHAPES, *sorted(counts, key=lambda w: (-counts[w], w))[:8]}
    names = sorted(numbers, key=numbers.get)
    own = quality.index_vectors(names)
    sums = np.zeros(own.shape)
    for t in training:
        ids = ids_of(t)
        for i, a in enumerate(ids):
            for d in range(1, quality.WINDOW + 1):
                if i + d < len(ids):
                    sums[a] += np.roll(own[ids[i + d]], d)
                    sums[ids[i + d]] += np.roll(own[a], -d)
    plain = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1e-9) + own / quality.ONES**0.5
    assert np.allclose(vectors, plain, atol=1e-6)
    assert all((own != 0).sum(axis=1) == quality.ONES) and set(np.unique(own)) == {-1, 0, 1}
    for r in quality.score(docs, (numbers, vectors, model)).collect():
        ids = ids_of(rows[r["doc_id"]][1])
        x = np.zeros(2 * quality.DIMENSIONS)
        if ids:
            x = np.concatenate((np.mean([plain[i] for i in ids], axis=0), np.sum([plain[i] for i in set(ids)], axis=0) / len(ids) ** 0.5 / 8))
        z = (x - model.mean) / model.scale
        w1, b1, w2, b2 = model.weights
        logit = sum(max(0.0, float(z @ w1[:, k] + b1[k])) * w2[k] for k in range(len(w2))) + b2[0]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-logit / model.temperature)), abs=1e-4)


def plain_top(rows, k, every):
    vectors = []
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.append((i, vec_id, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    out = []
    for i, q, a in vectors:
        if q % every == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b)), c) for j, c, b in vectors if j != i))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_exact_top_k(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.choice([-0.5, -0.25, 0.0, 0.3, 0.5], 8)]) for i in range(-30, 170)]
    rows += [(20, rows[5][1]), (300, None), (320, [None] * 8), (340, [float("nan")] * 8), (360, [float("inf")] * 8), (None, rows[0][1]), (400, [0.25] * 3), (420, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS shard")
    expected = plain_top(rows, 7, 20)
    assert sorted(map(tuple, topk.top_k(frame, 7, 20).collect())) == expected
    monkeypatch.setattr(topk, "TILE", 16)  # many tiles, shards and groups, and lists merged in more than one round
    monkeypatch.setattr(topk, "FAN_IN", 3)
    assert sorted(map(tuple, topk.top_k(frame, 7, 20, query_rows=4, shard_rows=20).collect())) == expected
    assert topk.top_k(frame.limit(0)).collect() == []


def test_large_components(spark):
    rows = [(0, [3e5, 1.0]), (20, [3e5, 2.0]), (7, [1e30, -1e30]), (8, [-4e6, 5e6])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    as_ints = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    rng = random.Random(3)
    rows += [(i, [rng.choice((1.0, 1e14, 3e9, -2e5)) * rng.randint(-9, 9), rng.random()]) for i in range(40, 90)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    as_ints = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    expected = []
    for q, a in as_ints:
        if q % 20 == 0:
            best = sorted((-clip(sum(x * y for x, y in zip(a, b))), c) for c, b in as_ints if c != q)
            expected += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best[:20])]
    assert sorted(map(tuple, topk.top_k(frame).collect())) == sorted(expected)
