"""Suffix arrays, SimHash and spot signatures against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from quillgraph.llm import simhash, spotsigs, suffix


@pytest.mark.parametrize("symbols", [1, 2, 3, 7, 200])
def test_suffix_array(symbols):
    rng = random.Random(symbols)
    for n in (0, 1, 2, 5, 60, 700, 5000):
        text = [rng.randint(1, symbols) for _ in range(n)] + [0]
        found = suffix.suffix_array(np.array(text, np.uint16), symbols + 1)
        if n <= 700:
            assert found.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        else:
            assert sorted(found.tolist()) == list(range(n + 1))
            for a, b in zip(found[:-1].tolist(), found[1:].tolist()):
                assert text[a : a + 400] <= text[b : b + 400]


def plain_removals(rows):
    key = lambda d: (d is None, d or 0)
    first = {}
    for doc, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            w = data[i : i + 50]
            if w not in first or key(doc) < first[w]:
                first[w] = key(doc)
    out = []
    for doc, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 2, int)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key(doc):
                gone[i + 1 : i + 51] = 1
        kept = bytes(b for b, g in zip(data, gone[1:]) if not g)
        out.append((doc, len(data), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_removals(docs, rows, empty):
    found = sorted(map(tuple, suffix.removals(docs).collect()), key=str)
    assert found == plain_removals(rows)
    assert any(r[2] for r in found)
    assert suffix.removals(empty).collect() == []


def test_removals_over_small_parts(docs, rows, monkeypatch):
    for name, value in (("PART_BYTES", 1 << 10), ("BATCH_BYTES", 1 << 12), ("BUCKET_BYTES", 1 << 12)):
        monkeypatch.setattr(suffix, name, value)
    assert sorted(map(tuple, suffix.removals(docs).collect()), key=str) == plain_removals(rows)


def test_without_repeats(docs, rows, empty):
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns
    found = out.collect()
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in found)
    texts = {r["doc_id"]: r["text"] for r in found}
    assert texts[0] == rows[0][1] and 30 in texts and texts[30] is None and texts[33] == ""
    assert len(found) < len(rows)  # whole copies are left empty, and go
    assert suffix.without_repeats(empty).collect() == []


def test_removals_with_very_many_buckets(docs, rows, monkeypatch):
    """Far more buckets than segments: what is held follows the segments."""
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 1e-9)
    monkeypatch.setattr(suffix, "MOST_BUCKETS", 10_000_000)
    assert sorted(map(tuple, suffix.removals(docs).collect()), key=str) == plain_removals(rows)


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, count=False):
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    if count:
        return len({find(i) for i in range(len(rows))})
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], f"{prints[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_simhash(docs, rows, empty):
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == plain_components(rows)
    assert simhash.near_duplicates(empty).collect() == []


def test_majority():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 4, 5, 8, 9, 27, 64, 1000):
        hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        assert int(simhash.majority(hashes)) == sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > n)


def test_links_of_dense_clusters(spark):
    """Chains and clusters of fingerprints around a few centres, more than a block of 64 in a bucket."""
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for centre in (0, rng.getrandbits(64)):
        prints |= {centre ^ sum(1 << rng.randrange(12) for _ in range(4)) for _ in range(300)}
        step = centre
        for _ in range(30):
            step ^= 1 << rng.randrange(64)
            prints.add(step)
    prints = sorted(p & (1 << 64) - 1 for p in prints)
    keys, values = [], []
    for i, mask in enumerate(simhash.bucket_masks()):
        for p in prints:
            keys.append((i, p & mask))
            values.append(p)
    order = sorted(range(len(keys)), key=lambda k: (keys[k], values[k]))
    ids = np.cumsum([k == 0 or keys[order[k]] != keys[order[k - 1]] for k in range(len(order))])
    a, b = simhash.linked(ids, np.array([values[k] for k in order], np.uint64), pairs_at_once=500)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    def join(x, y):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    for x, y in zip(a.tolist(), b.tolist()):
        join(x, y)
    mine = [find(p) for p in prints]
    root = {p: p for p in prints}
    for i, x in enumerate(prints):
        for y in prints[:i]:
            if (x ^ y).bit_count() <= 2:
                join(x, y)
    assert mine == [find(p) for p in prints]


def test_components_of_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


def plain_sketch(text):
    """The wide fingerprint counted bit by bit, and the keys."""
    words = (re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()).split()
    shingles = {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    mix = lambda x: int(simhash.mixed(np.array([x], np.uint64))[0])
    wide = 0
    for word in range(simhash.NEAR_WORDS):
        own = [mix(h ^ mix(word + 1)) for h in hashes]
        wide |= sum(1 << 64 * word + b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))
    return b" ".join(words), wide, {int(k) for k in simhash.sketch(text)[2]}


def plain_near_groups(rows):
    """The group of each row, from all pairs."""
    found = {r[1]: plain_sketch(r[1]) for r in rows}
    prints, root = [found[r[1]] for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (words, wide, keys) in enumerate(prints):
        for j, (words2, wide2, keys2) in enumerate(prints[:i]):
            if words == words2 or keys & keys2 and (wide ^ wide2).bit_count() <= simhash.NEAR_RADIUS:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_representatives(docs, rows, empty):
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    groups = {}
    for r, g in zip(rows, plain_near_groups(rows)):
        groups.setdefault(g, []).append(r)
    expected = sorted((min((r[0] is None, r[0] or 0) for r in g) for g in groups.values()))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == expected
    assert simhash.representatives(empty).collect() == []


def test_near_copies(spark):
    """Copies with a likeness over 0.85 are found, those under 0.6 are not; in one cell and in many."""
    rng, rows, family = random.Random(8), [], {}
    words = [f"w{i}" for i in range(3000)]

    def shingles(t):
        return {tuple(t[i : i + 5]) for i in range(len(t) - 4)}

    for base in range(6):
        text = [rng.choice(words) for _ in range(400)]
        for copy in range(25):
            own = list(text)
            for _ in range(0 if not copy else rng.choice((1, 3, 4, 40))):
                own[rng.randrange(len(own))] = rng.choice(words)
            family[len(rows)] = (base, own)
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.representatives(docs).collect()}
    for i, (base, own) in family.items():
        like = [(len(shingles(own) & shingles(o)) / len(shingles(own) | shingles(o)), j) for j, (b, o) in family.items() if b == base and j != i]
        if i in kept:
            assert not any(x >= 0.85 and j < i for x, j in like)
        else:
            assert max(like)[0] > 0.6
    assert {25 * b for b in range(6)} <= kept and 20 < len(kept) < 80
    given = simhash.sketches(docs).selectExpr("doc_id AS node", "fp", "keys").cache()
    groups = []
    for radius, cell in ((simhash.NEAR_RADIUS, 3), (300, 2)):
        groups.append(dict(map(tuple, simhash.components(simhash.near_links(given, radius, cell)).collect())))
    assert len(groups[0]) == len(rows) - len(kept)
    # At a radius that sets within a block exceed only in part, pivots leave some for the cells.
    prints = [(0, int.from_bytes(r["fp"], "little"), set(r["keys"]), r["node"]) for r in given.collect()]
    assert len(set(groups[1].values())) <= 6 and all(family[a][0] == family[b][0] for a, b in groups[1].items())
    root = {p[3]: p[3] for p in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in prints:
        for y in prints:
            if x[3] < y[3] and x[2] & y[2] and (x[1] ^ y[1]).bit_count() <= 300:
                a, b = sorted((find(x[3]), find(y[3])))
                root[b] = a
    expected = {i: find(i) for i in root if find(i) != i}
    assert groups[1] == expected


@pytest.mark.parametrize("radius", [0, 2, 40, 100, 127, 128])
def test_wide_lanes(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
    prints = np.array([base ^ np.packbits(rng.random(128) < rng.choice((0, 0.01, 0.2, 0.5, 1)), bitorder="little").view(np.uint64) for _ in range(100)])
    padded = np.zeros((128, 2), np.uint64)
    padded[:100] = prints
    used = np.zeros(128, np.uint8)
    used[:100] = 1
    lanes = np.packbits(used.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
    who, block = np.repeat(np.arange(100), 2), np.tile(np.arange(2), 100)
    found = simhash.wide_lanes(prints[who], block, simhash.planes_of(padded), lanes, radius)
    near = {(int(i), int(b) * 64 + k) for i, b, w in zip(who, block, found.tolist()) for k in range(64) if w >> k & 1}
    assert near == {(i, j) for i in range(100) for j in range(100) if np.bitwise_count(prints[i] ^ prints[j]).sum() <= radius}


def plain_signatures(text, anchors):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    content = [w for w in words if w not in anchors]
    out = {" ".join(["^", *content[:2]])} if words else set()
    for i, w in enumerate(words):
        if w in anchors:
            out.add(" ".join([w, *[x for x in words[i + 1 :] if x not in anchors][:2]]))
    return {hashlib.md5(s.encode()).hexdigest()[:8] for s in out}


def test_spot_signatures(docs, rows, empty):
    anchors = ["the", "of", "and", "to"]
    found = spotsigs.neighbours(docs, anchors).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[1] or "")
    ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True)
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is None or len(by[r["doc_id"]]) > 1 or r["doc_id"] == ids[-1]:
            continue  # what follows depends on a hash; counted above
        text, after = by[r["doc_id"]][0], by[ids[ids.index(r["doc_id"]) + 1]]
        if len(after) > 1:
            continue
        half = len(text) // 2
        edited = text[: len(text) - half] + after[0][:half]
        a, b, c = (plain_signatures(t, anchors) for t in (text, edited, after[0]))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == "".join(sorted(a)) and r["edited_fingerprint"] == "".join(sorted(b))
        assert r["near_edited"] == pytest.approx(like(a, b)) and r["near_next"] == pytest.approx(like(a, c))
    assert spotsigs.neighbours(empty).collect() == []


def test_next_document_over_buckets(spark):
    """Small buckets: each row but the guest has its successor beside it, the last one the first."""
    rng = random.Random(1)
    ids = rng.sample(range(-50_000, 2_000_000), 700) + list(range(300))
    frame = spark.createDataFrame([(i, f"text {i}") for i in set(ids)], "doc_id long, text string")
    dealt = spotsigs.with_next(frame, bucket_rows=3).collect()
    buckets = {}
    for r in dealt:
        buckets.setdefault(r["__bucket"], []).append((r["__guest"], -r["doc_id"]))
    assert len(buckets) > 50
    after = {}
    for b in buckets.values():
        b.sort()
        assert [g for g, _ in b].count(True) == 1
        after |= {-x[1]: -y[1] for x, y in zip(b, b[1:])}
    order = sorted(set(ids), reverse=True)
    assert after == dict(zip(order, order[1:] + order[:1]))


def test_next_document_over_buckets_with_null_ids(spark):
    """Divided ranges with null ids and the ends of BIGINT among the ids: null ids come last and are split by the hash of their texts."""
    rng = random.Random(2)
    ids = sorted({*rng.sample(range(-50_000, 2_000_000), 700), 1 - (1 << 63), (1 << 63) - 1}, reverse=True)
    texts = [(i, f"text {i}") for i in ids] + [(None, f"none {i}") for i in range(300)]
    frame = spark.createDataFrame(rng.sample(texts, len(texts)), "doc_id long, text string")
    buckets = {}
    for r in spotsigs.with_next(frame, bucket_rows=3).collect():
        buckets.setdefault(r["__bucket"], []).append((r["__guest"], -r["__key"], -r["__hash"], r["text"]))
    hashes = {r["text"]: r["h"] for r in frame.filter("doc_id IS NULL").selectExpr("text", "xxhash64(text) AS h").collect()}
    after = {}
    for b in buckets.values():
        b.sort()
        assert [x[0] for x in b].count(True) == 1
        after |= {x[3]: y[3] for x, y in zip(b, b[1:])}
    order = [f"text {i}" for i in ids] + sorted(hashes, key=lambda t: -hashes[t])
    assert after == dict(zip(order, order[1:] + order[:1]))
    assert len(buckets) > 100 and sum(all(x[3].startswith("none") for x in b if not x[0]) for b in buckets.values()) > 50


def test_similar_pairs(docs, rows, empty):
    anchors = ["the", "of", "and", "to"]
    members, pairs = spotsigs.similar_pairs(docs, 0.6, anchors)
    key = lambda s: hashlib.md5("".join(sorted(s)).encode()).hexdigest()
    classes = {}
    for r in rows:
        classes.setdefault(frozenset(plain_signatures(r[1], anchors)), []).append(r[0])
    name = {s: min((i for i in ids if i is not None), default=None) for s, ids in classes.items()}
    expected = {(name[a], name[b], key(a), key(b)) for a in name for b in name if a and b and key(a) < key(b) and len(a & b) / len(a | b) >= 0.6}
    assert {(r["a"], r["b"], r["a_key"], r["b_key"]) for r in pairs.collect()} == expected and expected
    assert sorted(map(str, ((r["doc_id"], r["class_id"], r["class_key"]) for r in members.collect()))) == sorted(str((i, name[s], key(s))) for s, ids in classes.items() for i in ids)
    assert [x.collect() for x in spotsigs.similar_pairs(empty)] == [[], []]


def test_similar_pairs_under_one_id(spark):
    """Different texts that share an id, or have none, keep their links."""
    base = [f"w{i}" for i in range(40)]
    texts = [" the ".join([*base[:38], *x]) for x in (["a", "b"], ["c", "b"], ["a", "d"])]
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, "the other text of the id")], "doc_id long, text string")
    found = [r for r in spotsigs.similar_pairs(docs, 0.7, ["the"])[1].collect()]
    assert sorted(str((r["a"], r["b"])) for r in found) in (["(None, 7)", "(None, 7)", "(None, None)"], ["(7, None)", "(7, None)", "(None, None)"], ["(7, None)", "(None, 7)", "(None, None)"])
