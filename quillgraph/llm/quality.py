"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a sparse random index vector; a word's vector is the sum of the
index vectors around it in the training sample. A document is the mean of its
words' vectors, over all words and over distinct ones. The network is trained
in numpy and its probabilities are calibrated with a temperature on rows held
back from training.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import table, written

#: The bounded training sample: about so many labelled documents of each class.
SAMPLE_PER_CLASS = 4000
#: Words with a vector of their own; all others share one per shape.
VOCABULARY = 4000
DIMENSIONS = 128
ONES = 8
WINDOW = 2
HIDDEN = 32
EPOCHS = 150
PATIENCE = 15
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+|[^\w\s]+")


def is_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def shape(token: str) -> str:
    """What a word looks like: the name that all words without a vector of their own go by."""
    if token.isdigit():
        return "<0>"
    if token.isupper() and len(token) > 1:
        return "<A>"
    if token[:1].isupper():
        return "<Aa>"
    if token.isalpha():
        return "<a>"
    return "<.>" if not any(map(str.isalnum, token)) else "<a0>"


#: A word that repeats the one before it.
AGAIN = "<=>"
SHAPES = ["<0>", "<A>", "<Aa>", "<a>", "<.>", "<a0>", AGAIN]


def index_vectors(words: list[str], dimensions: int = DIMENSIONS, ones: int = ONES) -> np.ndarray:
    """Sparse ternary vectors from a hash of the word."""
    out = np.zeros((len(words), dimensions), np.int64)
    for i, word in enumerate(words):
        rng = np.random.default_rng(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7))
        out[i, rng.choice(dimensions, ones, replace=False)] = rng.choice((-1, 1), ones)
    return out


def row_numbers(text: str | None, rows: dict[str, int]) -> np.ndarray:
    """The rows of a text's words in order, by the word or else by its shape, or as a repetition of the word before."""
    out, before, again = [], None, rows[AGAIN]
    for token in TOKEN.findall(text or ""):
        if token == before:
            out.append(again)
            continue
        at = rows.get(token)
        out.append(rows[shape(token)] if at is None else at)
        before = token
    return np.array(out, np.int64)


def pooled(text: str | None, rows: dict[str, int], vectors: np.ndarray) -> np.ndarray:
    """Mean vector over all words, and sum over distinct ones by the number of all; zeros if there are none."""
    ids = row_numbers(text, rows)
    if not len(ids):
        return np.zeros(2 * vectors.shape[1], np.float32)
    counts = np.bincount(ids, minlength=len(vectors))
    distinct = np.flatnonzero(counts)
    own = vectors[distinct]
    return np.concatenate((counts[distinct] @ own / len(ids), own.sum(axis=0) / len(ids) ** 0.5 / 8)).astype(np.float32)


class Network:
    """Two layers with a ReLU between them; trained by Adam on log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS):
        rng = np.random.default_rng(0)
        held = np.arange(len(x)) % 5 == 4
        self.mean, self.scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        self.weights = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        xt, yt, step, self.temperature = z[~held], y[~held], 0, 1.0
        best, worse = None, 0
        for _ in range(epochs):
            order = rng.permutation(len(xt))
            for at in range(0, len(order), 256):
                xb, yb = xt[order[at : at + 256]], yt[order[at : at + 256]]
                inner = np.maximum(0, xb @ self.weights[0] + self.weights[1])
                error = (self._sigmoid(inner @ self.weights[2] + self.weights[3][0]) - yb) / len(xb)
                back = np.outer(error, self.weights[2]) * (inner > 0)
                step += 1
                for w, (m, v), g in zip(self.weights, moments, (xb.T @ back + 1e-4 * self.weights[0], back.sum(axis=0), inner.T @ error + 1e-4 * self.weights[2], np.array([error.sum()]))):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.002 * (m / (1 - 0.9**step)) / ((v / (1 - 0.999**step)) ** 0.5 + 1e-8)
            if held.any():  # ends once the rows held back have not gained for PATIENCE epochs
                loss = np.logaddexp(0, np.where(y[held] == 1, -1, 1) * self._logits(z[held])).mean()
                if best is None or loss < best[0] - 1e-4:
                    best, worse = (loss, [w.copy() for w in self.weights]), 0
                else:
                    worse += 1
                if worse == PATIENCE:
                    break
        if best:
            self.weights = best[1]
        if held.any():  # the temperature of least log loss on the rows held back
            logits, truth = self._logits(z[held]), y[held]
            loss = lambda t: np.logaddexp(0, np.where(truth == 1, -1, 1) * logits / t).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss))

    @staticmethod
    def _sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    def _logits(self, z):
        return np.maximum(0, z @ self.weights[0] + self.weights[1]) @ self.weights[2] + self.weights[3][0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self._logits((x - self.mean) / self.scale) / self.temperature)


class Constant:
    """The share of label 1, where there is nothing to tell classes apart by."""

    def __init__(self, rate: float):
        self.rate = rate

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.rate)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, vocabulary: int = VOCABULARY):
    """(rows, vectors, model) from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality of 0 or 1).

    The labelled rows are sampled by a hash of the id at a rate from the class's
    count, so about ``per_class`` of each class come in, whatever the size; rows
    without id or label are left out, repeated ones count once, and ids with both
    labels teach nothing. What reaches the driver is bounded: the
    vocabulary, its vectors and the sample's pooled vectors.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("__id").isNotNull() & is_training(F.col("__id")))
    known = known.groupBy("__id").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        rate = 1.0 if 1 in counts else 0.0 if 0 in counts else 0.5
        return {s: i for i, s in enumerate(SHAPES)}, np.zeros((len(SHAPES), 1), np.float32), Constant(rate)
    at = F.pmod(F.xxhash64(F.col("__id")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(at < F.when(F.col("y") == 0, per_class / counts[0]).otherwise(per_class / counts[1]))
    # About 2 * per_class rows of 12 bytes: small enough to broadcast at any size of the tables.
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y"), "quality-sample")

    def count(batches):
        found = Counter()
        for batch in batches:
            for x in batch.column("text"):
                found.update(TOKEN.findall(x.as_py() or ""))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["token", "n"])

    top = sample.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "token").limit(vocabulary)
    words = [*SHAPES, *[r["token"] for r in top.collect() if r["token"] not in SHAPES]]
    rows = {w: i for i, w in enumerate(words)}

    def surroundings(batches):
        own, total, held = index_vectors(words), np.zeros((len(words), DIMENSIONS), np.int64), {d: [] for d in range(1, WINDOW + 1)}

        def add(keys, n, vectors):
            """Adds to the words in ``keys`` (sorted) the vectors beside them, n times each."""
            for i in range(0, len(keys), 1 << 14):
                k, part = keys[i : i + (1 << 14)], vectors[i : i + (1 << 14)] * n[i : i + (1 << 14), None]
                first = np.flatnonzero(np.diff(k, prepend=-1))
                total[k[first]] += np.add.reduceat(part, first, axis=0)

        def flush():
            for d, codes in held.items():
                if codes:
                    pairs, n = np.unique(np.concatenate(codes), return_counts=True)
                    a, b = pairs // len(words), pairs % len(words)
                    # The index vectors d words on are rotated by d, those d words back by -d, as order matters.
                    add(a, n, np.roll(own, d, axis=1)[b])
                    order = np.argsort(b, kind="stable")
                    add(b[order], n[order], np.roll(own, -d, axis=1)[a[order]])
                    codes.clear()

        size = 0
        for batch in batches:
            for x in batch.column("text"):
                ids = row_numbers(x.as_py(), rows)
                for d, codes in held.items():
                    codes.append(ids[:-d] * len(words) + ids[d:])
                size += len(ids)
                if size > 1 << 18:
                    flush()
                    size = 0
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["sums"])

    sums = sum((np.frombuffer(r["sums"], "<i8").reshape(len(words), DIMENSIONS) for r in sample.coalesce(8).mapInArrow(surroundings, "sums binary").collect()), np.zeros((len(words), DIMENSIONS), np.int64))
    vectors = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1e-9)
    # What stands around a word is joined by what it is, or words in like places would be alike.
    vectors = (vectors + index_vectors(words) / ONES**0.5).astype(np.float32)

    def pool(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([pooled(x.as_py(), rows, vectors).tobytes() for x in batch.column("text")], pa.binary())], names=["doc_id", "y", "x"])

    found = sorted(sample.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text").mapInArrow(pool, "doc_id long, y int, x binary").collect(), key=lambda r: (r["doc_id"], r["y"], r["x"]))
    if len({r["y"] for r in found}) < 2:
        return rows, vectors, Constant(counts.get(1, 0) / sum(counts.values()))
    x, y = np.array([np.frombuffer(r["x"], np.float32) for r in found], float), np.array([r["y"] for r in found])
    # Mixed up by id before every fifth row is held back; the classes keep their natural odds by a shift of the last bias.
    order = np.argsort([xxhash.xxh64_intdigest(str(r["doc_id"])) for r in found], kind="stable")
    model = Network(x[order], y[order])
    shift = np.log(counts[1] / counts[0]) - np.log(max(1, (y == 1).sum()) / max(1, (y == 0).sum()))
    model.weights[3] = model.weights[3] + model.temperature * shift
    return rows, vectors, model


def score(docs: DataFrame, learned) -> DataFrame:
    """doc_id, score, predicted of every row of ``docs`` (doc_id, text), from the whole text alone.

    score: the calibrated probability of label 1, from 0 to 1; null and empty
    texts have the score of the zero vector. predicted: 1 if score >= THRESHOLD.
    Rows with the same doc_id are rows of their own; other columns are ignored.
    """
    rows, vectors, model = learned  # VOCABULARY * DIMENSIONS numbers and the network, which go with the function

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([pooled(t.as_py(), rows, vectors) for t in batch.column("text")], float).reshape(batch.num_rows, -1)
            p = model(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype("i4"))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rate, "doc_id long, score double, predicted int")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (~F.coalesce(is_training(F.col("doc_id")), F.lit(True))).alias("held_out"), "score", "predicted")
