"""Language identification by compression.

A text is encoded with one zstandard raw-content dictionary per language, each
made of training text of that language; the language whose dictionary gives the
smallest result is chosen. Where the margin to the next one is narrow, the
choice is rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import table

#: The bounded training sample: of each language about so many documents, of each at most so many
#: characters; together they make a dictionary of at most so many bytes.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 512
DICTIONARY_BYTES = 32 << 10
#: zstandard's level: the lowest one with lazy matching deep enough to use the dictionary well.
LEVEL = 9
#: Put behind every text: zstandard stores a block as it is where little is gained, which tells nothing; with these it always encodes.
PADDING = b" " * 128
#: Weight of a byte of difference in the score.
STEEP = 0.25
#: A choice is rejected where the next language needs less than this share more than the bytes of the best one. A
#: dictionary stops gaining in long texts, which become their own; so the share is of so many bytes at most.
NARROW = 0.03
SATURATED = 1024
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str) -> bytes:
    """Lower-case letters, with one space for each run of anything else."""
    return NO_LETTERS.sub(" ", text.lower()).strip().encode()


def is_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def dictionaries(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """A raw-content dictionary per language, most frequent first, from training rows of ``docs`` (doc_id, text, lang) with a language.

    Rows are sampled by a hash of their id and text, at a rate from the
    language's count, and rows alike in both count once, so that about
    ``sample_docs`` times ``SAMPLE_CHARS`` characters per language are collected,
    whatever the size of ``docs`` and however often a row comes. Languages are
    taken to be few enough for one entry each on the driver. Rows without text
    or language teach nothing; an empty table gives no dictionary.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(is_training(F.col("doc_id")), F.lit(True)))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return {}
    rates = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, sample_docs / n))])
    h = F.xxhash64("doc_id", "text")
    at = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    # A passage from the middle, where headers and footers are rare.
    n = F.length("text")
    passage = F.when(n <= SAMPLE_CHARS, F.col("text")).otherwise(F.substr("text", F.floor((n - SAMPLE_CHARS) / 2).cast("int") + 1, F.lit(SAMPLE_CHARS)))
    rows = known.filter(at < rates[F.col("lang")]).select("lang", h.alias("h"), passage.alias("passage")).distinct()
    out: dict[str, list[tuple[int, str]]] = {}
    for r in rows.collect():
        out.setdefault(r["lang"], []).append((r["h"], r["passage"]))
    made = {lang: b" ".join(letters_of(p) for _, p in sorted(out.get(lang, [])))[:DICTIONARY_BYTES] for lang in sorted(counts, key=lambda x: (-counts[x], x))}
    return {lang: x for lang, x in made.items() if x}


class Classifier:
    """Encodes with each dictionary; built once per task from the bounded dictionaries."""

    def __init__(self, contents: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.langs = list(contents)
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        self.encoders = []
        for lang in self.langs:
            made = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=level)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=made, level=level, write_content_size=False, write_checksum=False))

    def __call__(self, text: str | None) -> tuple[str, float, float | None]:
        """Language, score, and margin: what the next language needs more, as a share of the bytes of the best, SATURATED at most (null if there is no choice).

        Where only one language was learned, the next one is the encoding without a dictionary.
        """
        data = letters_of(text) if text is not None and self.langs else b""
        if not data:
            return UNKNOWN, 0.0, None
        sizes = [len(x.compress(data + PADDING)) for x in self.encoders]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        least = sizes[order[0]]
        after = sizes[order[1]] if len(sizes) > 1 else len(self.plain.compress(data + PADDING))
        score = 1 / sum(math.exp(-STEEP * min(s - least, 2000)) for s in sizes)
        return self.langs[order[0]], score, (after - least) / min(least, SATURATED)


def identify(docs: DataFrame, contents: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected, from the text alone.

    ``und`` with score 0, no margin, and rejected, if the text is null or has no
    letter or nothing could be learned; else the language of the smallest
    encoding (ties: the first in ``contents``) with a score of 1 / sum over
    languages of exp(-STEEP * bytes above the least). rejected also where the
    margin, the bytes that the next language needs more as a share of the
    least (SATURATED at most), is under ``narrow``. Whole texts count, of any length. Repeated rows are rows of their
    own; an empty table gives no rows. Columns of docs keep their place; those
    named like the results are replaced.
    """
    new = ("lang_pred", "score", "margin", "rejected")
    kept = [c for c in docs.columns if c not in new]
    names = {c: f"__in{i}" for i, c in enumerate(kept)}
    shared = docs.sparkSession.sparkContext.broadcast(contents)  # DICTIONARY_BYTES per language at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(shared.value)
        at = list(names).index("text")
        for batch in batches:
            found = [classify(x.as_py()) for x in batch.column(at)]
            lang, rate, margin = (pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64())))
            yield pa.RecordBatch.from_arrays([*batch.columns, lang, rate, margin, pa.array([x[2] is None or x[2] < narrow for x in found], pa.bool_())], names=[*batch.schema.names, *new])

    inner = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    schema = T.StructType([*inner.schema.fields, *[T.StructField(n, k) for n, k in zip(new, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()))]])
    out = inner.mapInArrow(score, schema)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], *new)


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), dictionaries(docs))
    return found.select("doc_id", (~F.coalesce(is_training(F.col("doc_id")), F.lit(True))).alias("held_out"), "lang_pred", "score", "margin", "rejected")
