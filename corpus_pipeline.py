"""A corpus pipeline of five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import langid, mixing, packing, simhash, suffix
from quillgraph.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that the classifier rejects go.

    Rejected are null texts, texts without a letter, and those whose best
    language is hardly better than the next one. Dictionaries come from the
    stage's own input, from rows with a language; if there is none, all go. Rows
    alike share their fate; an empty table stays empty; extra columns stay.
    """
    return langid.identify(docs, langid.dictionaries(docs)).filter("NOT rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, a likeness of 0.8 or more as fingerprints tell it): that of the smallest doc_id.

    Null texts and those without words are copies of each other; documents with
    null ids stay only where their group has no other; of rows alike one stays.
    An empty table stays empty; extra columns stay.
    """
    return simhash.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes or more that documents with smaller ids have too; those left empty by that go.

    Null texts stay null; a null id is larger than any other; rows with one id
    remove nothing from each other; n_chars follows the text. An empty table
    stays empty; extra columns stay.
    """
    return suffix.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times.

    Null is a source of its own; documents without words are taken like the
    others of their source; rows alike in id and text fall alike. An empty table
    stays empty; extra columns stay.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of their pieces in sequences for training.

    A null text is its end token alone; only documents over a sequence are cut;
    documents taken more than once are packed each for itself. An empty table
    gives no pieces; extra columns are left out.
    """
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Compression, suffix arrays and tokenisation are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
