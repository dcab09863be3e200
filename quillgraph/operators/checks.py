"""Consistency checks: each returns the violations, none if all is well [CC-*]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.schema import LOCAL_SCHEMES


def shared_identifiers(ident: DataFrame) -> DataFrame:
    """[CC-01, CC-04..13] Identifiers of any but local schemes with more than one owner."""
    rows = ident.filter(~F.col("scheme").isin(*LOCAL_SCHEMES))
    return rows.groupBy("scheme", "literal").agg(F.countDistinct("owner").alias("owners")).filter("owners > 1")


def repeated_identifier_entities(ident: DataFrame) -> DataFrame:
    """[CC-23..31] Scheme and literal of more than one identifier entity."""
    return ident.groupBy("scheme", "literal").agg(F.countDistinct("iri").alias("entities")).filter("entities > 1")


def repeated_numbers(parts: DataFrame) -> DataFrame:
    """[CC-02, CC-03] Numbers that more than one part of a whole has."""
    rows = parts.filter("part_of IS NOT NULL AND seq_id IS NOT NULL")
    return rows.groupBy(F.col("part_of").alias("whole"), F.col("seq_id").alias("number")).agg(F.count("*").alias("n")).filter("n > 1")


def not_part_of(parts: DataFrame, wholes: DataFrame | None = None) -> DataFrame:
    """[CC-14, CC-15, CC-19..21] Parts without a whole, or without one among ``wholes``."""
    if wholes is None:
        return parts.filter("part_of IS NULL").select("iri", "type")
    return parts.join(wholes.select(F.col("iri").alias("part_of")), "part_of", "left_anti").select("iri", "type")


def without_parts(wholes: DataFrame, parts: DataFrame) -> DataFrame:
    """[CC-16..18]"""
    return wholes.join(parts.select(F.col("part_of").alias("iri")), "iri", "left_anti").select("iri", "type")


def uncited(works: DataFrame, cites: DataFrame) -> DataFrame:
    """[CC-22]"""
    return works.join(cites.select(F.col("cited").alias("iri")), "iri", "left_anti").select("iri", "type")


def without_identifier(works: DataFrame, ident: DataFrame) -> DataFrame:
    """[CC-32, CC-33]"""
    return works.join(ident.select(F.col("owner").alias("iri")), "iri", "left_anti").select("iri", "type")


def summary(c) -> DataFrame:
    """check_id and n for the checks over a corpus of entity tables."""
    chapters, books = c.br.filter("type = 'BookChapter'"), c.br.filter("type = 'Book'")
    found = {
        "CC-01": shared_identifiers(c.ident.filter("scheme = 'issn'")),
        "CC-02": repeated_numbers(c.volume),
        "CC-03": repeated_numbers(c.issue),
        "CC-13": shared_identifiers(c.ident),
        "CC-14": not_part_of(chapters, books),
        "CC-15": not_part_of(c.volume, c.journal),
        "CC-16": without_parts(c.volume, c.br),
        "CC-17": without_parts(c.issue, c.br),
        "CC-18": without_parts(c.journal, c.br),
        "CC-19": not_part_of(c.volume),
        "CC-20": not_part_of(c.issue),
        "CC-21": not_part_of(chapters),
        "CC-22": uncited(books, c.cites),
        "CC-23": repeated_identifier_entities(c.ident),
        "CC-32": without_identifier(c.journal, c.ident),
        "CC-33": without_identifier(books, c.ident),
    }
    out = None
    for name, rows in found.items():
        one = rows.agg(F.count("*").cast("int").alias("n")).select(F.lit(name).alias("check_id"), "n")
        out = one if out is None else out.unionByName(one)
    return out
