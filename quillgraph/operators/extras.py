"""Small operators of the inventory that stand by themselves."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import graph as gr

#: [UD-02] Heuristics by which arguments of a search are prepared.
HEURISTICS: dict[str, Callable[[Column], Column]] = {"lower_case": F.lower, "capitalize_first": tx.capitalised, "decodeURIStr": tx.url_decode, "encodeURIStr": tx.encode_url, "short_version": tx.truncated}


class Catalogue(Protocol):
    """[UD-04] A source of works and authors; implementations return DataFrames."""

    def by_doi(self, refs: DataFrame) -> DataFrame: ...

    def by_text(self, refs: DataFrame) -> DataFrame: ...

    def authors(self, refs: DataFrame) -> DataFrame: ...

    def close(self) -> None: ...


class Stage(Protocol):
    """[UD-05] A step of a pipeline."""

    def __call__(self, documents: DataFrame) -> DataFrame: ...


class LocalCatalogue:
    """[SRC-08, UD-04] Works (id, bibref) and authors (id, authors) as DataFrames."""

    def __init__(self, works: DataFrame, authors: DataFrame):
        self.works, self.known = works, authors

    def by_doi(self, refs: DataFrame) -> DataFrame:
        """The work of each DOI, if there is exactly one."""
        one = self.works.groupBy(F.lower("id").alias("doi")).agg(F.count("*").alias("k"), F.first("bibref").alias("bibref")).filter("k = 1").drop("k")
        return refs.withColumn("doi", F.lower("doi")).join(one, "doi", "left")

    def by_text(self, refs: DataFrame) -> DataFrame:
        from quillgraph.functions.matching import token_index, token_search

        return token_search(refs, *token_index(self.works))

    def authors(self, refs: DataFrame) -> DataFrame:
        from quillgraph.operators.records import author_ids

        return author_ids(refs, self.known)

    def close(self) -> None:
        pass


def path_get(value: Column, *path: str) -> Column:
    """[SC-08] A field by path; where an array comes in between, :func:`path_in` maps over it."""
    for name in path:
        value = value[name]
    return value


def path_in(values: Column, *path: str) -> Column:
    """[SC-08] The field of every element of an array, nulls kept."""
    return F.transform(values, lambda v: path_get(v, *path))


def without_nulls(m: Column) -> Column:
    """[SC-09] A map without entries of null value."""
    return F.map_filter(m, lambda k, v: v.isNotNull())


def picked(values: Column, places: Column) -> Column:
    """[SC-11] Elements by places from 0; null where there is none."""
    return F.transform(places, lambda i: F.get(values, i))


def supplier_key(config: dict[str, str], host: str) -> str:
    """[SC-27] The supplier prefix of a host, by configuration."""
    return config.get(host, config["default"])


def match(quads: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """[SRC-12] Quads by any of subject, predicate and object."""
    for name, value in (("s", s), ("p", p), ("o", o)):
        if value is not None:
            quads = quads.filter(F.col(name) == value)
    return quads


def grouped(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """[AG-03] Groups; without aggregates the distinct keys."""
    return df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()


def insert_data(quads: DataFrame, more: DataFrame) -> DataFrame:
    """[QA-19]"""
    return gr.as_set(quads, more.select(*quads.columns))


def delete_data(quads: DataFrame, less: DataFrame) -> DataFrame:
    """[QA-19]"""
    keys = ["g", "s", "p", "o", "o_kind"]
    return quads.join(less.select(*keys), [quads[k].eqNullSafe(less[k]) for k in keys], "left_anti")


def delete_where(quads: DataFrame, pattern: DataFrame, on: list[str]) -> DataFrame:
    """[QA-19, SNK-07] Without the quads that a pattern binds."""
    return quads.join(pattern.select(*on).distinct(), on, "left_anti")


def clear_default(quads: DataFrame) -> DataFrame:
    """[QA-19]"""
    return quads.filter("g IS NOT NULL")


def small_first(small: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """[QA-20] A broadcast hint, if the side proves to be small."""
    return F.broadcast(small) if small.limit(most_rows + 1).count() <= most_rows else small


def single_file(quads: DataFrame, path: str) -> None:
    """[SNK-02] All quads in one file."""
    quads.select(gr.ntriples(with_graph=True).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def with_errors(df: DataFrame, **conditions: Column) -> DataFrame:
    """[SNK-12] errors: the names of conditions that hold; a row without any is fine."""
    return df.withColumn("errors", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()])))


def imported(quads: DataFrame, more: DataFrame, mapping: DataFrame, done: DataFrame) -> DataFrame:
    """[SRC-13, G-17] ``quads`` with those of ``more`` whose subject is not ``done`` (s), entities mapped (old, new) to known ones."""
    fresh = more.join(done.select("s"), "s", "left_anti").select(*quads.columns)
    return gr.as_set(quads, gr.merge(fresh, mapping))


def list_before_bracket(pointers: DataFrame) -> DataFrame:
    """[PT-07] ``pointers`` (sentence_no, before, tail, sentence) with sentence_no of the text they belong to.

    A list in brackets that opens a sentence belongs to the one before it, if
    what follows the bracket starts a sentence or ends the paragraph.
    """
    opens = F.trim("before").rlike(r"[\[(]$") & F.col("sentence").rlike(r"^[\[(]")
    after = F.regexp_replace("tail", r"^[^\])]*[\])]", "")
    starts = F.trim(after).rlike("^[A-Z]") | (F.trim(after) == "")
    return pointers.withColumn("sentence_no", F.when(opens & starts & (F.col("sentence_no") > 0), F.col("sentence_no") - 1).otherwise(F.col("sentence_no")))


def evaluated_xpaths(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """[RO-15] ``rows`` (doc, path) with text: what each path of its own selects in the article's XML; null if nothing."""
    from quillgraph.operators.jats import ElementTree, parse

    def selected(root, path):
        try:
            steps = path.strip("/").split("/", 1)
            at = root if len(steps) == 1 else root.find("./" + steps[1])
            return None if at is None else " ".join("".join(at.itertext()).split())
        except (SyntaxError, AttributeError):
            return None

    def run(batches):
        for batch in batches:
            found = []
            for doc, paths, xml in zip(*(batch.column(c).to_pylist() for c in ("doc", "paths", "xml"))):
                try:
                    root = parse(xml)
                except (ElementTree.ParseError, TypeError):
                    root = None
                found += [(doc, p, None if root is None else selected(root, p)) for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.string()) for i in range(3)], names=["doc", "path", "text"])

    # The paths of an article together, so that it is joined and parsed once.
    paths = rows.groupBy("doc").agg(F.collect_list("path").alias("paths"))
    return paths.join(articles.select("doc", "xml"), "doc").select("doc", "paths", "xml").mapInArrow(run, "doc string, path string, text string")


def timed(queries: dict[str, Callable[[], DataFrame]]) -> list[tuple[str, float, int]]:
    """[EV-06] Name, seconds and rows of each query."""
    out = []
    for name, f in queries.items():
        began = time.time()
        rows = f().count()
        out.append((name, time.time() - began, rows))
    return out


def grading_sheet(pointers: DataFrame) -> DataFrame:
    """[EV-08, PT-05] Pointers for grading by hand."""
    return pointers.select("doc", F.coalesce("label", F.lit("in sequence")).alias("pointer"), F.coalesce("list_id", F.lit("not in list")).alias("list"), "sentence")
