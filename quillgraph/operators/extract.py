"""Extraction operators: reference texts and reference documents from JSON, TSV and XML [EX-*, SRC-*]."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.schema import REFERENCE


#: How each part of a citation text is joined to what is before it: field, rule, text in front, text behind.
PARTS = (
    ("title", "dot", "", ""),
    ("editors", "dot", "", " (Eds.)"),
    ("journalAbbreviation", "venue", "", ""),
    ("publicationTitle", "venue", "", ""),
    ("seriesName", "venue", "", ""),
    ("volume", ",", "", ""),
    ("issue", "issue", "", ""),
    ("pageInfo", ":", "", ""),
    ("edition", ".", "", ""),
    ("doi", "dot", "https://doi.org/", ""),
)


def citation_text(entry: dict[str, Column]) -> tuple[Column, Column]:
    """[EX-03, EX-04] Citation text and process_entry of a structured reference.

    Parts are added in a fixed order, in one pass over an array of them; what
    stands between two depends on how the text so far ends. Without an author (or
    with an unknown one) the unstructured text counts, without markup;
    process_entry is false where year or title is missing.
    """
    col = lambda n: entry.get(n, F.lit(None).cast("string"))
    year = entry["pubYear"].cast("int") if "pubYear" in entry else F.lit(None).cast("int")
    author, loose = col("authorString"), col("unstructuredInformation")
    known = author.isNotNull() & (F.lower(author) != "author unknown")
    start = F.concat(author, F.when(year > 0, F.concat(F.lit(" ("), year.cast("string"), F.lit(")"))).otherwise(""))
    parts = F.array(*[F.struct(F.trim(col(n)).alias("v"), F.lit(rule).alias("rule"), F.lit(before).alias("before"), F.lit(after).alias("after")) for n, rule, before, after in PARTS])

    def add(text, part):
        last, rule = F.substring(text, -1, 1), part["rule"]
        stopped, digit = last.isin(".", "?", "!"), last.rlike("[0-9]")
        mark = (
            F.when(rule == "issue", "")
            .when(rule == "dot", F.when(last == ".", "").otherwise("."))
            .when((rule == "venue") & text.endswith("(Eds.)"), ",")
            .when(stopped, "")
            .when(rule == "venue", ".")
            .otherwise(rule)
        )
        value = F.when((rule == "issue") & digit, F.concat(F.lit("("), part["v"], F.lit(")"))).otherwise(part["v"])
        return F.when(tx.is_blank(part["v"]), text).otherwise(F.concat(text, mark, F.lit(" "), part["before"], value, part["after"]))

    text = F.when(known, F.aggregate(parts, start, add)).when(~tx.is_blank(loose), tx.strip_html(F.trim(loose)))
    return text, F.when(known, F.coalesce(year > 0, F.lit(False)) & ~tx.is_blank(col("title"))).when(~tx.is_blank(loose), F.lit(True))


def reference_ids(own: dict[str, Column], looked_up: dict[str, Column], matched: Column) -> dict[str, Column]:
    """[EX-05] doi, pmid and pmcid: of the paper looked up where there is a match, else the reference's own; DOIs normalised, PMCIDs with their prefix."""
    pmcid = F.when(own["pmcid"].rlike("(?i)^PMC"), F.upper(own["pmcid"])).otherwise(F.concat(F.lit("PMC"), own["pmcid"]))
    clean = {"doi": tx.normalise_doi(own["doi"]), "pmid": own["pmid"], "pmcid": pmcid}
    return {n: F.when(matched, F.coalesce(looked_up[n], clean[n])).otherwise(clean[n]) for n in ("doi", "pmid", "pmcid")}


def reference_url(c: Column) -> Column:
    """[EX-06]"""
    return F.when(F.trim(c).startswith("http"), F.trim(c))


def local_id(pmid: Column, pmcid: Column, doi: Column) -> Column:
    """[EX-12] PMID with a prefix, else PMCID, else DOI with a prefix; null if there is none."""
    there = pmid.isNotNull() & (pmid != 0)
    return F.when(there, F.concat(F.lit("PMID"), pmid.cast("bigint").cast("string"))).when(pmcid.isNotNull() & ~pmcid.isin("", "0"), pmcid).when(~tx.is_blank(doi), F.concat(F.lit("DOI"), doi))


def store_key(doi: Column, pmid: Column, pmcid: Column, local: Column) -> Column:
    """[EX-09, Q-06] The first identifier there is."""
    return F.coalesce(doi, pmid, pmcid, local)


def read_extracted(rows: DataFrame) -> DataFrame:
    """[SRC-05, EX-13] Reference documents from an extraction table.

    Columns: cur_doi, cur_pmid, cur_pmcid, cur_name, references (JSON). Missing ids
    count as 0; articles without any are left out; empty texts become nulls, and
    a reference has process_entry only with a text.
    """
    ref = "array<struct<entry_text: string, ref_doi: string, ref_pmid: string, ref_pmcid: string, ref_url: string, ref_xmlid: string>>"
    pmid = F.expr("try_cast(cur_pmid AS double)")
    out = rows.withColumn("localid", local_id(F.coalesce(pmid, F.lit(0.0)), F.col("cur_pmcid"), F.col("cur_doi"))).filter("localid IS NOT NULL")

    def one(r):
        clean = lambda n: F.nullif(F.trim(r[n]), F.lit(""))
        text = clean("entry_text")
        fields = (text, F.when(text.isNotNull(), F.lit("True")), F.lit(None), clean("ref_doi"), clean("ref_pmid"), clean("ref_pmcid"), clean("ref_url"), clean("ref_xmlid"))
        return F.struct(*[f.cast("string").alias(s.name) for f, s in zip(fields, REFERENCE.fields)])

    return out.select(
        F.nullif("cur_doi", F.lit("")).alias("doi"),
        F.when(pmid > 0, pmid.cast("bigint").cast("string")).alias("pmid"),
        F.nullif("cur_pmcid", F.lit("")).alias("pmcid"),
        "localid",
        F.col("cur_name").alias("name"),
        F.transform(F.from_json("references", ref), one).alias("references"),
    )


def references_of(documents: DataFrame, keys: list[str]) -> DataFrame:
    """[SRC-03] One row per reference of reference documents, with its position."""
    rows = documents.select(*keys, F.posexplode("references").alias("pos", "r"))
    return rows.select(*keys, "pos", "r.*")


def from_pages(pages: DataFrame) -> tuple[DataFrame, str | None]:
    """[SRC-01, SRC-02, ST-01] Articles of search pages (page, value: JSON text) and the cursor to go on from: that of the last page, null if it is empty.

    Cursors are opaque; only the number of a page tells which one is the last.
    """
    schema = "resultList struct<result: array<struct<id: string, source: string, doi: string, pmid: string, pmcid: string>>>, nextCursorMark string"
    rows = pages.select(F.from_json("value", schema).alias("p"), *[c for c in pages.columns if c != "value"])
    articles = rows.select(F.explode("p.resultList.result").alias("a")).select("a.*").withColumn("localid", F.concat_ws("-", "source", "id"))
    last = rows.agg(F.max_by(F.struct("p.nextCursorMark", F.size("p.resultList.result").alias("n")), "page").alias("x")).select("x.*").first()
    return articles, last["nextCursorMark"] if last["n"] is not None and last["n"] > 0 else None


def paged(fetch: Callable[[str], str | None], start: str | None = None) -> Iterator[tuple[int, str]]:
    """[SRC-01, ST-01] Number and JSON of the pages from a cursor on (from ``*`` if there is none), up to an empty one.

    ``fetch`` gives the page of a cursor, null if that fails; then the search
    starts once more from ``*``, and a second failure ends it.
    """
    cursor, again, number = start or "*", start is not None, 0
    while True:
        page = fetch(cursor)
        if page is None:
            if not again:
                return
            cursor, again = "*", False
            continue
        found = json.loads(page)
        if not found.get("resultList", {}).get("result"):
            return
        yield number, page
        number += 1
        if (cursor := found.get("nextCursorMark")) is None:
            return


def reference_lists(pages: DataFrame, papers: DataFrame) -> DataFrame:
    """[SRC-03, SRC-07, EX-03..06] References of articles from reference-list JSON (article, value), ids from ``papers`` (source, id, doi, pmid, pmcid) on a match."""
    text = "id string, source string, match string, doi string, pmid string, pmcid string, externalLink string, authorString string, title string, pubYear int, editors string, journalAbbreviation string, publicationTitle string, seriesName string, volume string, issue string, pageInfo string, edition string, unstructuredInformation string"
    rows = pages.select("article", F.posexplode(F.from_json("value", f"referenceList struct<reference: array<struct<{text.replace(' ', ': ').replace(',:', ',')}>>>").getField("referenceList").getField("reference")).alias("pos", "r")).select("article", "pos", "r.*")
    known = papers.groupBy(F.col("source").alias("ps"), F.col("id").alias("pi")).agg(*[F.min(c).alias(f"paper_{c}") for c in ("doi", "pmid", "pmcid")])
    rows = rows.join(known, (F.col("source") == F.col("ps")) & (F.col("id") == F.col("pi")), "left")
    ids = reference_ids({n: F.col(n) for n in ("doi", "pmid", "pmcid")}, {n: F.col(f"paper_{n}") for n in ("doi", "pmid", "pmcid")}, F.coalesce(F.col("match") == "Y", F.lit(False)))
    entry, flag = citation_text({c: F.col(c) for c in rows.columns})
    return rows.select("article", "pos", entry.alias("bibentry"), flag.alias("process_entry"), *[c.alias(n) for n, c in ids.items()], reference_url(F.col("externalLink")).alias("url"))
