"""The search application: rules that bind resources, categories that describe them [SR-*, CQ-*].

A search is a category applied to what a rule binds: ``category(corpus,
rule(corpus, argument))``. Rules return one column, ``iri``; categories join
from it, so that only what a rule bound is described.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.functions.matching import all_terms
from quillgraph.plans.corpus import type_iri
from quillgraph.schema import BASE
from quillgraph.sources.workspace import dealt, small

# --- rules ---------------------------------------------------------------------------------------

_IRI = rf"^{re.escape(BASE)}[a-z]{{2}}/\d+$"
_DOI = r"^10\.\d{4,9}/\S+$"
RULES: dict[str, tuple[str, object]] = {}


def rule(gate: str):
    """Registers a rule with the pattern its argument must match."""

    def put(f):
        RULES[f.__name__] = (gate, f)
        return f

    return put


def run_rule(c, name: str, argument: str) -> DataFrame:
    gate, f = RULES[name]
    if not re.search(gate, argument):
        raise ValueError(f"{argument!r} is no argument of the rule {name}")
    return f(c, argument)


def _owners(c, scheme: str, literal: str) -> DataFrame:
    return c.ident.filter((F.col("scheme") == scheme) & (F.col("literal") == literal)).select(F.col("owner").alias("iri"))


def _parts(c, kind: str, parent: str) -> DataFrame:
    return getattr(c, kind).filter(F.col("part_of") == parent).select("iri")


@rule(_DOI)
def doi(c, value):
    """[SR-01]"""
    return _owners(c, "doi", value.lower())


@rule(_IRI)
def issues_list(c, value):
    """[SR-02]"""
    return _parts(c, "issue", value)


@rule(_IRI)
def volumes_list(c, value):
    """[SR-03]"""
    return _parts(c, "volume", value)


@rule(_IRI)
def articles_in_issue_list(c, value):
    """[SR-04]"""
    return _parts(c, "article", value)


@rule(_IRI)
def intext_refs_list(c, value):
    """[SR-05] Pointers under a discourse element, at any depth."""
    p = c.pointer
    return p.filter((p["sentence"] == value) | (p["paragraph"] == value) | (p["section"] == value)).select("iri")


@rule(r"^\S+ \S+$")
def intext_refs_for_citation(c, value):
    """[SR-06] Pointers of the citation of one work by another, ``citing cited``."""
    citing, cited = value.split(" ")
    return c.pointer.filter((F.col("article") == citing) & (F.col("book") == cited)).select("iri")


@rule(_IRI)
def intext_refs_list_in_pl(c, value):
    """[SR-07]"""
    return c.pointer.filter(F.col("list") == value).select("iri")


@rule(_IRI)
def intext_refs_list_for_be(c, value):
    """[SR-08]"""
    return c.pointer.filter(F.col("entry") == value).select("iri")


@rule(_IRI)
def cocited_list(c, value):
    """[SR-09] Other pointers in the same sentence."""
    p = c.pointer
    here = p.filter(F.col("iri") == value).select("sentence")
    return p.join(here, "sentence", "left_semi").filter(F.col("iri") != value).select("iri")


@rule(r"^br/\d+$")
def br_resource(c, value):
    """[SR-10]"""
    return c.br.filter(F.col("iri") == BASE + value).select("iri")


@rule(_IRI)
def doc_cites_list(c, value):
    """[SR-11]"""
    return c.cites.filter(F.col("citing") == value).select(F.col("cited").alias("iri"))


@rule(_IRI)
def doc_cites_me_list(c, value):
    """[SR-12]"""
    return c.cites.filter(F.col("cited") == value).select(F.col("citing").alias("iri"))


@rule(_IRI)
def doc_cites_me_intext(c, value):
    """[SR-13] Citing works, with the cited one beside them."""
    return c.cites.filter(F.col("cited") == value).select(F.col("citing").alias("iri"), "cited")


@rule(r"^\d[\d-]*$")
def orcid(c, value):
    """[SR-14]"""
    return _owners(c, "orcid", value)


@rule(r"\S")
def author_lname(c, value):
    """[SR-15]"""
    return c.agent.filter(F.col("family") == value[:1].upper() + value[1:]).select("iri")


@rule(r"\S")
def author_fname(c, value):
    """[SR-15]"""
    return c.agent.filter(F.col("given") == value[:1].upper() + value[1:]).select("iri")


@rule(_IRI)
def author_works(c, value):
    """[SR-16]"""
    return c.role.filter(F.col("ra") == value).select(F.col("br").alias("iri")).distinct()


@rule(_IRI)
def publisher_journals(c, value):
    """[SR-17] Journals that hold works in which an agent has a role."""
    works = author_works(c, value)
    return works.join(journal_of(c), works["iri"] == F.col("work")).select(F.col("journal_iri").alias("iri")).distinct()


@rule(r"^ra/\d+$")
def ra_resource(c, value):
    """[SR-18]"""
    return c.agent.filter(F.col("iri") == BASE + value).select("iri")


@rule(r"\S")
def author_text(c, value):
    """[SR-19] Agents whose family name has all the words."""
    return all_terms(c.agent.select("iri", "family"), "family", value).select("iri")


@rule(r"\S")
def any_text(c, value):
    """[SR-20] Works whose title or subtitle has all the words."""
    found = all_terms(c.br.select("iri", "title"), "title", value).select("iri")
    return found.unionByName(all_terms(c.br.select("iri", "subtitle"), "subtitle", value).select("iri")).distinct()


# --- categories ----------------------------------------------------------------------------------


def journal_of(c) -> DataFrame:
    """work, journal_iri, volume of every article, issue and volume; part-of is a forest of known depth."""
    v = c.volume.select(F.col("iri").alias("v"), F.col("seq_id").alias("volume"), F.col("part_of").alias("journal_iri"))
    i = c.issue.select(F.col("iri").alias("i"), F.col("part_of").alias("v")).join(v, "v")
    a = c.article.select(F.col("iri").alias("work"), F.col("part_of").alias("i")).join(i, "i")
    return a.select("work", "journal_iri", "volume").unionByName(i.select(F.col("i").alias("work"), "journal_iri", "volume")).unionByName(v.select(F.col("v").alias("work"), "journal_iri", "volume"))


def _described(entities: DataFrame, bound: DataFrame) -> DataFrame:
    """The entities that are bound; rows of the entities themselves are taken as they are, without a join."""
    # Not a semi-join, which would be pushed below unions and sort what is bound once for each branch.
    return bound if set(entities.columns) <= set(bound.columns) else entities.join(bound.select("iri").distinct(), "iri")


def _whole(bound: DataFrame) -> bool:
    """Whether whole entities are bound, and not only their names."""
    return "iri" not in bound.columns or len(bound.columns) > 2


def _of(rows: DataFrame, key: str, bound: DataFrame) -> DataFrame:
    """The rows about what is bound, so that only these are aggregated; all of them where whole entities are bound."""
    return rows if _whole(bound) else rows.join(bound.select(F.col("iri").alias(key)).distinct(), key)


def _literal(c, scheme: str, name: str) -> DataFrame:
    return c.ident.filter(F.col("scheme") == scheme).select(F.col("owner").alias("iri"), F.col("literal").alias(name))


def _short(kind: str = "br"):
    iri = F.col("iri")
    return [F.replace(iri, F.lit(BASE), F.lit("")).alias("short_iri"), F.replace(iri, F.lit(f"{BASE}{kind}/"), F.lit("")).alias("short_iri_id")]


def journal(c, bound: DataFrame) -> DataFrame:
    """[CQ-1]"""
    rows = _described(c.br, bound).join(_literal(c, "issn", "issn"), "iri", "left")
    return rows.select("iri", *_short(), "title", "subtitle", "issn", tx.readable_type(type_iri(F.col("type"))).alias("short_type"))


def volume(c, bound: DataFrame, word: str = "Volume") -> DataFrame:
    """[CQ-2]"""
    rows = _described(c.br, bound)
    held = _of(c.br.filter("pub_date IS NOT NULL").select(F.col("part_of").alias("iri"), F.substring("pub_date", 1, 4).alias("year")), "iri", bound).distinct()
    rows = rows.join(held, "iri", "left").join(journal_of(c).select(F.col("work").alias("iri"), "journal_iri", F.col("volume").alias("volume_number")), "iri", "left")
    names = c.journal.select(F.col("iri").alias("journal_iri"), F.col("title").alias("journal"))
    issn = _literal(c, "issn", "issn").withColumnRenamed("iri", "journal_iri")
    title = F.coalesce("title", F.concat(F.lit(f"{word} n. "), F.col("seq_id")), F.lit("No title available"))
    return rows.join(names, "journal_iri", "left").join(issn, "journal_iri", "left").select("iri", *_short(), title.alias("title"), "subtitle", "year", "journal", "issn", "volume_number")


def issue(c, bound: DataFrame) -> DataFrame:
    """[CQ-3] As a volume, with the number of its volume."""
    return volume(c, bound, "Issue")


def authors_in_order(c, bound: DataFrame | None = None) -> DataFrame:
    """br, author, author_iri, chain of all works or of those that are bound: one row per role; chain counts the roles from it to the end, so the first author has most."""
    last = Window.partitionBy("br")
    roles = c.role.filter("role = 'author'")
    roles = roles if bound is None else _of(roles, "br", bound)
    roles = dealt(roles, "br", c.size if bound is None or _whole(bound) else 0).withColumn("chain", F.max("pos").over(last) - F.col("pos") + 1)
    names = c.agent.select(F.col("iri").alias("ra"), F.concat_ws(" ", "given", "family").alias("author"))
    # The roles stay dealt by work, as the window left them, where the agents are few.
    return roles.join(small(names), "ra").select("br", "author", F.col("ra").alias("author_iri"), "chain")


def document(c, bound: DataFrame) -> DataFrame:
    """[CQ-5] One row per work and author, without an author one row; tot orders the authors."""
    rows = dealt(_described(c.br, bound), "iri", c.size if _whole(bound) else 0).join(_literal(c, "doi", "doi"), "iri", "left")
    cited = _of(c.cites, "cited", bound).groupBy(F.col("cited").alias("iri")).agg(F.countDistinct("citing").alias("in_cits"))
    where = journal_of(c).select(F.col("work").alias("iri"), "journal_iri", "volume")
    names = c.journal.select(F.col("iri").alias("journal_iri"), F.col("title").alias("journal"))
    pages = c.embodiment.select(F.col("br").alias("iri"), "start", "end")
    author = authors_in_order(c, bound).groupBy(F.col("br").alias("iri"), "author", "author_iri").agg(F.sum("chain").alias("tot"))
    rows = rows.join(cited, "iri", "left").join(where, "iri", "left").join(names, "journal_iri", "left").join(pages, "iri", "left").join(author, "iri", "left")
    data = F.when(F.col("start").isNotNull() & F.col("volume").isNotNull(), F.concat(F.lit(", "), F.col("volume"), F.lit(": "), F.col("start"), F.lit("-"), F.col("end")))
    return rows.select(
        "iri", *_short(), F.coalesce("title", F.lit("No title available")).alias("title"), "subtitle", F.substring("pub_date", 1, 4).alias("year"), "doi", "journal", data.alias("journal_data"),
        F.coalesce("in_cits", F.lit(0)).alias("in_cits"), tx.readable_type(type_iri(F.col("type"))).alias("short_type"), "author", "author_iri", F.coalesce("tot", F.lit(0)).alias("tot"),
    )


def document_intext(c, bound: DataFrame | None = None) -> DataFrame:
    """[CQ-4] Citing works (iri, cited), all of them or those that are bound, with the number of their pointers to the cited one, and the pointers."""
    p = c.pointer.select(F.col("article").alias("iri"), F.col("book").alias("cited"), F.col("iri").alias("pointer"), F.lit(False).alias("is_bound"))
    # A citation of nothing known has no pointers, even if some name no work.
    p = (p if bound is None else _of(p, "iri", bound)).filter("iri IS NOT NULL AND cited IS NOT NULL")
    pairs = (c.cites.select(F.col("citing").alias("iri"), "cited") if bound is None else bound.select("iri", "cited")).filter("iri IS NOT NULL").withColumns({"pointer": F.lit(None).cast("string"), "is_bound": F.lit(True)})
    # Citations and pointers are dealt by work once, and sorted once: the join with the works needs neither again.
    pair = Window.partitionBy("iri", "cited").orderBy(F.col("is_bound").desc())
    rows = dealt(pairs.unionByName(p).repartition("iri"), "iri", c.size if bound is None else 0)
    rows = rows.withColumns({"found": F.collect_list("pointer").over(pair.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "at": F.row_number().over(pair)}).filter("at = 1 AND is_bound")
    found = F.array_sort(F.array_distinct("found"))
    rows = rows.select("iri", "cited", F.size(found).cast("long").alias("mentions"), F.array_join(found, ";").alias("pointers"))
    return document(c, c.br if bound is None else bound).join(rows, "iri").select("iri", "title", "doi", "year", "journal", "author", "tot", "cited", "mentions", "pointers")


def author(c, bound: DataFrame, distinct: bool = False) -> DataFrame:
    """[CQ-6, Q-25] Both counts are over works times citations as written; ``distinct`` counts works and citations once."""
    rows = _described(c.agent, bound).join(_literal(c, "orcid", "orcid"), "iri", "left")
    works = _of(c.role.select("ra", F.col("br").alias("doc")), "ra", bound).select(F.col("ra").alias("iri"), "doc")
    # Citations are counted by work before the works meet their authors, who then add up numbers.
    cited = c.cites.groupBy(F.col("cited").alias("doc")).agg((F.countDistinct("citing") if distinct else F.count("citing")).alias("n"), F.count("*").alias("rows"))
    works, n = works.distinct() if distinct else works, F.coalesce("n", F.lit(0))
    joined = works.filter("doc IS NOT NULL").join(cited, "doc", "left")
    counts = joined.groupBy("iri").agg((F.count("*") if distinct else F.sum(F.greatest(n, F.lit(1)))).alias("num_docs"), F.sum(n).alias("citations"))
    return rows.join(counts, "iri", "left").select("iri", *_short("ra"), "orcid", F.concat_ws(" ", "given", "family").alias("author"), F.coalesce("num_docs", F.lit(0)).alias("num_docs"), F.coalesce("citations", F.lit(0)).alias("citations"))


def intext_ref(c, bound: DataFrame) -> DataFrame:
    """[CQ-7, PT-12, PT-13] InTRePID (citation, ordinal and total), text of the pointer or of its list, entry and target."""
    pair = Window.partitionBy("article", "book")
    number = lambda col: tx.resource_number(F.col(col)).cast("string")
    wanted = _described(c.pointer, bound)
    # Ordinals count all pointers of the citations that are bound.
    p = wanted if wanted is bound else c.pointer.join(wanted.select("article", "book").distinct(), ["article", "book"], "left_semi")
    p = p.withColumns({"ordinal": F.row_number().over(pair.orderBy("pos")), "total": F.count("*").over(pair)})
    rows = p if wanted is bound else p.join(bound.select("iri").distinct(), "iri", "left_semi")
    intrepid = F.concat(number("article"), F.lit("-"), number("book"), F.lit("/"), F.col("ordinal").cast("string"), F.lit("-"), F.col("total").cast("string"))
    title = F.coalesce(F.when(F.col("list").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))), F.col("list"), F.lit("no text"))
    return rows.select("iri", *_short("rp"), intrepid.alias("intrepid"), title.alias("title"), "entry", F.col("book").alias("br_iri"))


CATEGORIES = {f.__name__: f for f in (journal, volume, issue, document_intext, document, author, intext_ref)}


def search(c, rule_name: str, argument: str, category: str) -> DataFrame:
    """[QA-21] A category over what a rule binds."""
    return CATEGORIES[category](c, run_rule(c, rule_name, argument))


def combined(c, *rules: tuple[str, str], connector: str = "and") -> DataFrame:
    """Advanced search: resources bound by all, by any, or by the first and no other of the rules."""
    out = None
    for name, argument in rules:
        one = run_rule(c, name, argument).select("iri").distinct()
        out = one if out is None else {"and": out.intersect, "or": out.union, "not": out.subtract}[connector](one)
    return out.distinct()


def cocitation(c, level: str, pointer: str | None = None, section_title: str | None = None) -> DataFrame:
    """[RO-16] Pointers (iri, cocited) that stand in the same list, sentence, paragraph or section, with the section's title."""
    p = c.pointer.filter(F.col(level).isNotNull())
    a, b = p.alias("a"), p.alias("b")
    if pointer is not None:
        a = p.filter(F.col("iri") == pointer).alias("a")
    rows = a.join(b, (F.col(f"a.{level}") == F.col(f"b.{level}")) & (F.col("a.iri") != F.col("b.iri"))).select(F.col("a.iri").alias("iri"), F.col("b.iri").alias("cocited"), F.col("a.section").alias("section"))
    titles = c.discourse.filter("class = 'Section'").select(F.col("iri").alias("section"), F.col("title").alias("section_title"))
    rows = rows.join(titles, "section", "left").select("iri", "cocited", "section_title")
    return rows if section_title is None else rows.filter(F.col("section_title") == section_title)
