"""Catalogue records to entities, and reference documents to citations [RS-*].

Identity is by canonical key (``scheme|literal``, or a name made of keys), so
that reuse is a matter of ``dropDuplicates``; numbers are given at export only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import resolve as rs
from quillgraph.operators.algebra import first_by
from quillgraph.schema import ISBN_TYPES, ISSN_TYPES, WORK_TYPES

#: [RS-33, UD-03] What each field of a record contributes; other fields are ignored.
HANDLERS: dict[str, Callable[[], Column]] = {
    "title": lambda: tx.join_titles(F.col("title")),
    "subtitle": lambda: tx.join_titles(F.col("subtitle")),
    "pub_date": lambda: tx.pub_date(F.get(F.col("issued")["date-parts"], F.lit(0))),
    "url": lambda: F.lower(tx.encode_url(F.col("URL"))),
    "start": lambda: F.when(~tx.is_blank(tx.first_page(F.col("page"))), tx.first_page(F.col("page"))),
    "end": lambda: F.when(~tx.is_blank(tx.first_page(F.col("page"))), tx.last_page(F.col("page"))),
    "class": lambda: F.create_map(*[F.lit(x) for kv in WORK_TYPES.items() for x in kv])[F.col("type")],
    "container": lambda: tx.join_titles(F.col("container-title")),
}


def canonical(scheme: str, literal: Column) -> Column:
    return F.concat(F.lit(f"{scheme}|"), F.lower(literal))


def works(records: DataFrame) -> DataFrame:
    """[RS-28, RS-29, RS-32, RS-34] One row per work: key, and the fields of HANDLERS.

    The key is the DOI's, or else of the first ISBN or ISSN, if these are the
    work's own: those of a record with a container name the container, and would
    make one work of all its parts. A record without any is a work of its own by
    its content. Records with one key are one work, of the fullest record; ties
    by title.
    """
    own = HANDLERS["container"]().isNull()
    ids = F.coalesce(canonical("doi", F.nullif(F.trim("DOI"), F.lit(""))), F.when(own, canonical("isbn", F.get(tx.isbn_list(F.col("ISBN")), F.lit(0)))), F.when(own, canonical("issn", F.get(tx.issn_list(F.col("ISSN")), F.lit(0)))))
    content = F.struct("title", "container-title", "author", "page", "volume", "issue")
    rows = records.withColumn("key", F.coalesce(ids, F.concat(F.lit("text|"), F.md5(F.to_json(content)))))
    named = rows.select("key", *[f().alias(n) for n, f in HANDLERS.items()], "volume", "issue", "publisher", "member", "author", "type", "ISSN", "ISBN")
    filled = sum((F.col(n).isNotNull().cast("int") for n in HANDLERS), F.lit(0))
    return first_by(named.withColumn("__full", filled), ["key"], F.col("__full").desc(), F.col("title")).drop("__full")


def identifiers(found: DataFrame) -> DataFrame:
    """[RS-20, RS-21, RS-22] owner, scheme, literal: DOI and URL of a work; ISSNs and ISBNs of its container if it has one, else its own."""
    has_container = F.col("container").isNotNull()
    owner = F.when(has_container, F.concat(F.lit("container|"), F.lower("container"))).otherwise(F.col("key"))
    own = F.array(F.struct(F.col("key").alias("owner"), F.lit("doi").alias("scheme"), F.when(F.col("key").startswith("doi|"), F.substring("key", 5, 1 << 30)).alias("literal")), F.struct(F.col("key").alias("owner"), F.lit("url").alias("scheme"), F.col("url").alias("literal")))
    listed = lambda values, scheme, types: F.when(has_container | F.col("type").isin(*types), F.transform(values, lambda v: F.struct(owner.alias("owner"), F.lit(scheme).alias("scheme"), v.alias("literal"))))
    nothing = F.array().cast("array<struct<owner: string, scheme: string, literal: string>>")
    every = F.concat(own, *[F.coalesce(x, nothing) for x in (listed(tx.issn_list(F.col("ISSN")), "issn", ISSN_TYPES), listed(tx.isbn_list(F.col("ISBN")), "isbn", ISBN_TYPES))])
    return found.select(F.explode(every).alias("x")).select("x.*").filter("literal IS NOT NULL").distinct()


def contributors(found: DataFrame, matched: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """[RS-25, RS-26, RS-27] Agents (key, given, family, name) and roles (work, pos, role, agent).

    An author with an ORCID in ``matched`` (br, pos, orcid) is one agent in all
    works, others are agents of their work; publishers are one by member id, or
    else by name. Authors of an edited book are its editors.
    """
    authors = found.select("key", "type", F.posexplode("author").alias("pos", "a")).select("key", "type", "pos", F.trim("a.given").alias("given"), F.trim("a.family").alias("family"))
    if matched is None:
        authors = authors.withColumn("orcid", F.lit(None).cast("string"))
    else:
        authors = authors.join(matched.select(F.col("br").alias("key"), "pos", "orcid"), ["key", "pos"], "left")
    authors = authors.withColumn("agent", F.coalesce(canonical("orcid", F.col("orcid")), F.concat_ws("#", "key", "pos")))
    publishers = found.filter(~tx.is_blank(F.col("publisher"))).select("key", "publisher", F.coalesce(canonical("crossref", F.col("member")), F.concat(F.lit("name|"), F.lower(F.trim("publisher")))).alias("agent"))
    agents = first_by(authors, ["agent"], F.col("key"), F.col("pos")).select(F.col("agent").alias("key"), "given", "family", F.lit(None).cast("string").alias("name"))
    agents = agents.unionByName(publishers.groupBy(F.col("agent").alias("key")).agg(F.min("publisher").alias("name")).withColumns({"given": F.lit(None).cast("string"), "family": F.lit(None).cast("string")}))
    roles = authors.select(F.col("key").alias("work"), "pos", F.when(F.col("type") == "edited-book", "editor").otherwise("author").alias("role"), "agent")
    roles = roles.unionByName(publishers.select(F.col("key").alias("work"), F.lit(-1).alias("pos"), F.lit("publisher").alias("role"), "agent"))
    return agents, roles


def author_ids(refs: DataFrame, authors: DataFrame) -> DataFrame:
    """[SRC-10] ``refs`` (doi, families or null for all) with orcid, given and family of the known authors (id, authors) of that DOI."""
    known = authors.select(F.lower("id").alias("__id"), F.explode("authors").alias("a")).select("__id", "a.orcid", F.col("a.given_names").alias("given"), F.col("a.family_name").alias("family"))
    out = refs.join(known, F.lower("doi") == F.col("__id")).drop("__id")
    return out.filter(F.col("families").isNull() | F.array_contains(F.transform("families", lambda f: F.lower(f)), F.lower("family")))


def identifier_entities(pairs: DataFrame, ident: DataFrame) -> DataFrame:
    """[RS-05] ``pairs`` (owner, scheme, literal) with iri: the identifier entity that the owner has already, or null."""
    one = ident.groupBy("owner", "scheme", "literal").agg(F.min("iri").alias("iri"))
    return pairs.join(one, ["owner", "scheme", "literal"], "left")


def literals(owners: DataFrame, ident: DataFrame, scheme: str) -> DataFrame:
    """[RS-06] ``owners`` (owner) with literal: their first identifier of a scheme."""
    one = ident.filter(F.col("scheme") == scheme).groupBy("owner").agg(F.min_by("literal", "iri").alias("literal"))
    return owners.join(one, "owner", "left")


def resolve_documents(documents: DataFrame, catalogue: DataFrame, store: DataFrame, cites: DataFrame) -> dict[str, DataFrame]:
    """[RS-01, RS-02, RS-11, RS-14..19] Reference documents to citations, entries, identifiers and errors.

    ``documents`` (doc, doi, references), ``catalogue`` (doi, key, text words are not
    used here), ``store`` (scheme, literal, res), ``cites`` (citing DOI). Documents
    without a DOI are errors, those that cite already are left out. The result of
    a reference is what its own DOI has in store (stage 1), what a DOI in its
    text has (stage 2), or the catalogue's (stage 3); of references that match
    one work the best counts. Every reference cites something: without a match a
    new, unidentified work. Order is kept by position.
    """
    errors = documents.filter("doi IS NULL").select("doc", F.lit("no DOI").alias("error"))
    todo = documents.filter("doi IS NOT NULL").withColumn("doi", F.lower("doi")).join(cites.select(F.lower("citing").alias("doi")).distinct(), "doi", "left_anti")
    refs = todo.select("doc", F.col("doi").alias("citing"), F.posexplode("references").alias("pos", "r")).select("doc", "citing", "pos", "r.*")
    refs = refs.withColumns({"ref": F.concat_ws("#", "doc", "pos"), "own": tx.normalise_doi(F.col("doi")), "inner": F.lower(tx.extract_doi(F.col("bibentry")))})
    index = store.filter("scheme = 'doi'").select(F.lower("literal").alias("literal"), "res")
    by = lambda c: refs.select("ref", F.col(c).alias("literal")).join(index, "literal")
    known = refs.select("ref", F.coalesce("own", "inner").alias("literal")).join(catalogue.select(F.lower("doi").alias("literal"), F.col("key").alias("res")), "literal")
    found = rs.cascade(refs, [(1, by("own")), (2, by("inner")), (3, known)])
    itself = index.select(F.col("literal").alias("citing"), F.col("res").alias("self"))
    best = rs.keep_best(found.join(itself, "citing", "left").withColumn("citing_doi", F.col("citing")).withColumn("citing", F.coalesce("self", canonical("doi", F.col("citing")))), "res")
    # References alike in all but position are not rivals: they share what the one that counts matched.
    cited = F.when(F.col("considered"), F.col("res")).when(F.col("res").isNotNull() & ~F.col("res").eqNullSafe(F.col("citing")), F.col("res")).otherwise(F.concat(F.lit("new|"), F.col("ref")))
    best = best.withColumn("cited", cited)
    entries = best.filter(~tx.is_blank(F.col("bibentry"))).select("doc", "pos", F.col("citing_doi").alias("citing"), "cited", F.col("bibentry").alias("content"), "xmlid")
    ids = F.array(*[F.struct(F.lit(s).alias("scheme"), c.alias("literal")) for s, c in (("doi", F.coalesce("own", F.when(F.col("stage") == 2, F.col("inner")))), ("pmid", F.col("pmid")), ("pmcid", F.col("pmcid")), ("url", F.lower(tx.encode_url(F.col("url")))))])
    claims = best.filter("considered").select(F.col("cited").alias("res"), (F.col("pos") + 0).alias("ord"), "doc", F.explode(ids).alias("x")).select("res", "x.scheme", "x.literal", F.concat_ws("#", "doc", F.lpad(F.col("ord").cast("string"), 6, "0")).alias("ord")).filter("literal IS NOT NULL AND literal <> ''")
    return {"citations": best.select(F.col("citing_doi").alias("citing"), "cited", "pos", "stage", "considered"), "entries": entries, "identifiers": rs.first_writers(claims, store.select("res", "scheme", "literal")), "errors": errors}
