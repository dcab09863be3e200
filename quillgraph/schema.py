"""Classes, predicates and identifier schemes of the citation graph, and the nested input schemas."""

from __future__ import annotations

from pyspark.sql import types as T

BASE = "https://quill.example/graph/"

# Vocabulary terms.
FABIO = "http://purl.org/spar/fabio/"
NAMESPACES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "dcterms": "http://purl.org/dc/terms/",
    "fabio": FABIO,
    "datacite": "http://purl.org/spar/datacite/",
    "literal": "https://quill.example/vocabulary/",
    "frbr": "http://purl.org/vocab/frbr/core#",
    "prism": "http://prismstandard.org/namespaces/basic/2.0/",
    "cito": "http://purl.org/spar/cito/",
    "pro": "http://purl.org/spar/pro/",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "prov": "http://www.w3.org/ns/prov#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "biro": "http://purl.org/spar/biro/",
    "c4o": "http://purl.org/spar/c4o/",
    "co": "http://purl.org/co/",
    "deo": "http://purl.org/spar/deo/",
    "doco": "http://purl.org/spar/doco/",
    "oa": "http://www.w3.org/ns/oa#",
    "void": "http://rdfs.org/ns/void#",
}
PREDICATES = {
    "type": "rdf:type", "title": "dcterms:title", "subtitle": "fabio:hasSubtitle", "date": "prism:publicationDate", "number": "fabio:hasSequenceIdentifier",
    "part_of": "frbr:partOf", "cites": "cito:cites", "has_id": "datacite:hasIdentifier", "scheme": "datacite:usesIdentifierScheme", "literal": "literal:hasLiteralValue",
    "embodiment": "frbr:embodiment", "first_page": "prism:startingPage", "last_page": "prism:endingPage", "role_of": "pro:isDocumentContextFor", "with_role": "pro:withRole",
    "held_by": "pro:isHeldBy", "given": "foaf:givenName", "family": "foaf:familyName", "name": "foaf:name", "content": "c4o:hasContent", "denotes": "c4o:denotes",
    "element": "co:element", "context_of": "c4o:isContextOf", "references": "biro:references", "citing": "cito:hasCitingEntity", "cited": "cito:hasCitedEntity",
}
CLASSES = {
    "br": "fabio:Expression", "id": "datacite:Identifier", "ra": "foaf:Agent", "ar": "pro:RoleInTime", "re": "fabio:Manifestation", "be": "biro:BibliographicReference",
    "rp": "c4o:InTextReferencePointer", "pl": "c4o:SingleLocationPointerList", "de": "deo:DiscourseElement", "ci": "cito:Citation", "an": "oa:Annotation", "se": "prov:Entity",
}
SCHEMES = ("doi", "occ", "pmid", "pmcid", "orcid", "isbn", "issn", "url", "xpath", "intrepid", "oci", "xmlid", "viaf", "crossref", "wikidata")
#: Schemes that name a place in a document and may come twice.
LOCAL_SCHEMES = ("xpath", "xmlid")
WORK_TYPES = {
    "book": "Book", "edited-book": "Book", "monograph": "Book", "book-chapter": "BookChapter", "book-part": "Part", "book-section": "ExpressionCollection", "book-series": "BookSeries",
    "book-set": "BookSet", "book-track": "Expression", "component": "Expression", "other": "Expression", "dataset": "DataFile", "dissertation": "Thesis", "journal": "Journal",
    "journal-article": "JournalArticle", "journal-issue": "JournalIssue", "journal-volume": "JournalVolume", "proceedings": "AcademicProceedings", "proceedings-article": "ProceedingsPaper",
    "reference-book": "ReferenceBook", "reference-entry": "ReferenceEntry", "report": "ReportDocument", "report-series": "Series", "standard-series": "Series", "standard": "SpecificationDocument",
}
# The container of each work type that has one, and the types whose own identifiers are ISSNs and ISBNs.
CONTAINERS = {
    "journal-article": "journal-issue", "journal-issue": "journal-volume", "journal-volume": "journal", "book-chapter": "book", "book-part": "book", "book-section": "book", "book-track": "book",
    "book": "book-series", "book-set": "book-series", "component": "other", "proceedings-article": "proceedings", "reference-entry": "reference-book", "report": "report-series", "standard": "standard-series",
}
ISSN_TYPES = ("journal", "book-series", "report-series", "standard-series", "book-set")
ISBN_TYPES = ("book", "edited-book", "monograph", "proceedings", "reference-book", "book-set")
DISCOURSE = {"caption": "Caption", "p": "Paragraph", "table": "Table", "table-wrap": "TableBox", "fn": "Footnote", "notes": "Footnote", "title": "SectionTitle", "sec": "Section"}


def expand(term: str) -> str:
    """``prefix:name`` as an IRI."""
    prefix, _, name = term.partition(":")
    return NAMESPACES[prefix] + name


REFERENCE = T.StructType([T.StructField(n, T.StringType()) for n in ("bibentry", "process_entry", "localid", "doi", "pmid", "pmcid", "url", "xmlid")])
POINTER = T.StructType([T.StructField(n, T.StringType()) for n in ("rp_string", "pl_string", "rp_xpath", "pl_xpath", "context_xpath", "xmlid")])
DOCUMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("doi", "pmid", "pmcid", "localid", "occ", "url", "curator", "source_provider", "source")]
    + [T.StructField("references", T.ArrayType(REFERENCE)), T.StructField("reference_pointers", T.ArrayType(T.ArrayType(POINTER)))]
)
WORK = (
    "DOI string, type string, title array<string>, subtitle array<string>, author array<struct<given: string, family: string>>, publisher string, member string, "
    "issued struct<`date-parts`: array<array<int>>>, page string, volume string, issue string, `container-title` array<string>, ISSN array<string>, ISBN array<string>, URL string, score double"
)
QUADS = "g string, s string, p string, o string, o_kind string, o_dt string"
