"""Catalogue records, resolution of documents and small operators on hand-made inputs."""

import os

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators import extras as xt
from quillgraph.operators import records as rc
from quillgraph.schema import DOCUMENT, WORK
from quillgraph.sources import files

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def record(**fields):
    names = ("DOI", "type", "title", "subtitle", "author", "publisher", "member", "issued", "page", "volume", "issue", "container-title", "ISSN", "ISBN", "URL", "score")
    return tuple(fields.get(n.replace("-", "_")) for n in names)


@pytest.fixture(scope="module")
def works(spark):
    data = [
        record(DOI="10.1/A", type="journal-article", title=[" One ", ""], subtitle=["s"], author=[("Ann", "Lee"), ("Bo", "Ray")], publisher="Pub", member="7", issued=([[2018, 1, 1]],), page="5–9", container_title=["J"], ISSN=["1234–5678", "0000-0000"]),
        record(DOI="10.1/a", type="journal-article", title=["One"]),
        record(DOI=None, type="edited-book", title=["Two"], author=[("Ann", "Lee")], publisher="pub", ISBN=["http://x.example/isbn/978-1"], issued=([[2018, 12]],)),
        record(type="dataset", title=["  "], page=" "),
        record(type="unheard-of", title=["Three"]),
    ]
    return rc.works(spark.createDataFrame(data, WORK))


def test_works(works):
    found = {r["title"]: r for r in works.collect()}
    assert len(found) == 4
    one = found["One"]
    assert (one["key"], one["pub_date"], one["class"], one["start"], one["end"], one["container"]) == ("doi|10.1/a", "2018", "JournalArticle", "5", "9", "J")
    assert found["Two"]["key"] == "isbn|978-1" and found["Two"]["pub_date"] == "2018-12" and found["Two"]["class"] == "Book"
    assert found[None]["start"] is None and found["Three"]["class"] is None


def test_parts_of_one_container_stay_apart(spark):
    """Two articles of a journal and two chapters of a book, none with a DOI, are four works; two records of one book are one."""
    data = [
        record(type="journal-article", title=["One"], container_title=["J"], ISSN=["1234-5678"], page="1-2"),
        record(type="journal-article", title=["Two"], container_title=["J"], ISSN=["1234-5678"], page="3-4"),
        record(type="book-chapter", title=["Three"], container_title=["B"], ISBN=["978-1"]),
        record(type="book-chapter", title=["Four"], container_title=["B"], ISBN=["978-1"]),
        record(type="book", title=["B"], ISBN=["978-1"]),
        record(type="book", title=["B"], subtitle=["fuller"], ISBN=["978-1"]),
        record(type="journal", title=["J"], ISSN=["1234-5678"], container_title=["  "]),
    ]
    found = rc.works(spark.createDataFrame(data, WORK))
    assert sorted(r["title"] for r in found.collect()) == ["B", "Four", "J", "One", "Three", "Two"]
    assert {r["key"]: r["subtitle"] for r in found.collect() if r["title"] in "BJ"} == {"isbn|978-1": "fuller", "issn|1234-5678": None}
    assert rows(rc.identifiers(found)) == [("container|b", "isbn", "978-1"), ("container|j", "issn", "1234-5678"), ("isbn|978-1", "isbn", "978-1"), ("issn|1234-5678", "issn", "1234-5678")]


def test_identifiers_and_contributors(spark, works):
    assert rows(rc.identifiers(works)) == [("container|j", "issn", "1234-5678"), ("doi|10.1/a", "doi", "10.1/a"), ("isbn|978-1", "isbn", "978-1")]
    matched = spark.createDataFrame([("doi|10.1/a", 0, "0-1"), ("isbn|978-1", 0, "0-1")], "br string, pos int, orcid string")
    agents, roles = rc.contributors(works, matched)
    assert rows(agents.select("key", "family", "name")) == [("crossref|7", None, "Pub"), ("doi|10.1/a#1", "Ray", None), ("name|pub", None, "pub"), ("orcid|0-1", "Lee", None)]
    assert ("isbn|978-1", 0, "editor", "orcid|0-1") in rows(roles) and ("doi|10.1/a", -1, "publisher", "crossref|7") in rows(roles)


def test_resolution(spark):
    ref = lambda **f: tuple(f.get(n) for n in ("bibentry", "process_entry", "localid", "doi", "pmid", "pmcid", "url", "xmlid"))
    refs = [ref(doi="10.2/K", pmid="5", xmlid="r1"), ref(bibentry="See 10.2/k.", xmlid="r2"), ref(bibentry="Self", doi="10.1/Doc"), ref(bibentry="Nothing"), ref(doi="10.3/cat", url="http://A b"), ref(bibentry="Nothing")]
    make = lambda doc, doi, references: (doi, None, None, doc, None, None, None, None, None, references, None)
    docs = spark.createDataFrame([make("d1", "10.1/DOC", refs), make("d2", None, refs), make("d3", "10.1/done", refs)], DOCUMENT).withColumn("doc", F.col("localid"))
    store = spark.createDataFrame([("doi", "10.2/k", "known"), ("doi", "10.1/doc", "itself")], "scheme string, literal string, res string")
    catalogue = spark.createDataFrame([("10.3/CAT", "doi|10.3/cat")], "doi string, key string")
    out = rc.resolve_documents(docs, catalogue, store, spark.createDataFrame([("10.1/DONE",)], "citing string"))
    cited = {r["pos"]: (r["cited"], r["stage"], r["considered"]) for r in out["citations"].collect()}
    assert cited == {0: ("known", 1, True), 1: ("known", 2, False), 2: ("new|d1#2", 1, False), 3: ("new|d1#3", None, False), 4: ("doi|10.3/cat", 3, True), 5: ("new|d1#5", None, False)}
    assert rows(out["errors"]) == [("d2", "no DOI")] and out["entries"].count() == 4
    assert rows(out["identifiers"].select("res", "scheme", "literal")) == [("doi|10.3/cat", "doi", "10.3/cat"), ("doi|10.3/cat", "url", "http://a%20b"), ("known", "pmid", "5")]


def test_small_operators(spark, tmp_path):
    one = spark.createDataFrame([({"a": 1, "b": None}, [{"x": {"y": 1}}, {"x": None}], ["p", "q"], [1, 5])], "m map<string, int>, l array<struct<x: struct<y: int>>>, v array<string>, i array<int>")
    found = one.select(xt.without_nulls(F.col("m")), xt.path_in(F.col("l"), "x", "y"), xt.picked(F.col("v"), F.col("i"))).first()
    assert tuple(found) == ({"a": 1}, [1, None], ["q", None])
    assert xt.supplier_key({"10.0.0.1": "0110", "default": "0120"}, "10.0.0.2") == "0120"
    pointers = spark.createDataFrame([(1, " [", "] Next one", "[1] Next one"), (1, " [", "] goes on", "[1] goes on"), (2, "a", "] B", "Text")], "sentence_no int, before string, tail string, sentence string")
    assert [r["sentence_no"] for r in xt.list_before_bracket(pointers).collect()] == [0, 1, 2]
    quads = spark.createDataFrame([("http://g/br/", "http://g/br/1", "p", "x", "lit", None), (None, "http://g/br/2", "p", "y", "lit", None)], "g string, s string, p string, o string, o_kind string, o_dt string")
    assert xt.match(quads, o="x").count() == 1 and xt.clear_default(quads).count() == 1 and xt.insert_data(quads, quads).count() == 2
    assert xt.delete_data(quads, quads.filter("g IS NULL")).count() == 1 and xt.delete_where(quads, quads.filter("o = 'x'"), ["s"]).count() == 1
    none = spark.createDataFrame([], "old string, new string")
    assert xt.imported(quads.filter("o = 'x'"), quads, none, spark.createDataFrame([], "s string")).count() == 2
    xt.single_file(quads, f"{tmp_path}/one")
    assert len([f for f in os.listdir(tmp_path / "one") if f.startswith("part")]) == 1 and files.read_statements(spark, f"{tmp_path}/one").count() == 2
    assert [(n, k) for n, _, k in xt.timed({"q": lambda: quads})] == [("q", 2)]
    assert set(xt.HEURISTICS) and rows(quads.select(xt.HEURISTICS["capitalize_first"](F.col("o")))) == [("X",), ("Y",)] and tx is not None


def test_local_catalogue(spark):
    works = spark.createDataFrame([("10.1/A", "Deep matters of text"), ("10.1/b", "Other"), ("10.1/B", "Other twice")], "id string, bibref string")
    authors = spark.createDataFrame([("10.1/a", [("0-1", "Ann", "Lee"), ("0-2", "Bo", "Ray")])], "id string, authors array<struct<orcid: string, given_names: string, family_name: string>>")
    local = xt.LocalCatalogue(works, authors)
    refs = spark.createDataFrame([("10.1/a",), ("10.1/b",), ("10.9/z",)], "doi string")
    assert [r["bibref"] for r in local.by_doi(refs).orderBy("doi").collect()] == ["Deep matters of text", None, None]
    assert [(r["query_id"], r["id"]) for r in local.by_text(spark.createDataFrame([(1, "deep TEXT")], "query_id int, text string")).collect()] == [(1, "10.1/A")]
    asked = refs.withColumn("families", F.array(F.lit("LEE")))
    assert [r["orcid"] for r in local.authors(asked).collect()] == ["0-1"]
    local.close()


def test_xpaths_and_grading(spark):
    from quillgraph.operators import jats

    articles = files.read_articles(spark, f"{FIXTURES}/articles")
    paths = spark.createDataFrame([("element.xml", "/article/body[1]/sec[1]/title[1]"), ("element.xml", "/article/none"), ("broken.xml", "/article")], "doc string, path string")
    assert {(r["doc"], r["text"]) for r in xt.evaluated_xpaths(paths, articles).collect()} == {("element.xml", "Background"), ("element.xml", None), ("broken.xml", None)}
    sheet = xt.grading_sheet(jats.pointer_lists(jats.extract_pointers(articles))).collect()
    assert len(sheet) == 6 and sheet[0]["list"] == "not in list"
