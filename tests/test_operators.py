"""Algebra, resolution, graphs, checks, evaluation, XML, files and streaming on small inputs."""

import os
import random
import urllib.error

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import algebra as al
from quillgraph.operators import checks, evaluate, extract, graph, jats
from quillgraph.operators import resolve as rs
from quillgraph.plans import rest
from quillgraph.sources import files
from quillgraph.streaming import queue

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_closure_with_cycles(spark):
    rng = random.Random(2)
    edges = {(rng.randrange(12), rng.randrange(12)) for _ in range(15)} | {(1, 2), (2, 1), (5, 5)}
    paths, grown = set(edges), True
    while grown:
        new = {(a, d) for a, b in paths for c, d in edges if b == c} - paths
        paths, grown = paths | new, bool(new)
    frame = spark.createDataFrame(sorted(edges), "src int, dst int")
    assert set(map(tuple, al.one_or_more(frame).collect())) == paths
    nodes = spark.createDataFrame([(99,)], "node int")
    every = {99} | {x for e in edges for x in e}
    assert set(map(tuple, al.zero_or_more(frame, nodes).collect())) == paths | {(x, x) for x in every}
    with pytest.raises(RuntimeError):
        al.one_or_more(spark.createDataFrame([(i, i + 1) for i in range(5)], "src int, dst int"), max_depth=2)


def test_keep_best_against_a_loop(spark):
    rng = random.Random(8)
    data = [(d, "c0", p, rng.randint(0, 3), rng.choice([None, "c0", "a", "b"])) for d in range(6) for p in range(8)]
    expected = []
    for doc in range(6):
        best = {}
        for _, _, p, stage, match in (r for r in data if r[0] == doc):
            if match not in (None, "c0") and (match not in best or (stage, p) < best[match]):
                best[match] = (stage, p)
        expected += [(doc, p) for _, p in best.values()]
    frame = spark.createDataFrame(data, "doc int, citing string, pos int, stage int, match string")
    assert rows(rs.keep_best(frame).filter("considered").select("doc", "pos")) == sorted(expected)


def test_first_writers(spark):
    claims = spark.createDataFrame([("r1", "doi", "a", 1), ("r2", "doi", "a", 2), ("r1", "doi", "b", 3), ("r3", "issn", "x", 4), ("r3", "issn", "y", 5), ("r4", "doi", "old", 6), ("r9", "doi", "z", 7)], "res string, scheme string, literal string, ord int")
    have = spark.createDataFrame([("r8", "doi", "old"), ("r9", "doi", "w")], "res string, scheme string, literal string")
    assert rows(rs.first_writers(claims, have).select("res", "literal")) == [("r1", "a"), ("r3", "x"), ("r3", "y")]


def test_lookup_modes(spark):
    refs = spark.createDataFrame([("doi", "a"), ("doi", "b")], "scheme string, literal string")
    batch, store = (spark.createDataFrame(x, "scheme string, literal string, res string") for x in ([("doi", "a", "r1")], [("doi", "a", "r2"), ("doi", "b", "r3")]))
    assert [rows(rs.lookup(refs, batch, store, m).select("res")) for m in ("both", "only_local", "only_store")] == [[("r1",), ("r3",)], [("r1",), (None,)], [("r2",), ("r3",)]]


def test_containers(spark):
    works = spark.createDataFrame([("w1", "j", "1", "2"), ("w2", "j", None, "2"), ("w3", "j", "1", None), ("w4", "j", None, None), ("w5", None, "1", "2")], "work string, journal string, volume string, issue string")
    journal, volume, issue, part = rs.containers(works)
    assert rows(journal) == [("j",)] and rows(volume) == [("j|1", "j", "1")] and rows(issue.select("key", "parent")) == [("j|1|2", "j|1"), ("j||2", "j")]
    assert rows(part) == sorted([("w1", "j|1|2"), ("w2", "j||2"), ("w3", "j|1"), ("w4", "j"), ("j|1|2", "j|1"), ("j||2", "j"), ("j|1", "j")])


def quads(spark, *triples):
    return spark.createDataFrame([("http://g/br/", s, "p", o, "iri" if o.startswith("http") else "lit", None) for s, o in triples], "g string, s string, p string, o string, o_kind string, o_dt string")


def test_merge_cascades(spark):
    b = "http://x/"
    data = quads(spark, (b + "br/1", b + "ar/1"), (b + "ar/1", b + "id/1"), (b + "id/1", "lit"), (b + "br/1", b + "br/5"), (b + "br/5", "stays"), (b + "br/2", b + "id/2"), (b + "br/1", b + "id/2"), (b + "id/2", "shared"), (b + "br/3", b + "br/1"), (b + "br/3", b + "br/3"))
    mapping = spark.createDataFrame([(b + "br/1", b + "br/9")], "old string, new string")
    assert rows(graph.merge(data, mapping).select("s", "o")) == sorted([(b + "br/5", "stays"), (b + "br/2", b + "id/2"), (b + "id/2", "shared"), (b + "br/3", b + "br/9"), (b + "br/3", b + "br/3")])


def test_merge_of_repeated_statements(spark):
    b = "http://g/"
    row = lambda s, o, kind="iri", dt=None: ("http://g/br/", b + s, "p", o, kind, dt)
    data = spark.createDataFrame([row("br/3", b + "br/1"), row("br/3", b + "br/2"), row("br/3", b + "br/2"), row("br/3", "1", "lit"), row("br/3", "1", "lit", "int"), row("br/1", b + "id/1"), row("br/1", b + "id/1")], "g string, s string, p string, o string, o_kind string, o_dt string")
    found = graph.merge(data, spark.createDataFrame([(b + "br/1", b + "br/2")], "old string, new string"))
    assert sorted((r["o"], r["o_dt"]) for r in found.withColumn("o_dt", F.coalesce("o_dt", F.lit(""))).collect()) == [("1", ""), ("1", "int"), (b + "br/2", "")]


def test_diff_and_apply_round_trip(spark):
    old, new = quads(spark, ("a", "1"), ("a", "2"), ("b", "3")), quads(spark, ("a", "1"), ("b", "4"), ("c", "5"))
    added, removed = graph.diff(new, old)
    keys = ["g", "s", "p", "o", "o_kind"]
    again = old.join(removed.select(*keys), keys, "left_anti").select(*keys).unionByName(added.select(*keys))
    assert rows(again) == rows(new.select(*keys))
    assert graph.diff(new, new)[0].isEmpty()
    text = graph.update_text(added, "DELETE").filter("s = 'c'").first()["update"]
    assert text == 'DELETE DATA { GRAPH <http://g/br/> { <c> <p> "5" . } }'


def test_blank_literals_vanish(spark):
    frame = spark.createDataFrame([("http://g/br/1", " ", None), ("http://g/br/2", "t", "")], "iri string, a string, b string")
    assert rows(graph.triples(frame, "iri", {"a": ("title", "lit"), "b": ("subtitle", "lit")}).select("s", "o")) == [("http://g/br/2", "t")]


def test_repair_keeps_first_valid(spark):
    ids = spark.createDataFrame([("w1", 1, "i1", "x"), ("w1", 2, "i2", "ok1"), ("w1", 3, "i3", "ok2"), ("w2", 1, "i4", "x"), ("w2", 2, "i5", "y"), ("w3", 1, "i6", "ok1"), ("w4", 1, "i7", "ok1"), ("w4", 2, "i8", "x")], "work string, pos int, id string, literal string")
    valid = spark.createDataFrame([("ok1",), ("ok2",)], "literal string")
    kept, removed = graph.repair_duplicates(ids, valid, spark.createDataFrame([("w4",)], "work string"))
    assert rows(kept.select("id")) == [("i2",)] and rows(removed.select("id")) == [("i1",), ("i3",)]


def test_evaluation(spark):
    sweep = spark.createDataFrame([(1, 0.5), (3, 0.9), (2, 0.9)], "threshold int, f1 double")
    assert evaluate.best_threshold(sweep) == 2
    want, got = spark.createDataFrame([("A ",), ("b",), (None,)], "id string"), spark.createDataFrame([("a",), ("c",), ("c",)], "id string")
    assert rows(evaluate.precision_recall(want, got)) == [(0.5, 0.5, 0.5)]
    assert rows(evaluate.precision_recall(want, spark.createDataFrame([("z",)], "id string"))) == [(0.0, 0.0, None)]
    assert rows(evaluate.precision_recall(want.limit(0), want.limit(0))) == [(None, None, None)]
    terms, near = spark.createDataFrame([("a",), ("b",)], "term string"), spark.createDataFrame([("a", 0.6)], "term string, similarity double")
    assert rows(evaluate.coverage(terms, near, [0.5, 0.7])) == [(0.5, 1, 1), (0.7, 0, 2)]


def test_checks_find_planted_faults(spark):
    ident = spark.createDataFrame([("i1", "o1", "doi", "x"), ("i2", "o2", "doi", "x"), ("i3", "o3", "xmlid", "r1"), ("i4", "o4", "xmlid", "r1")], "iri string, owner string, scheme string, literal string")
    assert rows(checks.shared_identifiers(ident)) == [("doi", "x", 2)]
    assert len(rows(checks.repeated_identifier_entities(ident))) == 2
    parts = spark.createDataFrame([("v1", "JournalVolume", "j", "1"), ("v2", "JournalVolume", "j", "1"), ("v3", "JournalVolume", None, "1")], "iri string, type string, part_of string, seq_id string")
    assert rows(checks.repeated_numbers(parts)) == [("j", "1", 2)] and rows(checks.not_part_of(parts)) == [("v3", "JournalVolume")]


@pytest.fixture(scope="module")
def articles(spark):
    return files.read_articles(spark, f"{FIXTURES}/articles")


def test_references_of_an_article(articles):
    found = {r["xmlid"]: r for r in jats.extract_references(articles).collect()}
    assert found["B1"]["text"] == "Doe, J, Roe, R. On things, J Things, 2001, DOI: 10.55/ABC, PMID: 77" and found["B1"]["pmid"] == "77"
    assert found["B2"]["text"].startswith("Poe, E. Other matters. Lit ét 1845; 12: 3 –9.") and found["B2"]["url"] == "https://poe.example/x"
    assert found["B3"]["text"] == "Old style, 1999" and found["B5"]["url"] is None and found["B6"]["text"] is None and found[None]["text"] == "Without id"
    assert [r["doi"] for r in jats.article_doi(articles).collect()] == ["10.55/main"]
    assert [r["doc"] for r in jats.broken(articles).collect()] == ["broken.xml"]


def test_pointers_of_an_article(articles):
    found = jats.extract_pointers(articles)
    listed = jats.pointer_lists(found).orderBy("pos").collect()
    assert [r["xmlid"] for r in listed] == ["B1", "B1", "B2", "B3", "B6", "B2"]
    assert listed[0]["list_id"] is None and len({r["list_id"] for r in listed[1:5]}) == 1 and listed[1]["list_id"] and listed[5]["list_id"] is None
    assert listed[0]["sentence"].startswith("Cells were studied by Smith et al. 1 in detail.") and listed[1]["sentence_no"] == 1 and listed[5]["parent"] == "sup"
    whole = jats.expand_ranges(jats.pointer_lists(found), jats.extract_references(articles)).orderBy("rank").collect()
    assert [(r["xmlid"], r["label"]) for r in whole[3:7]] == [("B3", "3"), ("B4", "in sequence"), ("B5", "in sequence"), ("B6", "6")]
    parents = {r["class"]: r["parent"] for r in jats.discourse(found).collect()}
    assert parents["Section"] is None and parents["Paragraph"].endswith("/sec[1]")
    census = {(r["element"], r["attribute"]): r["n"] for r in jats.census(articles).collect()}
    assert census["ref", None] == 7 and census["ref", "id"] == 6


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_discourse_needs_no_join(spark):
    found = spark.createDataFrame([("a", "/article/body[1]/sec[1]/x[1]/p[2]"), ("a", "/article/body[1]/sec[1]"), ("b", "/article/fn[1]"), ("b", "p[1]"), ("b", None)], "doc string, parent_path string")
    sec = "/article/body[1]/sec[1]"
    assert rows(jats.discourse(found)) == sorted([("a", sec, "Section", None), ("a", f"{sec}/x[1]/p[2]", "Paragraph", sec), ("b", "/article/fn[1]", "Footnote", None), ("b", "p[1]", "Paragraph", None)], key=str)
    articles = spark.createDataFrame([("a", "<article><body><sec><p>x <xref rid='B1'>1</xref></p></sec></body><back><ref-list><ref id='B1'/></ref-list></back></article>")], "doc string, xml string")
    text = plan(jats.discourse(jats.extract_pointers(articles)))
    assert text.count("MapInArrow") == 1 and "Join" not in text  # each article is parsed once


def test_sentences():
    text = "A first one, e.g. this (see Fig. 2). A second by J. Smith et al. 2001. [1] Third?"
    assert [text[a:b].strip() for a, b in jats.sentences(text)] == ["A first one, e.g. this (see Fig. 2).", "A second by J. Smith et al. 2001.", "[1] Third?"]


def test_citation_text_of_json(spark):
    pages = spark.createDataFrame([("a1", '{"referenceList": {"reference": [{"authorString": "Doe J", "title": "T.", "pubYear": 2001, "volume": "3", "issue": "2", "pageInfo": "1-9", "match": "Y", "id": "9", "source": "MED"}, {"authorString": "Author unknown", "unstructuredInformation": "<b>Free</b> text", "doi": "10.1/X"}, {"title": "no author"}]}}')], "article string, value string")
    papers = spark.createDataFrame([("MED", "9", "10.9/p", "9", None)], "source string, id string, doi string, pmid string, pmcid string")
    found = extract.reference_lists(pages, papers).orderBy("pos").collect()
    assert (found[0]["bibentry"], found[0]["process_entry"], found[0]["doi"]) == ("Doe J (2001). T. 3 (2): 1-9", True, "10.9/p")
    assert (found[1]["bibentry"], found[1]["process_entry"], found[1]["doi"]) == ("Free text", True, "10.1/x")
    assert found[2]["bibentry"] is None


def test_statements_and_shards(spark, tmp_path):
    data = spark.createDataFrame([("http://g/br/", "http://g/br/1", "http://p", 'a "q"\n\\n\tb', "lit", None), (None, "http://g/br/1001", "http://p", "http://g/br/2", "iri", None), ("http://g/br/", "http://g/br/2", "http://d", "2001", "lit", "http://t")], "g string, s string, p string, o string, o_kind string, o_dt string")
    files.write_statements(data, f"{tmp_path}/nq")
    files.write_jsonld(data, f"{tmp_path}/json")
    assert rows(files.read_statements(spark, f"{tmp_path}/nq")) == rows(data) == rows(files.read_jsonld(spark, f"{tmp_path}/json").select(*data.columns))
    files.store_shards(data, f"{tmp_path}/shards")
    files.store_shards(data.limit(1).withColumn("o", F.lit("more")), f"{tmp_path}/shards")
    stored = spark.read.parquet(f"{tmp_path}/shards")
    assert stored.count() == 4 and stored.filter("file_split = 2000").count() == 1


def test_fetch_retries():
    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *a):
            pass

        def read(self):
            return b"text"

    def opener(outcomes):
        def call(url, timeout):
            x = outcomes.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        return call

    waits = []
    http = lambda code: urllib.error.HTTPError("u", code, "m", {}, None)
    assert files.fetch("u", opener=opener([http(500), TimeoutError(), Answer()]), sleep=waits.append) == ("ok", "text") and waits == [10.0, 10.0]
    assert files.fetch("u", opener=opener([http(404)]), sleep=waits.append) == ("not_found", None)
    assert files.fetch("u", tries=3, opener=opener([http(500), http(500), TimeoutError()]), sleep=waits.append) == ("error", "HTTP status 500 | timeout")
    clock, slept = iter([0.0, 0.05, 0.4]), []
    throttle = files.Throttle(10, clock=lambda: next(clock), sleep=slept.append)
    for _ in range(3):
        throttle()
    assert slept == [pytest.approx(0.05)]


def test_upload_keeps_what_failed(spark, tmp_path):
    updates = spark.createDataFrame([(0, "good"), (1, "bad")], "batch long, request string")
    assert files.upload(updates, lambda r: r == "good", f"{tmp_path}/err") == (1, 1)
    assert [r["request"] for r in spark.read.json(f"{tmp_path}/err").collect()] == ["bad"]


def test_upload_of_all_or_nothing(spark, tmp_path):
    quads = spark.createDataFrame([("http://g/br/", f"http://g/br/{i}", "http://p", "x", "lit", None) for i in (1, 2, 1500)], "g string, s string, p string, o string, o_kind string, o_dt string")
    updates, sent = spark.createDataFrame([(1, "second"), (0, "first")], "batch long, request string"), []
    take = lambda r: sent.append(r) or True
    fail = F.udf(lambda o: 1 / 0, "string")
    assert not files.store_and_upload(quads.withColumn("o", F.when(F.col("s").endswith("1500"), fail("o")).otherwise(F.col("o"))), updates, take, f"{tmp_path}/a")
    assert sent == [] and (tmp_path / "a/_NOT_UPLOADED").read_text().startswith("not stored")
    assert files.store_and_upload(quads, updates, take, f"{tmp_path}/a")
    assert sent == ["first", "second"] and not (tmp_path / "a/_NOT_UPLOADED").exists() and spark.read.parquet(f"{tmp_path}/a/shards").count() == 3
    assert not files.store_and_upload(quads, updates, lambda r: r == "first", f"{tmp_path}/b")
    assert (tmp_path / "b/_NOT_UPLOADED").read_text() == "1 requests refused" and [r["request"] for r in spark.read.json(f"{tmp_path}/b/errors").collect()] == ["second"]


def test_search_cursor(spark):
    import json

    page = lambda ids, cursor: json.dumps({"resultList": {"result": [{"id": i, "source": "MED"} for i in ids]}, "nextCursorMark": cursor})
    web = {"*": page("ab", "zz"), "zz": page("c", "aa"), "aa": page("", "aa")}
    pages = list(extract.paged(web.get))
    found, cursor = extract.from_pages(spark.createDataFrame(pages, "page int, value string"))
    assert rows(found.select("localid")) == [("MED-a",), ("MED-b",), ("MED-c",)] and cursor == "aa"  # not the largest
    assert extract.from_pages(spark.createDataFrame([*pages, (2, web["aa"])], "page int, value string"))[1] is None
    assert [n for n, _ in extract.paged(web.get, "zz")] == [0]
    assert [json.loads(p)["nextCursorMark"] for _, p in extract.paged(web.get, "lost")] == ["zz", "aa"]  # once more from the start
    asked = []
    assert list(extract.paged(lambda c: asked.append(c), "lost")) == [] and asked == ["lost", "*"]
    assert extract.from_pages(spark.createDataFrame([], "page int, value string"))[1] is None


@pytest.mark.parametrize(
    ("xml", "text"),
    [
        ("<element-citation><person-group><name><surname>Doe</surname><given-names>J</given-names></name><name><surname>Roe</surname></name></person-group><year>1999</year></element-citation>", "Doe, J, Roe. 1999"),
        ("<mixed-citation>Doe J. <article-title>On</article-title>. <year>1999</year> <volume>4</volume> ( <issue>. 2</issue>) : <fpage>3</fpage>- <lpage>9</lpage> .</mixed-citation>", "Doe J. On. 1999 4 (2): 3-9."),
        ("<mixed-citation><person-group><string-name>Doe J</string-name></person-group> <source>Book</source>,, x , ; y</mixed-citation>", "Doe J. Book, x; y"),
        ("<citation>Old <pub-id pub-id-type='pmcid'>12</pub-id><pub-id pub-id-type='other'>7</pub-id></citation>", "Old, PMC: 12, 7"),
        ("<element-citation> </element-citation>", None),
        ("<other>x</other>", None),
    ],
)
def test_citation_text_of_xml(xml, text):
    assert jats.citation_text(jats.ElementTree.fromstring(f"<ref>{xml}</ref>")) == text


SPEC = """#url /api/v1
#type api

#url /metadata/{dois}
#type operation
#dois str(10\\..+)
#preprocess upper(dois) --> split_dois(dois)
#field_type str(doi) int(n) datetime(year)
#description Several
lines of text"""


def test_rest_operation(spark):
    api, op = rest.parse_spec(SPEC)
    assert op["description"] == "Several\nlines of text" and rest.parameter_types(op) == {"dois": ("str", r"10\..+")} and api["type"] == "api"

    def build(dois):
        assert dois == ["10.1/A", "10.2/B"]
        return spark.createDataFrame([("x", "3", "2016", "Doe, John; Roe, Jane"), ("y", "12", "2016-05", ""), ("z", None, "2017-01", "One, A"), ("", "7", "2020", "Two, B")], "doi string, n string, year string, names string")

    operation = rest.Operation(build, rest.parameter_types(op)["dois"][1], op["preprocess"], rest.field_types(op))
    out = operation("10.1/a__10.2/b", 'sort=desc(year)&filter=year:>2016&exclude=doi&json=array("; ",names)&json=dict(", ",names,fname,gname)')
    assert [(r["doi"], [tuple(n) for n in r["names"]]) for r in out.collect()] == [("z", [("One", "A")]), ("y", [])]
    assert [r["doi"] for r in operation("10.1/a__10.2/b", "filter=n:>5&sort=asc(n)").collect()] == ["", "y"]
    assert [r["doi"] for r in operation("10.1/a__10.2/b", "filter=names:^(Doe|One)").collect()] == ["x", "z"]
    assert rest.rendered(out.select("doi"), accept="text/csv").first()["value"] == "z" and rest.rendered(out.select("doi"), "format=json", "text/csv").first()["value"] == '{"doi":"z"}'
    with pytest.raises(ValueError):
        operation("nothing")


def test_queue(spark, tmp_path):
    todo = tmp_path / "todo"
    todo.mkdir()
    doc = lambda doi, **x: str({"doi": doi, "localid": f"L{doi}", "references": [{"bibentry": "t"}], **x}).replace("'", '"').replace("None", "null")
    (todo / "1.json").write_text(doc("10.1/a"))
    (todo / "2.json").write_text(doc("10.1/b", references=[{}]))
    root = f"{tmp_path}/root"
    assert queue.run(spark, str(todo), root, files_per_batch=1) == 2
    (todo / "3.json").write_text(doc("10.1/a", pmid="5"))
    (todo / "4.json").write_text(doc("10.1/c"))
    (todo / "5.json").write_text(doc(None, localid="only"))
    assert queue.run(spark, str(todo), root) == 1
    done = spark.read.parquet(f"{root}/done").select("doi", "num")
    assert rows(done) == [("10.1/a", 1), ("10.1/c", 2)]
    assert {r["key"] for r in spark.read.parquet(f"{root}/failed").collect()} == {"10.1/b", "only"}
    (todo / "6.json").write_text(doc("10.1/d"))
    (tmp_path / ".stop").write_text("")
    assert queue.run(spark, str(todo), root, stop_marker=str(tmp_path / ".stop")) == 0
    (tmp_path / ".stop").unlink()
    assert queue.run(spark, str(todo), root, stop_marker=str(tmp_path / ".stop")) == 1  # what was stopped is worked off
    assert rows(spark.read.parquet(f"{root}/done").select("doi", "num")) == [("10.1/a", 1), ("10.1/c", 2), ("10.1/d", 3)]


def test_queue_stopped_in_the_middle(spark, tmp_path, monkeypatch):
    """The marker appears after the first of three documents; the next run finds the others, and each is there once."""
    todo, marker, root = tmp_path / "todo", tmp_path / ".stop", f"{tmp_path}/root"
    todo.mkdir()
    for i in range(3):
        (todo / f"{i}.json").write_text(f'{{"doi": "10.1/{i}", "references": []}}')
    work = queue.Ingest.__call__

    def once(self, batch, batch_id):
        work(self, batch, batch_id)
        marker.write_text("")

    monkeypatch.setattr(queue.Ingest, "__call__", once)
    assert queue.run(spark, str(todo), root, files_per_batch=1, stop_marker=str(marker)) == 1
    assert spark.read.parquet(f"{root}/done").count() == 1
    assert queue.run(spark, str(todo), root, files_per_batch=1, stop_marker=str(marker)) == 0
    monkeypatch.setattr(queue.Ingest, "__call__", work)
    marker.unlink()
    assert queue.run(spark, str(todo), root, files_per_batch=1, stop_marker=str(marker)) == 2
    done = spark.read.parquet(f"{root}/done").select("doi", "num").collect()
    assert sorted(r["doi"] for r in done) == ["10.1/0", "10.1/1", "10.1/2"] and sorted(r["num"] for r in done) == [1, 2, 3]
    (todo / "bad.json").write_text('{"doi": "10.1/9"}')

    def broken(self, batch, batch_id):
        raise ValueError("broken")

    monkeypatch.setattr(queue.Ingest, "__call__", broken)
    with pytest.raises(Exception, match="broken"):  # a failure of the work is no stop
        queue.run(spark, str(todo), root, stop_marker=str(marker))
