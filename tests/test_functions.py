"""Golden values of the scalar functions."""

import difflib
import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import matching as mt
from quillgraph.functions import text as tx
from quillgraph.plans import services
from quillgraph.schema import BASE


def values(spark, f, *inputs, ddl="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {ddl}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]


def test_publication_dates(spark):
    given = ([2018, 1, 1], [2018, 1], [2018, 1, 15], [2018, 12, 1], [2018, 3, 1], [2018, 3, 23], [2018], None)
    assert values(spark, tx.pub_date, *given, ddl="array<int>") == ["2018", "2018-01", "2018-01-15", "2018-12-01", "2018-03-01", "2018-03-23", "2018", None]


def test_names(spark):
    assert values(spark, tx.normalise_name, "Albért", "Albert", "John", "O'Neil-Ñ", "", None) == ["albert", "albert", "john", "oneiln", "", None]
    assert values(spark, tx.normalise_id, "Ärt/1 x", None) == ["art#1_x", None]
    assert values(spark, tx.normalise_ascii, "ﬁne ½ ß") == ["fine 12 "]


def test_ascii_form_of_every_character(spark):
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    texts = [None, "", "plain", "é", "\x7fﬁ\n½é", *(f"a{every[k : k + 1000]}z" for k in range(0, len(every), 1000))]
    assert values(spark, tx.normalise_ascii, *texts) == [t and unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    frame = spark.createDataFrame([("é",)], "x string").select(tx.normalise_name(F.col("x")), tx.normalise_id(F.col("x")), tx.clean_entry(F.col("x")))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()  # texts stay out of the memory of Python


def test_identifiers(spark):
    assert values(spark, tx.normalise_doi, "doi:10.1/A b%2Fc+d", "none", "10.5/x%ZZ", "x10.2/ Y\0", None) == ["10.1/ab/c+d", None, "10.5/x%zz", "10.2/y", None]
    assert values(spark, tx.extract_doi, "see 10.1016/j.x.2020.1. End", "10.1/start", "(10.2.3/abc),", "no", None) == ["10.1016/j.x.2020.1", None, "10.2.3/abc)", None, None]
    assert values(spark, tx.extract_url, "at https://a.example/b/. x", "http://c", "none") == ["https://a.example/b", "http://c", None]
    assert values(spark, tx.encode_url, "http://a b/ü*~+", None) == ["http://a%20b/%C3%BC%2A~%2B", None]
    assert values(spark, tx.clean_issn, "1234–5678", "0000-0000", "0000–0000", " ", None) == ["1234-5678", None, None, None, None]
    assert values(spark, tx.clean_isbn, "http://x.example/isbn/978–1", "9781") == ["978-1", "9781"]
    assert values(spark, tx.isbn_variants, "978-123", "9781-2", "55") == [["978-123", "123", "978123"], ["9781-2", "1-2", "97812", "12"], ["55"]]
    assert values(spark, tx.clean_entry, "A: é") == ["A%2C%20e"]


def test_pages_titles_labels(spark):
    assert values(spark, tx.first_page, "12-34", "12–34", "e5", "1-2-3") == ["12", "12", "e5", "1"]
    assert values(spark, tx.last_page, "12-34", "12––34", "e5", "1-2-3") == ["34", "34", "e5", "3"]
    assert values(spark, tx.join_titles, [" a ", "", "b"], ["  "], [], ddl="array<string>") == ["a - b", None, None]
    assert values(spark, tx.truncated, "a" * 20, "b" * 21) == ["a" * 20, "b" * 20 + "..."]
    assert values(spark, tx.timespan_days, "P1Y2M3D", "P3D", "x") == [428, 3, 0]
    assert values(spark, tx.timespan_words, "P1Y2M3D", "P1D") == ["1 year, 2 months, 3 days", "1 day"]
    assert values(spark, tx.readable_type, "http://purl.org/spar/fabio/JournalArticle") == ["Journal Article"]
    assert values(spark, tx.strip_html, "<i>a</i> &amp; b&nbsp;c") == ["a & b c"]
    assert values(spark, tx.search_words, "See https://x.y/z Smith et al. (2001) Available at: Web") == [["see", "smith", "2001", "web"]]


@pytest.mark.parametrize(
    ("iri", "path"),
    [
        ("br/15", "/base/br/_/10000/1000.json"),
        ("br/15/prov/se/1", "/base/br/_/10000/1000/prov/se.json"),
        ("br/01234015", "/base/br/012340/10000/1000.json"),
        ("br/01234015/prov/se/1", "/base/br/012340/10000/1000/prov/se.json"),
        ("prov/pa/1", "/base/prov/pa/1.json"),
        ("", "/base/index.json"),
        ("br/", "/base/br/index.json"),
        ("br/10001", "/base/br/_/20000/11000.json"),
    ],
)
def test_shard_paths(spark, iri, path):
    assert values(spark, lambda c: tx.shard_path(c, BASE, "/base/"), BASE + iri) == [path]


def test_iri_parts(spark):
    assert [int(n) for n in values(spark, tx.resource_number, BASE + "br/15", BASE + "br/07015/prov/se/1")] == [15, 15]
    assert str(values(spark, tx.resource_number, BASE + "br/070" + "1" * 27)[0]) == "1" * 27
    assert values(spark, tx.local_line, BASE + "br/1000", BASE + "br/1001", BASE + "br/07015") == [1000, 1, 15]
    assert values(spark, tx.is_dataset, BASE, BASE + "br/", BASE + "br/1") == [True, True, False]
    assert values(spark, tx.supplier_prefix, BASE + "br/07015", BASE + "br/15") == ["070", ""]


def test_fuzzy_choice(spark):
    text = "Doe, J. (2014). The semantic publishing and referencing ontologies. In Semantic web technologies and legal scholarly publishing."
    titles = ["Semantic Web Technologies and Legal Scholarly Publishing of Today", "Legal ontologies", "The semantic publishing and referencing ontologies"]
    hits = spark.createDataFrame([(1, text, i + 1, t, 90.0) for i, t in enumerate(titles)] + [(2, text, 1, titles[2], 10.0)], "query_id int, text string, rank int, title string, score double")
    found = mt.fuzzy_choice(hits, least_score=50).collect()
    assert [(r["query_id"], r["rank"], r["ratio"]) for r in found] == [(1, 3, 100.0)]
    assert mt.partial_ratio("", "abc") == 0


def test_sentence_similarity(spark):
    pairs = spark.createDataFrame([("big cat", "large feline"), ("dog", "tree")], "a string, b string")
    near = spark.createDataFrame([("big", "large", 0.9), ("cat", "feline", 0.8)], "x string, y string, similarity double")
    assert [tuple(r) for r in mt.sentence_similarity(pairs, near).collect()] == [("big cat", "large feline", 0.85)]


def test_fuzzy_choice_over_whole_texts(spark, tmp_path):
    """The registered query against every window of every hit: passages lie far beyond the openings, one of them with a word changed."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(8)) for i in range(4)]
    near = [" ".join("zzzzz"[: len(w)] if j == 4 and i == 3 else w for j, w in enumerate(t.split())) for i, t in items]
    docs = [(10 + i, prose(150) + " " + near[i] + " " + prose(20)) for i in range(4)]
    # Documents that open with the words of an item in another order are better hits, and worse choices.
    docs += [(20 + i, " ".join(sorted(t.split()) * 3) + " " + prose(30)) for i, t in items]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["query_id"]: (r["id"], r["rank"], r["ratio"]) for r in services.QUERIES["fuzzy_choice"](spark, str(tmp_path)).collect()}
    text, wanted = dict(docs), {}
    windows = lambda a, b: max(difflib.SequenceMatcher(None, a, b[k : k + len(a)], autojunk=False).ratio() for k in range(len(b) - len(a) + 1))
    for r in services.QUERIES["token_search_topk"](spark, str(tmp_path)).collect():
        wanted.setdefault(r["query_id"], []).append((-round(100 * windows(dict(items)[r["query_id"]], text[r["id"]]), 4), r["rank"], r["id"]))
    assert found == {q: (i, rank, -ratio) for q, hits in wanted.items() for ratio, rank, i in [min(hits)]}
    assert all(found[i][0] == 10 + i for i in range(4)) and found[0][2] == 100 > found[3][2] > 80


def test_partial_ratio_takes_the_blocks_of_difflib():
    rng = random.Random(4)
    for _ in range(150):
        symbols = rng.choice(["ab", "abcde fg", "etaoin shrdluß日"])
        a, b = ("".join(rng.choice(symbols) for _ in range(rng.randint(1, n))) for n in (40, 200))
        short, long = sorted((a, b), key=len)
        offsets = {max(0, j - i) for i, j, _ in difflib.SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()}
        assert mt.block_offsets(short, long) >= offsets
        best = max(difflib.SequenceMatcher(None, short, long[k : k + len(short)], autojunk=False).ratio() for k in offsets)
        assert mt.partial_ratio(a, b) == pytest.approx(100 if best > 0.995 else 100 * best)


def test_index_of_asked_words(spark):
    works = spark.createDataFrame([(1, "alpha beta beta gamma"), (2, "alpha delta"), (3, None), (4, ""), (2, "alpha delta")], "id int, bibref string")
    asked = spark.createDataFrame([(1, "beta of the delta")], "query_id int, text string")
    (whole, stats), (part, few) = mt.token_index(works), mt.token_index(works, queries=asked)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(part) == [r for r in rows(whole) if r[0] in ("beta", "delta")] and len(rows(part)) == 2
    assert rows(few) == [r for r in rows(stats) if r[0] in ("beta", "delta")]
    assert not [r for r in rows(whole) if r[0] == ""]


def test_texts_are_not_shuffled_to_their_hits(spark):
    plan = services.QUERIES["fuzzy_choice"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id#" not in plan
