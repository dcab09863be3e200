"""Plans whose figures must not grow faster than their input, and the same rows from them."""

import os

import duckdb
import pytest

from quillgraph.plans import services
from quillgraph.sources import workspace
from quillgraph.streaming import queue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """The tables with lines of no part, lines and orders that come twice, and an order without lines."""
    folder, c = tmp_path_factory.mktemp("odd"), duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        c.execute(f"CREATE TABLE {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    c.execute("UPDATE lineitem SET l_partkey = NULL WHERE l_orderkey % 10 = 3 AND l_linenumber = 1")
    c.execute("INSERT INTO lineitem SELECT * FROM lineitem WHERE l_orderkey % 50 = 7")
    c.execute("INSERT INTO orders SELECT * FROM orders WHERE o_orderkey IN (8, 9)")
    c.execute("DELETE FROM lineitem WHERE l_orderkey = 12")
    for (name,) in c.execute("SELECT table_name FROM information_schema.tables").fetchall():
        c.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder), c


def same_rows(frame, found):
    columns = sorted(frame.columns)
    text = lambda r: tuple("~" if v is None else str(v) for v in r)
    assert sorted(text([r[c] for c in columns]) for r in frame.collect()) == sorted(text([r[found.columns.index(c)] for c in columns]) for r in found.fetchall())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_intext_sorts_what_is_bound_once(spark, odd):
    """it was sorted again for each kind of work, and pointers went through three aggregations of objects."""
    folder, duck = odd
    frame = services.QUERIES["cat_document_intext"](spark, folder)
    same_rows(frame, duck.sql(services.SQL["cat_document_intext"]))
    plan = plan_of(services.QUERIES["cat_document_intext"](spark, SF))
    assert "LeftSemi" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("name", ["cat_document", "cat_document_intext"])
def test_joins_are_spread_over_the_input(spark, odd, monkeypatch, name):
    """the partitions were as many whatever the input, and each task's memory grew with it."""
    folder, duck = odd
    monkeypatch.setattr(workspace, "EACH", 500)
    frame = services.QUERIES[name](spark, folder)
    n = duck.sql("SELECT count(*) FROM lineitem").fetchall()[0][0] // 500
    assert n > 4 and plan_of(frame).count(f", {n}), REPARTITION_BY_NUM") >= 2
    same_rows(frame, duck.sql(services.SQL[name]))


def test_a_batch_is_made_distinct_once(spark, tmp_path, monkeypatch):
    """each table that a batch writes joined, sorted and dealt out the documents anew."""
    (tmp_path / "todo").mkdir()
    doc = lambda doi, ref, local: f'{{"doi": {doi}, "localid": {local}, "references": [{{"bibentry": {ref}}}]}}'
    lines = [doc(f'"10.1/{i % 10}"', '"t"' if i % 2 else "null", f'"L{i}"') for i in range(40)] + [doc("null", '"t"', "null")] * 2
    (tmp_path / "todo" / "a.json").write_text("\n".join(lines))
    plans, number, root = [], queue.numbered, f"{tmp_path}/root"
    monkeypatch.setattr(queue, "numbered", lambda df, *a: plans.append(plan_of(df)) or number(df, *a))
    assert queue.run(spark, f"{tmp_path}/todo", root, whole_files=False) == 1
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Sort" not in plans[0]
    done, failed = ([r["key"] for r in spark.read.parquet(f"{root}/{n}").collect()] for n in ("done", "failed"))
    # Of documents with one key one counts, done or failed; those without a key all fail.
    assert sorted(done + [k for k in failed if k]) == [f"10.1/{i}" for i in range(10)] and failed.count(None) == 2
    (tmp_path / "todo" / "b.json").write_text("\n".join(doc(f'"10.1/{i}"', '"t"', "null") for i in range(12)))
    assert queue.run(spark, f"{tmp_path}/todo", root, whole_files=False) == 1
    new = {"10.1/10", "10.1/11"} | {k for k in failed if k}
    rows = spark.read.parquet(f"{root}/done").collect()
    assert sorted(r["key"] for r in rows) == sorted(set(done) | new) and sorted(r["num"] for r in rows) == list(range(1, len(rows) + 1))


def test_spot_signatures_travel_as_numbers(spark, monkeypatch):
    """every signature of every class was shuffled thrice, with the hex digits of both."""
    spotsigs = pytest.importorskip("quillgraph.llm.spotsigs")
    texts = ["the cat sat on the mat by the old door", "the cat sat on the mat by the old gate", "the dog ran to the sea", None, "", "the cat sat on the mat by the old door"]
    tables, write = {}, spotsigs.written
    monkeypatch.setattr(spotsigs, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = [(*sorted((r["a"], r["b"])), r["likeness"]) for r in spotsigs.similar_pairs(docs, 0.5, ["the"])[1].collect()]
    assert pairs == [(0, 1, 0.6)]
    assert dict(tables["spotsig-prefixes"].dtypes) == {"c": "bigint", "n": "int", "sig": "int"}
    # Signatures that only one class has meet nothing and are not kept.
    assert tables["spotsig-counts"].count() == 3 and tables["spotsig-counts"].filter("k < 2").isEmpty()
    assert tables["spotsig-prefixes"].join(tables["spotsig-counts"], tables["spotsig-prefixes"]["sig"] == tables["spotsig-counts"]["__sig"], "left_anti").isEmpty()
