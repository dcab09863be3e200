"""Every query with SQL gives DuckDB's rows; the entry point works with and without the optional parts."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from quillgraph.plans import extraction, inventory, patterns, records, resolution, services

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PLANS = (patterns, resolution, services, extraction, records, inventory)
CASES = [(n, q, p.SQL[n]) for p in PLANS for n, q in p.QUERIES.items() if n in p.SQL]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return c


def text(v):
    return "~" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize(("name", "query", "sql"), CASES, ids=[c[0] for c in CASES])
def test_query_against_sql(spark, duck, name, query, sql):
    frame = query(spark, SF)
    columns = sorted(frame.columns)
    found = duck.sql(sql)
    assert sorted(found.columns) == columns
    mine = sorted(tuple(text(r[c]) for c in columns) for r in frame.collect())
    other = sorted(tuple(text(r[found.columns.index(c)]) for c in columns) for r in found.fetchall())
    assert mine == other


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.count() > 0 and "author" in frame.columns


def test_names_are_registered_once():
    names = [n for p in PLANS for n in p.QUERIES]
    assert len(names) == len(set(names)) and set(names) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_import_without_optional_parts(tmp_path):
    """The entry point alone, with the library but without its optional subpackage and the pipeline."""
    import shutil

    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/quillgraph", tmp_path / "quillgraph", ignore=lambda d, names: ["llm"] if "llm" in names else [])
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op') and n[2:3].isdigit() for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def _plan(spark, name):
    return __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_counted_once(spark):
    assert "Exchange hashpartitioning(a#" not in _plan(spark, "coauthor_pairs")


def test_works_of_authors_are_not_expanded(spark):
    assert "Expand" not in _plan(spark, "cat_author_distinct")


def test_least_citing_work_sorts_no_rows(spark):
    assert "Window" not in _plan(spark, "distinct_first_doi")


def test_citations_are_made_distinct_once(spark):
    assert "Exchange hashpartitioning(citing" not in _plan(spark, "distinct_order_limit")


def test_statements_are_made_distinct_without_sorting(spark):
    assert "SortAggregate" not in _plan(spark, "merge_redirect")
    assert "SortAggregate" not in _plan(spark, "quads_export")


def test_pairs_of_authors_are_made_once(spark):
    assert "Union" not in _plan(spark, "author_match")
