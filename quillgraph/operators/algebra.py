"""Graph-pattern algebra over edge and entity DataFrames [QA-*]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.sources.workspace import written


def _joined(left: DataFrame, right: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, [F.col(f"a.`{x}`") == F.col(f"b.`{y}`") for x, y in on.items()], how)
    return joined.select(*[F.col(f"a.`{c}`") for c in left.columns], *[F.col(f"b.`{c}`") for c in right.columns if c not in on.values() and how != "left_anti"])


def bgp(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """[QA-01] Join of two patterns over shared variables, named ``{left: right}``; the right names go."""
    return _joined(left, right, on, "inner")


def optional(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """[QA-02] The same, keeping rows of the left without a match. Nested ones: build the right side first."""
    return _joined(left, right, on, "left")


def not_exists(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """[QA-04]"""
    return _joined(left, right, on, "left_anti")


def inverse(edges: DataFrame) -> DataFrame:
    """[QA-10] Edges (src, dst) backwards."""
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def sequence(first: DataFrame, second: DataFrame) -> DataFrame:
    """[QA-11] Pairs joined by an edge of ``first`` and then one of ``second``; a bag, as SPARQL's sequences are."""
    a, b = first.alias("a"), second.alias("b")
    return a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))


def alternative(*edges: DataFrame) -> DataFrame:
    """[QA-12] Edges of any; a bag."""
    out = edges[0].select("src", "dst")
    for e in edges[1:]:
        out = out.unionByName(e.select("src", "dst"))
    return out


def one_or_more(edges: DataFrame, max_depth: int = 100) -> DataFrame:
    """[QA-13] Distinct pairs joined by one or more edges (src, dst); cycles end by themselves.

    Each round extends only the pairs found new in the round before, and is
    written out, so that plans stay small and lost executors are no matter.
    """
    edges = written(edges.select("src", "dst").distinct(), "edges")
    paths = [edges]
    frontier = edges
    for _ in range(max_depth):
        known = paths[0]
        for p in paths[1:]:
            known = known.unionByName(p)
        frontier = written(sequence(frontier, edges).distinct().join(known, ["src", "dst"], "left_anti"), "paths")
        if frontier.isEmpty():
            return known
        paths.append(frontier)
    raise RuntimeError(f"there are paths of more than {max_depth} edges")


def zero_or_more(edges: DataFrame, nodes: DataFrame, max_depth: int = 100) -> DataFrame:
    """[QA-14] The same, and every node of ``nodes`` (node) and of the edges with itself."""
    return one_or_more(edges, max_depth).unionByName(_identity(edges, nodes)).distinct()


def zero_or_one(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """[QA-15]"""
    return edges.select("src", "dst").unionByName(_identity(edges, nodes)).distinct()


def _identity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    every = nodes.select("node").unionByName(edges.select(F.col("src").alias("node"))).unionByName(edges.select(F.col("dst").alias("node")))
    return every.distinct().select(F.col("node").alias("src"), F.col("node").alias("dst"))


def values(spark, name: str, items: list[str]) -> DataFrame:
    """[QA-08] An inline table of one column."""
    return spark.createDataFrame([(i,) for i in items], f"`{name}` string")


def group_concat(value: str, separator: str, distinct: bool = False) -> Column:
    """[AG-02] Values joined in order of themselves; nulls are passed over."""
    gathered = F.collect_set(value) if distinct else F.collect_list(value)
    return F.array_join(F.array_sort(gathered), separator)


def construct(quads: DataFrame, subjects: DataFrame) -> DataFrame:
    """[QA-18] The triples about ``subjects`` (s)."""
    return quads.join(subjects.distinct(), "s", "left_semi").select("s", "p", "o")


def least(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """[AG-06] The least value of each key, by an aggregation: no row is sorted."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """[AG-06, RS-04] The first row of each key."""
    from pyspark.sql import Window

    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")
