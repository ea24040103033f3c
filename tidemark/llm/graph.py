"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Every node of the edges ``a``, ``b`` with the least node it reaches, as ``node``, ``component``.

    Rounds of large and small stars: every node hands its neighbours to the
    least of them, which ends in one star per component after a number of
    rounds that grows with the logarithm of its size. Minima are taken before
    the shuffle; where a node has a large share of the edges, adaptive execution
    splits its side of the join. Every round is stored, in as few files as its
    edges need; ``rows`` bounds those given, if known.
    """
    now = written(_pairs(edges.select("a", "b")), "edges", rows)
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        bigger = large.filter("a != b").distinct()
        small = _to_least(bigger)
        after = written(
            _pairs(small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(small.select("a", F.col("least").alias("b")))),
            "edges",
            mark[0],
        )
        before, mark = mark, _mark(after)
        # A star forest maps to itself.
        if mark == before:
            break
        now = after
    found = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _to_least(edges: DataFrame) -> DataFrame:
    """Edges with the least neighbour of ``a``."""
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
