"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.store import written


def _toward_smallest(edges: DataFrame) -> DataFrame:
    """Neighbours of a node move to the smallest of them; rows (u, v) keep u > v."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge table (u, v) of longs: root is the smallest node reachable.

    Every round joins larger neighbours to the smallest neighbour of a node, then smaller
    neighbours and the node itself (large star and small star), until the edges form stars.
    The number of rounds grows with the logarithm of the nodes; a graph that needs more than
    ``max_rounds`` raises an error, it is never returned unfinished. Rounds are written to the
    shared folder. Hot nodes stand on the left of plain equi-joins, which adaptive execution splits.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    now = written(
        edges.filter(F.col("u") != F.col("v")).select(larger.alias("u"), smaller.alias("v")).distinct(), "edges"
    )
    mark = _mark(now)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _toward_smallest(both)
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        star = _toward_smallest(large)
        small = (
            star.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(star.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        now = written(small, "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges: unchanged edges are stars."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
