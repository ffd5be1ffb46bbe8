"""Connected components of an edge list by alternating star contractions, in logarithmically many rounds.

A round links every vertex' larger neighbours to its smallest neighbour, then every smaller neighbour to the smallest of
them. Smallest neighbours are a combinable minimum; nothing gathers a vertex' neighbours in one place, and a hub's rows
meet their minimum in a plain equi-join, which Spark splits where a key is hot. Each step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "large-star")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "down")
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b): for every vertex that isn't the smallest of its component, that smallest vertex.

    ``edges`` has two long columns ``a`` and ``b``; order, repeats and loops don't matter; an empty list gives an empty result.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges
