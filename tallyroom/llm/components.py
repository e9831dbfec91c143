"""Connected components of a distributed edge list by hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.plans.stages import staged


def compact(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """Stage a frame of at most ``rows`` rows in no more tasks and files than they are worth."""
    return staged(df.coalesce(max(8, rows // per_task)))


def _compressed(pointers: DataFrame, rows: int) -> DataFrame:
    """Follow ``v -> p`` to its end, doubling the reach with every step."""
    while True:
        ends = pointers.select(F.col("v").alias("p"), F.col("p").alias("end"))
        step = compact(pointers.join(ends, "p").select("v", "p", "end"), rows)
        if step.filter("p <> end").isEmpty():
            return step.select("v", "p")
        pointers = step.select("v", F.col("end").alias("p"))


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of the edges ``a, b``; the root is the smallest vertex.

    Every vertex points to its smallest neighbour or itself, the pointers are followed to their
    ends, and the edges between the ends are what is left to do. At least half of the vertices go
    each time. Rows are combined before every shuffle, and no vertex gathers its neighbours.
    """
    rows = 2 * edges.count()
    edges = compact(edges.select("a", "b").filter("a <> b").distinct(), rows)
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m"))
        pointers = nearest.select(F.col("a").alias("v"), F.least("a", "m").alias("p"))
        pointers = _compressed(compact(pointers, rows), rows)
        if labels is None:
            labels = pointers.select("v", F.col("p").alias("root"))
        else:
            moved = pointers.select(F.col("v").alias("root"), "p")
            labels = labels.join(moved, "root", "left").select("v", F.coalesce("p", "root").alias("root"))
            labels = compact(labels, rows)
        left = edges
        for end in ("a", "b"):
            left = left.join(pointers.select(F.col("v").alias(end), F.col("p").alias(f"{end}_root")), end)
        left = left.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).filter("a <> b").distinct()
        edges = compact(left, rows)
    return labels
