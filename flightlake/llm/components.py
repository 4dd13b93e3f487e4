"""Connected components by alternating star contraction (large star, small
star): every round is a min per node and a join on the node, so a hub with a
third of all edges is combined before the shuffle and its join can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _directed(e: DataFrame) -> DataFrame:
    """Distinct pairs a > b, without loops."""
    return (e.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _directed(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b"))))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    return _directed(e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b"))))


def _mark(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)``, undirected, of any orderable type; nulls and loops are
    ignored. Returns ``(node, component)`` for every node of an edge, where
    ``component`` is the smallest node reachable. An empty table gives none."""
    e = stored(_directed(edges.select("a", "b").dropna()), "edges")
    seen = _mark(e)
    while seen[0]:
        e = stored(_small_star(_large_star(e)), "edges")
        now = _mark(e)
        if now == seen:
            break
        seen = now
    labels = e.groupBy("a").agg(F.min("b").alias("component"))
    roots = e.select(F.col("b").alias("node")).distinct()
    return (labels.withColumnRenamed("a", "node")
            .unionByName(roots.select("node", F.col("node").alias("component"))))
