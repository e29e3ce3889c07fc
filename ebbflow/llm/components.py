"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Join every node's neighbours to their minimum; a node of many edges is pre-aggregated before its rows move."""
    if small:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    back = pairs.join(low, "u")
    if small:
        out = back.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
    else:
        out = back.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of an edge list ``a, b``."""
    spark = edges.sparkSession
    edges, path = core.stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        new, new_path = core.stage(_star(_star(edges, False), True), "edges")
        core.release(spark, path)
        edges, path, before, seen = new, new_path, seen, _print(new)
        if seen == before:
            break
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")) \
        .union(edges.select("b", "b").distinct())
