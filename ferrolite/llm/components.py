"""Connected components of an edge table by alternating large-star and small-star steps.

All steps are joins and partial aggregations on tables in the shared folder; no node's neighbours are gathered in
one task. Node ids are longs. Nodes without edges are not in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch, merged


def _star(edges: DataFrame, scratch: Scratch, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones; else the smaller ones and itself) are tied to its least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = scratch.save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "c"))
    linked = merged(both, least, both["a"] == least["c"], "inner")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b")))
    out = scratch.save(out.where("a <> b").distinct())
    scratch.drop(least)
    return out


def _is_done(edges: DataFrame) -> bool:
    """Stars only: every node is tied to one smaller node, which is tied to none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.agg(F.max(((F.col("up") > 1) | (F.col("up") * F.col("down") > 0)).cast("int"))).first()[0]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: (a, b). Returns (node, component), the component being its least node."""
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_done(now):
        step = _star(now, scratch, True)
        after = _star(step, scratch, False)
        scratch.drop(now, step)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
