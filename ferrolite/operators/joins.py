"""Keyed joins, upserts, cutoffs, parameter grids and the term index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.cols import as_list, require, skew_safe_lookup
from .text import term_counts, words


def left_join(left: DataFrame, right: DataFrame, key) -> DataFrame:
    return left.join(right, as_list(key), "left")


def inner_join(left: DataFrame, right: DataFrame, key) -> DataFrame:
    return left.join(right, as_list(key), "inner")


def hstack(key, *frames: DataFrame) -> DataFrame:
    """Feature blocks side by side, matched by key (the first block decides the rows)."""
    return reduce(lambda a, b: a.join(b, as_list(key), "left"), frames)


def upsert_by_action(target: DataFrame, changes: DataFrame, key: str, action: str = "action", order: str = "seq") -> DataFrame:
    """Apply keyed changes: the last change of a key wins, `delete` removes the row, anything else replaces or adds it."""
    cols = [c for c in target.columns if c != key]
    require(changes, key, action, order, *cols)
    last = changes.groupBy(key).agg(F.max_by(F.struct(action, *cols), F.col(order)).alias("__c"))
    both = target.join(last, key, "full").where(F.col("__c").isNull() | (F.col(f"__c.{action}") != "delete"))
    return both.select(key, *[F.when(F.col("__c").isNull(), F.col(c)).otherwise(F.col(f"__c.{c}")).alias(c) for c in cols])


def search_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """Postings (term, key, tf)."""
    return term_counts(df.select(key, words(text).alias("__t")), key, "__t").select("term", key, "tf")


def search(index: DataFrame, key: str, terms) -> DataFrame:
    """Rows holding any of the terms, best first: most terms, then most hits, then key."""
    hits = index.where(F.col("term").isin(as_list(terms)))
    found = hits.groupBy(key).agg(F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("hits"))
    return found.orderBy(F.desc("terms"), F.desc("hits"), key)


def cutoff_join(child: DataFrame, cutoffs: DataFrame, key: str, time: str, spread_by, cutoff: str = "cutoff",
                window: Column | None = None) -> DataFrame:
    """Child rows known at their parent's cutoff: t <= cutoff, and t > cutoff - window. A parent with very many rows is spread."""
    rows = skew_safe_lookup(child, cutoffs, key, spread_by)
    keep = F.col(time) <= F.col(cutoff)
    if window is not None:
        keep = keep & (F.col(time) > F.col(cutoff) - window)
    return rows.where(keep)


def grid_cross(spark: SparkSession, params: dict[str, list]) -> DataFrame:
    """All combinations of bounded value lists, one column per parameter."""
    out = spark.range(1)
    for name, values in params.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out.drop("id")


def grid_from_levels(df: DataFrame, cols, limit: int = 1000) -> DataFrame:
    """All combinations of the levels of some columns; a column with more than `limit` levels is refused."""
    params = {}
    for c in as_list(cols):
        levels = [row[0] for row in df.select(c).distinct().orderBy(c).limit(limit + 1).collect()]
        if len(levels) > limit:
            raise ValueError(f"{c} has more than {limit} levels")
        params[c] = levels
    return grid_cross(df.sparkSession, params)
