"""Exact interpolated quantiles that never hold a column's distinct values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .cols import as_list, same_keys, with_row
from .ordered import running


def long_values(df: DataFrame, cols, group=()) -> DataFrame:
    """(group…, column, value) rows, nulls left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in as_list(cols)])
    return df.select(*as_list(group), F.inline(pairs)).where("value IS NOT NULL")


def quantiles_long(long: DataFrame, probs: dict[str, float], group, distinct: str | None = None) -> DataFrame:
    """Quantiles of `value` per group: equal values are counted first, then running counts locate the ranks."""
    group = as_list(group)
    counts = long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("__cnt"))
    cum = running(counts, "value", group, sums={"__cum": F.col("__cnt")}, bounds_from=long)
    totals = long.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    if group:
        cum = same_keys(cum, totals, group)
    else:
        cum = with_row(cum, totals)
    aggs, outs = [], []
    for i, (name, p) in enumerate(probs.items()):
        at = F.lit(p) * (F.col("__n") - 1)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("__cum") - F.col("__cnt") <= k) & (k < F.col("__cum"))
            aggs.append(F.max(F.when(holds, F.col("value"))).alias(f"__{side}{i}"))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        frac = F.lit(p) * (F.col("__n") - 1) - F.floor(F.lit(p) * (F.col("__n") - 1))
        outs.append((lo + (hi - lo) * frac).alias(name))
    if distinct:
        aggs.append(F.count(F.lit(1)).alias(distinct))
        outs.append(F.col(distinct))
    table = cum.groupBy(*group).agg(F.max("__n").alias("__n"), *aggs)
    return table.select(*group, *outs)


def quantiles(df: DataFrame, cols, probs: dict[str, float], group=(), distinct: str | None = None) -> DataFrame:
    """One row per (group, column)."""
    return quantiles_long(long_values(df, cols, group), probs, [*as_list(group), "column"], distinct)


def quantile_row(df: DataFrame, value, probs: dict[str, float]) -> DataFrame:
    """Quantiles of one expression as a single row."""
    value = F.col(value) if isinstance(value, str) else value
    return quantiles_long(df.select(value.cast("double").alias("value")).where("value IS NOT NULL"), probs, [])
