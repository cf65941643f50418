"""Category levels: learned on one frame, applied to any other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.cols import same_keys
from ..functions.ordered import number_rows


def level_table(df: DataFrame, col: str, order: str = "frequency", by: str | None = None) -> DataFrame:
    """(level, code, n): codes from 0 by falling frequency (ties by value), by value, or by first appearance along `by`."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if order == "first_seen":
        aggs.append(F.min(by).alias("__first"))
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(*aggs)
    keys = {"frequency": ["-n", "level"], "value": ["level"], "first_seen": ["__first", "level"]}[order]
    return number_rows(counts, keys, out="code").select("level", F.col("code").cast("int").alias("code"), "n")


def encode_levels(df: DataFrame, col: str, levels: DataFrame, out: str, unknown: int | None = None) -> DataFrame:
    """Code of each value; unseen or null values get `unknown`."""
    codes = levels.select(F.col("level").alias("__k"), F.col("code").alias("__lv"))
    joined = df.join(codes, F.col(col) == F.col("__k"), "left")
    code = F.col("__lv") if unknown is None else F.coalesce("__lv", F.lit(unknown))
    return joined.withColumn(out, code).drop("__k", "__lv")


def decode_levels(df: DataFrame, col: str, levels: DataFrame, out: str) -> DataFrame:
    values = levels.select(F.col("code").alias("__k"), F.col("level").alias("__level"))
    return df.join(values, F.col(col) == F.col("__k"), "left").withColumn(out, F.col("__level")).drop("__k", "__level")
