"""Splits and folds. Membership is a function of a row's key, so it does not change with partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.cols import as_list
from ..functions.hashing import hash_cell, portable_hash, unit_draw
from ..functions.ordered import cell_count, number_rows


def assign_split(df: DataFrame, weights, seed, key, out: str = "part") -> DataFrame:
    """Part number 0, 1, … by cumulative weight."""
    u, total, edge = unit_draw(seed, *as_list(key)), float(sum(weights)), 0.0
    part = F.lit(len(weights) - 1)
    edges = []
    for w in weights[:-1]:
        edge += w / total
        edges.append(edge)
    for i in reversed(range(len(edges))):
        part = F.when(u < edges[i], i).otherwise(part)
    return df.withColumn(out, part)


def split(df: DataFrame, weights, seed, key) -> list[DataFrame]:
    parts = assign_split(df, weights, seed, key, "__part")
    return [parts.where(F.col("__part") == i).drop("__part") for i in range(len(weights))]


def _hash_positions(df: DataFrame, label: str, seed, key) -> DataFrame:
    hashed = df.withColumn("__h", portable_hash(seed, *as_list(key)))
    cell = hash_cell(F.col("__h"), cell_count(df))
    return number_rows(hashed, ["__h", *as_list(key)], [label], out="__pos", total="__n", cell=cell)


def stratified_split(df: DataFrame, label: str, fraction: float, seed, key, out: str = "is_train") -> DataFrame:
    """The first ceil(n * fraction) rows of each class in hash order are the training rows."""
    rows = _hash_positions(df, label, seed, key)
    return rows.withColumn(out, F.col("__pos") < F.ceil(F.col("__n") * F.lit(fraction))).drop("__h", "__pos", "__n")


def head_split(df: DataFrame, order, fraction: float, out: str = "is_train") -> DataFrame:
    """The first share of the rows along an order."""
    rows = number_rows(df, order, out="__pos", total="__n")
    return rows.withColumn(out, F.col("__pos") < F.floor(F.col("__n") * F.lit(fraction))).drop("__pos", "__n")


def time_split(df: DataFrame, time: str, at: str) -> tuple[DataFrame, DataFrame]:
    t = F.lit(at).cast(df.schema[time].dataType)
    return df.where(F.col(time) < t), df.where(F.col(time) >= t)


def kfold(df: DataFrame, k: int, seed, key, out: str = "fold") -> DataFrame:
    return df.withColumn(out, (portable_hash(seed, *as_list(key)) % k).cast("int"))


def stratified_kfold(df: DataFrame, label: str, k: int, seed, key, out: str = "fold") -> DataFrame:
    """Folds whose class counts differ by at most one."""
    rows = _hash_positions(df, label, seed, key)
    return rows.withColumn(out, (F.col("__pos") % k).cast("int")).drop("__h", "__pos", "__n")


def split_by_flag(df: DataFrame, col: str, train_value) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(col) == train_value).drop(col), df.where(F.col(col) != train_value).drop(col)
