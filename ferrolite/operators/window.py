"""Ordered operators: moving and running values, top-k, sampling, trial curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.cols import as_list, dbl, r, union_all, with_row
from ..functions.hashing import portable_hash, unit_draw
from ..functions.ordered import framed, keys_of, next_valid, number_rows, running


def rolling_mean(df: DataFrame, order, value: str, n: int, out: str = "rolling", group=()) -> DataFrame:
    """Mean of the last n values, null until n rows exist or while one of them is null."""
    pos = number_rows(df, order, group, out="__pos")

    def columns(w):
        last = w.rowsBetween(-(n - 1), 0)
        return {out: F.when(F.count(value).over(last) == n, F.avg(value).over(last))}

    return framed(pos, "__pos", columns, group, before=n - 1).drop("__pos")


def back_fill(df: DataFrame, order, value: str, out: str | None = None, group=()) -> DataFrame:
    filled = next_valid(df, order, value, "__filled", group)
    return filled.withColumn(out or value, F.col("__filled")).drop("__filled")


def top_k_per_group(df: DataFrame, group, by, k: int, rank: str | None = None) -> DataFrame:
    """k first rows of each group; the row_number filter lets Spark cut to k per task before the shuffle."""
    w = Window.partitionBy(*as_list(group)).orderBy(*[key.sort() for key in keys_of(by)])
    out = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
    return out.withColumnRenamed("__rn", rank) if rank else out.drop("__rn")


def best_row(df: DataFrame, by) -> DataFrame:
    return df.orderBy(*[k.sort() for k in keys_of(by)]).limit(1)


def rank_trials(df: DataFrame, loss: str = "loss", tie: str = "number") -> DataFrame:
    """Position by rising loss, from 0."""
    return number_rows(df, [loss, tie], out="rank")


def sort_by(df: DataFrame, by, limit: int | None = None) -> DataFrame:
    out = df.orderBy(*[k.sort() for k in keys_of(by)])
    return out.limit(limit) if limit is not None else out


def shuffle_sample(df: DataFrame, n: int, seed, key) -> DataFrame:
    """n rows in a random order that depends only on the keys."""
    h = portable_hash(seed, *as_list(key))
    return df.withColumn("__h", h).orderBy("__h", *as_list(key)).limit(n).drop("__h")


def sample(df: DataFrame, fraction: float, seed, key) -> DataFrame:
    return df.where(unit_draw(seed, *as_list(key)) < fraction)


def union_labelled(a: DataFrame, b: DataFrame, label: str, label_a, label_b) -> DataFrame:
    return a.withColumn(label, F.lit(label_a)).unionByName(b.withColumn(label, F.lit(label_b)))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def best_so_far(trials: DataFrame, order: str = "number", loss: str = "loss", group=()) -> DataFrame:
    return running(trials, order, group, minima={"best_so_far": F.col(loss)})


def explode_params(trials: DataFrame, names, params: str = "params") -> DataFrame:
    """Parameter map to one column per name."""
    return trials.select("*", *[F.try_element_at(params, F.lit(n)).alias(n) for n in as_list(names)]).drop(params)


def label_series(**histories: DataFrame) -> DataFrame:
    """Stack histories with a `search` tag."""
    return union_all([df.withColumn("search", F.lit(name)) for name, df in histories.items()])


def trend(trials: DataFrame, value: str, order: str = "number", group=()) -> DataFrame:
    """Least-squares line of a value against the iteration."""
    return trials.groupBy(*as_list(group)).agg(r(F.regr_slope(dbl(value), dbl(order)), 9).alias("slope"),
                                               r(F.regr_intercept(dbl(value), dbl(order))).alias("intercept"))
