"""Cleaning, scaling and numeric transforms. `fit_*` learns a few numbers on the training frame, `apply_*` uses them anywhere."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cols import as_list, dbl, div, same_keys, with_row
from ..functions.hashing import unit_draw
from ..functions.ordered import number_rows, running
from ..functions.quantiles import quantiles


def _one_row(df: DataFrame, aggs: dict[str, Column]) -> dict:
    """Fitted scalars; their number is the number of columns, never of rows."""
    return df.agg(*[c.alias(k) for k, c in aggs.items()]).first().asDict()


def _quantile_dict(df: DataFrame, cols, probs: dict[str, float]) -> dict[str, dict[str, float]]:
    return {row["column"]: row.asDict() for row in quantiles(df, cols, probs).collect()}  # one row per column


def fit_clean(df: DataFrame, cols, mode: str = "mean", value=None) -> dict[str, float]:
    cols = as_list(cols)
    if mode == "mean":
        return _one_row(df, {c: F.avg(dbl(c)) for c in cols})
    if mode == "median":
        return {c: q["m"] for c, q in _quantile_dict(df, cols, {"m": 0.5}).items()}
    if mode == "custom":
        return {c: value for c in cols}
    raise ValueError(f"unknown cleaning mode {mode!r}")


def apply_clean(df: DataFrame, fitted: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fitted.items()})


def clean_missing(df: DataFrame, cols, mode: str = "mean", value=None, fit_on: DataFrame | None = None) -> DataFrame:
    return apply_clean(df, fit_clean(df if fit_on is None else fit_on, cols, mode, value))


def fit_scale(df: DataFrame, cols, kind: str = "standard") -> dict[str, tuple[float, float]]:
    """(shift, factor) per column: scaled = (x - shift) / factor; a zero factor becomes 1."""
    cols = as_list(cols)
    if kind == "robust":
        q = _quantile_dict(df, cols, {"lo": 0.25, "m": 0.5, "hi": 0.75})
        raw = {c: (q[c]["m"], q[c]["hi"] - q[c]["lo"]) for c in cols}
    else:
        fns = {"standard": lambda c: (F.avg(dbl(c)), F.stddev_pop(dbl(c))),
               "minmax": lambda c: (F.min(dbl(c)), F.max(dbl(c)) - F.min(dbl(c))),
               "maxabs": lambda c: (F.lit(0.0), F.max(F.abs(dbl(c))))}[kind]
        row = _one_row(df, {f"{c}\u0001{i}": e for c in cols for i, e in enumerate(fns(c))})
        raw = {c: (row[f"{c}\u00010"], row[f"{c}\u00011"]) for c in cols}
    return {c: (s, f or 1.0) for c, (s, f) in raw.items()}


def apply_scale(df: DataFrame, fitted: dict) -> DataFrame:
    return df.withColumns({c: (dbl(c) - F.lit(s)) / F.lit(f) for c, (s, f) in fitted.items()})


def scale(df: DataFrame, cols, kind: str = "standard", fit_on: DataFrame | None = None) -> DataFrame:
    return apply_scale(df, fit_scale(df if fit_on is None else fit_on, cols, kind))


def normalize_rows(df: DataFrame, vec: str, p: float = 2.0, out: str | None = None) -> DataFrame:
    """Unit p-norm per array; a zero row stays zero."""
    x = F.transform(vec, lambda v: v.cast("double"))
    norm = F.pow(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(F.abs(v), F.lit(p))), F.lit(1.0 / p))
    tmp = df.withColumn("__norm", norm)
    return tmp.withColumn(out or vec, F.when(F.col("__norm") == 0, x).otherwise(F.transform(x, lambda v: v / F.col("__norm")))).drop("__norm")


def quantile_transform(df: DataFrame, col: str, out: str = "uniform") -> DataFrame:
    """Empirical CDF of each value (share of rows at or below it), exact with ties."""
    rows = df.where(F.col(col).isNotNull()).select(F.col(col).alias("__value"))
    counts = rows.groupBy("__value").agg(F.count(F.lit(1)).alias("__n"))
    cdf = with_row(running(counts, "__value", sums={"__cum": F.col("__n")}, bounds_from=rows), df.agg(F.count(col).alias("__all")))
    cdf = cdf.select("__value", (F.col("__cum") / F.col("__all")).alias(out))
    return df.join(cdf, F.col(col) == F.col("__value"), "left").drop("__value")


def quantile_transform_sketch(df: DataFrame, col: str, fit_on: DataFrame, n: int = 1000, out: str = "uniform") -> DataFrame:
    """The same from a bounded quantile sketch of the training frame; applies to unseen values."""
    bounds = fit_on.agg(F.percentile_approx(dbl(col), [i / n for i in range(1, n)], 10 * n)).first()[0]
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    binned = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep").transform(df.withColumn("__x", dbl(col)))
    return binned.withColumn(out, F.col("__b") / float(len(splits) - 2 or 1)).drop("__x", "__b")


# Coefficients of Acklam's rational approximation of the inverse normal CDF.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def inverse_normal(p: Column) -> Column:
    q = p - 0.5
    tail = F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    low = _poly(_C, tail) / _poly(_D, tail)
    return (F.when(p < 0.02425, low).when(p > 1 - 0.02425, -low)
            .otherwise(_poly(_A, q * q) * q / _poly(_B, q * q)))


def gauss_rank(df: DataFrame, col: str, key, out: str = "gauss") -> DataFrame:
    """Rank to normal scores: inverse normal of (position + 1/2) / n."""
    rows = number_rows(df, [col, *as_list(key)], out="__pos", total="__n")
    return rows.withColumn(out, inverse_normal((F.col("__pos") + 0.5) / F.col("__n"))).drop("__pos", "__n")


def bin_quantiles(df: DataFrame, cols, k: int, key) -> DataFrame:
    """k equally filled bins (1-based, like ntile) for several columns; each column's cells are counted on the given frame."""
    given = df
    for c in as_list(cols):
        order = [c, *as_list(key)]
        df = number_rows(df, order, out="__pos", total="__n", sizes_from=given.select(*dict.fromkeys(order)))
        n, pos = F.col("__n"), F.col("__pos")
        q, rem = F.floor(n / k), n % k
        bin_ = F.when(pos < rem * (q + 1), F.floor(pos / (q + 1))).otherwise(rem + F.floor((pos - rem * (q + 1)) / F.greatest(q, F.lit(1))))
        df = df.withColumn(f"{c}_bin", (bin_ + 1).cast("int")).drop("__pos", "__n")
    return df


def polynomial_features(df: DataFrame, cols, degree: int = 2, interaction_only: bool = False, bias: bool = False) -> DataFrame:
    """Products of columns up to a degree, named like `a^2` and `a b`."""
    pick = combinations if interaction_only else combinations_with_replacement
    out = {"1": F.lit(1.0)} if bias else {}
    for d in range(2, degree + 1):
        for combo in pick(as_list(cols), d):
            name = " ".join(c if combo.count(c) == 1 else f"{c}^{combo.count(c)}" for c in dict.fromkeys(combo))
            prod = dbl(combo[0])
            for c in combo[1:]:
                prod = prod * dbl(c)
            out[name] = prod
    return df.withColumns(out)


def log_label(df: DataFrame, col: str, out: str = "log_label") -> DataFrame:
    return df.withColumn(out, F.ln(col))


def exp_label(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    return df.withColumn(out, F.exp(col))


def date_features(df: DataFrame, col: str) -> DataFrame:
    hour = F.hour(col)
    part = F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
    return df.withColumns({f"{col}_month": F.month(col), f"{col}_weekday": F.weekday(col), f"{col}_hour": hour, f"{col}_part": part})


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes * class size) per row."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    sizes = with_row(sizes, sizes.agg(F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__k")))
    sizes = sizes.select(label, (F.col("__n") / (F.col("__k") * F.col("__c"))).alias(out))
    return same_keys(df, sizes, label, "left")


def oversample(df: DataFrame, label: str, seed, key, chunk: int = 1024) -> DataFrame:
    """Repeat rows of small classes until each class has about the size of the largest; `copy` numbers the repeats.

    Where a row needs more than `chunk` copies, its copies are made in chunks spread over the tasks.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    sizes = with_row(sizes, sizes.agg(F.max("__c").alias("__max"))).select(label, (F.col("__max") / F.col("__c")).alias("__ratio"))
    most = sizes.agg(F.max("__ratio")).first()[0] or 1.0
    rows = same_keys(df, sizes, label)
    whole = F.floor("__ratio")
    copies = whole + (unit_draw(seed, *as_list(key)) < F.col("__ratio") - whole).cast("int")
    rows = rows.withColumn("__copies", copies.cast("long")).drop("__ratio")
    if most <= chunk:
        return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).drop("__copies")
    rows = rows.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / chunk))))
    rows = rows.repartition(*as_list(key), "__chunk")
    last = F.least(F.col("__copies"), (F.col("__chunk") + 1) * chunk)
    return rows.withColumn("copy", F.explode(F.sequence(F.col("__chunk") * chunk + 1, last))).drop("__copies", "__chunk")


def array_to_unit_rows(df: DataFrame, nested: str, out: str = "flat", levels: int = 1) -> DataFrame:
    """Nested numeric arrays (height x width x channel) to one flat array per row."""
    flat = F.col(nested)
    for _ in range(levels):
        flat = F.flatten(flat)
    return df.withColumn(out, F.transform(flat, lambda v: v.cast("double")))
