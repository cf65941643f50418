"""Profiling and statistics. Every operator is one or two aggregations; nothing row-sized reaches the driver."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest, Summarizer
from pyspark.sql import DataFrame, functions as F

from ..functions.cols import as_list, dbl, div, numeric_columns, r, same_keys, string_columns, with_row
from ..functions.ordered import running
from ..functions.quantiles import quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
TAILS = {"p0_5": 0.005, "p1": 0.01, "p5": 0.05, "p95": 0.95, "p99": 0.99, "p99_5": 0.995}


def _wide_to_long(df: DataFrame, cols, aggs: dict) -> DataFrame:
    """One scan with per-column aggregates, then one row per column."""
    flat = df.agg(*[fn(c).alias(f"{c}\u0001{name}") for c in cols for name, fn in aggs.items()])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}\u0001{name}`").alias(name) for name in aggs]) for c in cols]
    return flat.select(F.inline(F.array(*rows)))


def summarize(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """Per numeric column: counts, missing, distinct, extremes, quartiles, moments and tail percentiles."""
    cols = as_list(cols) or numeric_columns(df)
    base = _wide_to_long(df, cols, {
        "count": lambda c: F.count(c),
        "missing": lambda c: F.count(F.when(F.col(c).isNull(), 1)),
        "min": lambda c: F.min(dbl(c)), "max": lambda c: F.max(dbl(c)), "mean": lambda c: F.avg(dbl(c)),
        "variance": lambda c: F.var_samp(dbl(c)), "sd": lambda c: F.stddev_samp(dbl(c)),
        "skewness": lambda c: F.skewness(dbl(c)), "kurtosis": lambda c: F.kurtosis(dbl(c))})
    qs = quantiles(df, cols, {**QUARTILES, **TAILS}, distinct="distinct")
    out = base.join(qs, "column", "left")
    ints = ["count", "missing", "distinct"]
    return out.select("column", *ints, *[r(F.col(c), digits).alias(c) for c in out.columns if c not in ["column", *ints]])


def describe(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """count/mean/sd/min/quartiles/max for numbers, distinct/top/freq for strings (ties: smallest value)."""
    cols = as_list(cols) or df.columns
    nums = [c for c in numeric_columns(df) if c in cols]
    texts = [c for c in string_columns(df) if c in cols]
    frames = []
    if nums:
        base = _wide_to_long(df, nums, {
            "count": lambda c: F.count(c), "mean": lambda c: r(F.avg(dbl(c)), digits),
            "sd": lambda c: r(F.stddev_samp(dbl(c)), digits), "min": lambda c: F.min(dbl(c)),
            "max": lambda c: F.max(dbl(c))})
        qs = quantiles(df, nums, QUARTILES)
        qs = qs.select("column", *[r(F.col(q), digits).alias(q) for q in QUARTILES])
        frames.append(base.join(qs, "column", "left"))
    if texts:
        counts = value_counts_long(df, texts)
        frames.append(counts.groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("distinct"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def value_counts_long(df: DataFrame, cols, group=()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in as_list(cols)])
    return (df.select(*as_list(group), F.inline(pairs)).where("value IS NOT NULL")
            .groupBy(*as_list(group), "column", "value").agg(F.count(F.lit(1)).alias("n")))


def compare(first: DataFrame, second: DataFrame, cols=None) -> DataFrame:
    """Two frames side by side: counts, missing, means and the shift in standard deviations of the first."""
    cols = as_list(cols) or [c for c in numeric_columns(first) if c in second.columns]
    stats = {"count": lambda c: F.count(c), "missing": lambda c: F.count(F.when(F.col(c).isNull(), 1)),
             "mean": lambda c: F.avg(dbl(c)), "sd": lambda c: F.stddev_samp(dbl(c))}
    a = _wide_to_long(first, cols, stats).toDF("column", *[f"{s}_1" for s in stats])
    b = _wide_to_long(second, cols, stats).toDF("column", *[f"{s}_2" for s in stats])
    both = a.join(b, "column", "full")
    shift = div(F.col("mean_2") - F.col("mean_1"), F.col("sd_1"))
    return both.select("column", "count_1", "count_2", "missing_1", "missing_2", r(F.col("mean_1")).alias("mean_1"),
                       r(F.col("mean_2")).alias("mean_2"), r(shift).alias("mean_shift"))


def compare_shares(first: DataFrame, second: DataFrame, cols) -> DataFrame:
    """Share of every category in both frames."""
    def shares(df, tag):
        n = df.agg(F.count(F.lit(1)).alias("__n"))
        counts = with_row(value_counts_long(df, cols), n)
        return counts.select("column", "value", (F.col("n") / F.col("__n")).alias(tag))
    both = shares(first, "share_1").join(shares(second, "share_2"), ["column", "value"], "full")
    return both.select("column", "value", *[r(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("share_1", "share_2")])


def association(df: DataFrame, target: str, numeric=(), categorical=()) -> DataFrame:
    """Strength of every column's relation to a numeric target: |Pearson| or the correlation ratio."""
    frames = []
    if numeric:
        frames.append(_wide_to_long(df, as_list(numeric), {"strength": lambda c: F.abs(F.corr(dbl(c), dbl(target)))})
                      .withColumn("measure", F.lit("pearson")))
    if categorical:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in as_list(categorical)])
        long = df.select(dbl(target).alias("y"), F.inline(pairs))
        groups = long.groupBy("column", "value").agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
        total = groups.groupBy("column").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
                                             F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
        centre = F.col("s") * F.col("s") / F.col("n")
        frames.append(total.select("column", F.sqrt(div(F.greatest(F.col("b") - centre, F.lit(0.0)), F.col("q") - centre)).alias("strength"),
                                   F.lit("correlation_ratio").alias("measure")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("column", "measure", r(F.col("strength")).alias("strength"))


def cramers_v(df: DataFrame, target: str, categorical) -> DataFrame:
    """Cramer's V of categorical columns with a categorical target; rows that lack either value do not count."""
    return _independence(df, categorical, target).select(
        "feature", r(F.sqrt(div(F.col("x2"), F.col("n") * F.least(F.col("rows") - 1, F.col("cols") - 1)))).alias("cramers_v"))


def chi_square(df: DataFrame, features, label: str) -> DataFrame:
    """Independence statistic and degrees of freedom per feature; rows that lack either value do not count."""
    return _independence(df, features, label).select(
        "feature", r(F.col("x2"), 5).alias("statistic"), ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("degrees"), "rows", "cols")


def _independence(df: DataFrame, features, label: str) -> DataFrame:
    """(feature, x2, n, rows, cols) from cell counts: n * (sum O^2 / (R*C) - 1)."""
    cells = value_counts_long(df.where(F.col(label).isNotNull()), features, group=[label])
    rows = cells.groupBy("column", "value").agg(F.sum("n").alias("__row"))
    cols = cells.groupBy("column", label).agg(F.sum("n").alias("__col"))
    sizes = cells.groupBy("column").agg(F.sum("n").alias("__n"), F.count_distinct("value").alias("rows"),
                                        F.count_distinct(label).alias("cols"))
    joined = same_keys(same_keys(cells, rows, ["column", "value"]), cols, ["column", label])
    parts = joined.groupBy("column").agg(F.sum(F.col("n").cast("double") * F.col("n") / (F.col("__row").cast("double") * F.col("__col"))).alias("__s"))
    return (parts.join(sizes, "column")
            .select(F.col("column").alias("feature"), (F.col("__n") * (F.col("__s") - 1)).alias("x2"), F.col("__n").alias("n"), "rows", "cols"))


def chi_square_test(df: DataFrame, features, label: str) -> DataFrame:
    """With p-values, by the library test over an assembled vector (numeric category codes)."""
    features = as_list(features)
    vec = VectorAssembler(inputCols=features, outputCol="__f").transform(df)
    res = ChiSquareTest.test(vec, "__f", label, flatten=True)
    names = F.array(*[F.lit(f) for f in features])
    return res.select(names[F.col("featureIndex")].alias("feature"), F.col("pValue").alias("p_value"),
                      F.col("degreesOfFreedom").cast("long").alias("degrees"), F.col("statistic"))


def average_ranks(df: DataFrame, col: str, out: str, weight: str | None = None) -> DataFrame:
    """(value, rank): 1-based rank with ties averaged, from counts of equal values."""
    w = F.col(weight) if weight else F.lit(1)
    rows = df.where(F.col(col).isNotNull()).withColumn("__value", F.col(col))
    counts = rows.groupBy("__value").agg(F.sum(w).alias("__n"))
    cum = running(counts, "__value", sums={"__cum": F.col("__n")}, bounds_from=rows)
    return cum.select("__value", (F.col("__cum") - (F.col("__n") - 1) / F.lit(2.0)).alias(out))


def corr_matrix(df: DataFrame, cols, method: str = "pearson") -> DataFrame:
    """Long correlation matrix (a <= b); Spearman is Pearson on average ranks."""
    cols = as_list(cols)
    df = df.select(*cols).dropna()
    if method == "spearman":
        values = df  # ranks come from the values each time, so the plan grows with the number of columns only
        for c in cols:
            ranks = average_ranks(values, c, "__rank")
            df = df.join(ranks, F.col(c) == F.col("__value")).drop("__value", c).withColumnRenamed("__rank", c)
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(dbl(a), dbl(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r(F.col(f"c{i}")).alias("corr")) for i, (a, b) in enumerate(pairs)])))


def weighted_summary(df: DataFrame, cols, weight: str) -> DataFrame:
    """Weighted mean and count per column."""
    cols = as_list(cols)
    w = dbl(weight)
    row = df.agg(F.count(F.lit(1)).alias("__n"), F.sum(w).alias("__w"), *[F.sum(w * dbl(c)).alias(c) for c in cols])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("__n").alias("count"), r(F.col("__w"), 4).alias("weight_sum"),
                 r(F.col(c) / F.col("__w")).alias("mean")) for c in cols])))


def weighted_vector_summary(df: DataFrame, vec: str, weight: str) -> DataFrame:
    """The same over a vector column, by the library summarizer."""
    s = Summarizer.metrics("mean", "count").summary(F.col(vec), F.col(weight))
    return df.select(s.alias("s")).select("s.mean", "s.count")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts and shares per value; the total is a scalar, not a one-task window."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    return with_row(counts, total).select(col, "n", r(F.col("n") / F.col("__n")).alias("share"))


def distinct_counts(df: DataFrame, cols=None, approximate: float | None = None) -> DataFrame:
    cols = as_list(cols) or df.columns
    fn = (lambda c: F.approx_count_distinct(c, approximate)) if approximate else (lambda c: F.count_distinct(F.col(c)))
    return _wide_to_long(df, cols, {"distinct": fn})


def top_groups(df: DataFrame, key: str, k: int, most: bool = True) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n") if most else F.asc("n"), key).limit(k)


def describe_by(df: DataFrame, group, value: str, digits: int = 6) -> DataFrame:
    group = as_list(group)
    base = df.groupBy(*group).agg(F.count(value).alias("count"), r(F.avg(value), digits).alias("mean"),
                                  r(F.stddev_samp(value), digits).alias("sd"), F.min(dbl(value)).alias("min"), F.max(dbl(value)).alias("max"))
    qs = quantiles(df, value, QUARTILES, group).drop("column")
    qs = qs.select(*group, *[r(F.col(q), digits).alias(q) for q in QUARTILES])
    return same_keys(base, qs, group, "left")


def group_sum_mean(df: DataFrame, group, value, out: str = "value") -> DataFrame:
    return df.groupBy(*as_list(group)).agg(F.sum(value).alias(f"sum_{out}"), r(F.avg(value)).alias(f"mean_{out}"))


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Equal-width counts in [lo, hi]; the last bin is closed; values outside are left out."""
    x = dbl(col)
    bin_ = F.least(F.floor((x - lo) / F.lit((hi - lo) / bins)).cast("int"), F.lit(bins - 1))
    return (df.where((x >= lo) & (x <= hi)).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("left", r(F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins))))


def density(df: DataFrame, col: str, grid, bandwidth: float) -> DataFrame:
    """Gaussian kernel density at the given (bounded) grid points: one aggregate per point, one scan."""
    x = dbl(col)
    scale = 1.0 / (bandwidth * (2 * 3.141592653589793) ** 0.5)
    aggs = [F.avg(F.exp(-F.lit(0.5) * F.pow((F.lit(float(g)) - x) / bandwidth, 2)) * scale).alias(f"g{i}") for i, g in enumerate(grid)]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(float(g)).alias("x"), r(F.col(f"g{i}"), 9).alias("density")) for i, g in enumerate(grid)])))


def overall_max_row(df: DataFrame, by: str, tie: str) -> DataFrame:
    """The row that holds the overall maximum (ties: smallest key)."""
    cols = df.columns
    return df.agg(F.min_by(F.struct(*cols), F.struct(-dbl(by), F.col(tie))).alias("row")).select("row.*")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def dataset_metafeatures(df: DataFrame, label: str, numeric, categorical, group=()) -> DataFrame:
    """Rows, columns, classes, class entropy, missing share, mean skewness and kurtosis; one row per group."""
    group, numeric, categorical = as_list(group), as_list(numeric), as_list(categorical)
    k = len(numeric) + len(categorical)
    missing = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in numeric + categorical), F.lit(0))
    skew = sum((F.skewness(dbl(c)) for c in numeric), F.lit(0.0)) / max(len(numeric), 1)
    kurt = sum((F.kurtosis(dbl(c)) for c in numeric), F.lit(0.0)) / max(len(numeric), 1)
    base = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), r(F.sum(missing) / (F.count(F.lit(1)) * k)).alias("missing_share"),
                                  r(skew).alias("mean_skewness"), r(kurt).alias("mean_kurtosis"))
    classes = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("__c"))
    # entropy = ln N - sum(c ln c) / N needs the class counts only
    entropy = classes.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_classes"),
        r(F.ln(F.sum("__c")) - F.sum(F.col("__c") * F.ln("__c")) / F.sum("__c")).alias("class_entropy"))
    out = same_keys(base, entropy, group) if group else with_row(base, entropy)
    return out.withColumns({"n_numeric": F.lit(len(numeric)), "n_categorical": F.lit(len(categorical))})


def nearest_datasets(meta: DataFrame, key: str, target, features, k: int) -> DataFrame:
    """The k datasets most like the target by L1 distance of range-scaled meta-features (ties by key).

    The target is one row, attached as a scalar; its configuration donors can be joined by key.
    """
    features = as_list(features)
    ranges = meta.agg(*[(F.max(dbl(f)) - F.min(dbl(f))).alias(f"__w_{f}") for f in features])
    mine = meta.where(F.col(key) == target).agg(*[F.max(dbl(f)).alias(f"__t_{f}") for f in features])
    rows = with_row(with_row(meta.where(F.col(key) != target), ranges), mine)
    gap = sum((F.coalesce(div(F.abs(dbl(f) - F.col(f"__t_{f}")), F.col(f"__w_{f}")), F.lit(0.0)) for f in features), F.lit(0.0))
    return rows.select(key, r(gap, 9).alias("distance")).orderBy("distance", key).limit(k)
