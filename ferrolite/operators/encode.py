"""Category encoders. Tables are learned by grouped sums on the training frame and joined onto any frame."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cols import as_list, dbl, div, with_row
from ..functions.hashing import portable_hash
from ..functions.ordered import running
from .levels import encode_levels, level_table


def index_categories(df: DataFrame, col: str, fit_on: DataFrame | None = None, out: str | None = None, unknown=None) -> DataFrame:
    return encode_levels(df, col, level_table(df if fit_on is None else fit_on, col), out or f"{col}_index", unknown)


def one_hot(df: DataFrame, index_col: str, drop_last: bool = True, out: str | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    out = out or f"{index_col}_vec"
    enc = OneHotEncoder(inputCols=[index_col], outputCols=[out], dropLast=drop_last, handleInvalid="error" if fit_on is None else "keep")
    return enc.fit(df if fit_on is None else fit_on).transform(df)


def label_encode(df: DataFrame, cols, fit_on: DataFrame | None = None) -> DataFrame:
    """Rank in the sorted distinct values, from 0."""
    source = df if fit_on is None else fit_on
    for c in as_list(cols):
        df = encode_levels(df, c, level_table(source, c, "value"), f"{c}_code")
    return df


def label_encode_scaled(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    levels = level_table(df, col, "value")
    coded = encode_levels(df, col, levels, "__code")
    return (with_row(coded, levels.agg(F.max("code").alias("__max")))
            .withColumn(out or f"{col}_scaled", div(F.col("__code"), F.col("__max"))).drop("__code", "__max"))


def multi_label_encode(df: DataFrame, cols, fit_on: DataFrame | None = None, unknown: int = -1) -> DataFrame:
    """Frequency codes for many columns in one stage; levels are learned from the given frame, not from what earlier columns added to it."""
    source = df if fit_on is None else fit_on
    for c in as_list(cols):
        df = index_categories(df, c, source, unknown=unknown)
    return df


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=as_list(cols), outputCol=out, handleInvalid="keep").transform(df)


def index_vector_categories(df: DataFrame, vec: str = "features", max_categories: int = 4, out: str = "indexed") -> DataFrame:
    return VectorIndexer(inputCol=vec, outputCol=out, maxCategories=max_categories, handleInvalid="keep").fit(df).transform(df)


def densify(df: DataFrame, vec: str, out: str = "dense") -> DataFrame:
    return df.withColumn(out, vector_to_array(vec))


def hash_features(df: DataFrame, cols, n: int, out: str = "features") -> DataFrame:
    return FeatureHasher(inputCols=as_list(cols), outputCol=out, numFeatures=n).transform(df)


def hash_features_portable(df: DataFrame, numeric, categorical, n: int, out: str = "hashed") -> DataFrame:
    """md5 feature hashing into n slots (dense array): numbers add their value, categories add 1."""
    numeric, categorical = as_list(numeric), as_list(categorical)
    fixed = {c: int(hashlib.md5(f"n|{c}".encode()).hexdigest()[:8], 16) % n for c in numeric}
    df = df.withColumns({f"__slot_{c}": (portable_hash("c", F.lit(c), c) % n).cast("int") for c in categorical})

    def slot(s: int) -> Column:
        value = sum((dbl(c) for c in numeric if fixed[c] == s), F.lit(0.0))
        return sum((F.when(F.col(f"__slot_{c}") == s, 1.0).otherwise(0.0) for c in categorical), value)

    return df.withColumn(out, F.array(*[slot(s) for s in range(n)])).drop(*[f"__slot_{c}" for c in categorical])


def leaf_encode(df: DataFrame, features: str, label: str | None, key: str, trees: int = 5, depth: int = 3, seed: int = 7, out: str = "leaf") -> DataFrame:
    """Leaf ids of a forest; without a label the forest splits on a hashed random target (unsupervised embedding)."""
    target = label or "__random"
    if label is None:
        df = df.withColumn("__random", (portable_hash(seed, key) % 2).cast("double"))
    model = RandomForestClassifier(featuresCol=features, labelCol=target, numTrees=trees, maxDepth=depth, seed=seed, leafCol="__leaf").fit(df)
    scored = model.transform(df).withColumn(out, vector_to_array("__leaf"))
    return scored.drop("__leaf", "rawPrediction", "probability", "prediction", "__random")


def ordinal(df: DataFrame, col: str, order=None, by: str | None = None, out: str | None = None) -> DataFrame:
    """1-based codes by an explicit order, else by first appearance along `by`; unknown is -1."""
    if order is not None:
        known = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)).cast("int")
        return df.withColumn(out or f"{col}_ordinal", F.when(known > 0, known).otherwise(-1))
    coded = encode_levels(df, col, level_table(df, col, "first_seen", by), "__code")
    return coded.withColumn(out or f"{col}_ordinal", F.coalesce(F.col("__code") + 1, F.lit(-1))).drop("__code")


def base_n_encode(df: DataFrame, col: str, base: int, by: str) -> DataFrame:
    """First-seen ordinal code written in base-n digits, highest digit first."""
    levels = level_table(df, col, "first_seen", by)
    count, digits = levels.count(), 1
    while base**digits <= count:
        digits += 1
    coded = encode_levels(df, col, levels, "__code")
    code = F.coalesce(F.col("__code") + 1, F.lit(0))
    out = {f"{col}_{i}": (F.floor(code / base ** (digits - 1 - i)) % base).cast("int") for i in range(digits)}
    return coded.withColumns(out).drop("__code")


def binary_encode(df: DataFrame, col: str, by: str) -> DataFrame:
    return base_n_encode(df, col, 2, by)


def hashing_encode(df: DataFrame, cols, n: int = 8) -> DataFrame:
    """How many of a row's categories fall into each of n hash buckets."""
    buckets = [(portable_hash("h", c) % n) for c in as_list(cols)]
    return df.withColumns({f"hash_{i}": sum(((b == i).cast("int") for b in buckets), F.lit(0)) for i in range(n)})


def _sums(train: DataFrame, col: str, y: str) -> DataFrame:
    return train.groupBy(F.col(col).alias("level")).agg(
        F.count(y).alias("n"), F.sum(dbl(y)).alias("s"), F.avg(dbl(y)).alias("m"), F.var_samp(dbl(y)).alias("v"))


def _prior(train: DataFrame, y: str) -> DataFrame:
    return train.agg(F.avg(dbl(y)).alias("prior"), F.var_samp(dbl(y)).alias("prior_var"))


def fit_target_table(train: DataFrame, col: str, y: str, method: str, smoothing: float = 1.0, min_leaf: int = 1, m: float = 1.0,
                     reg: float = 1.0) -> DataFrame:
    """(level, code, prior) for target, m_estimate, james_stein and woe encoders."""
    if method == "woe":
        pos, n = F.sum(dbl(y)), F.count(y)
        g = train.groupBy(F.col(col).alias("level")).agg(pos.alias("p"), (n - pos).alias("q"))
        g = with_row(g, train.agg(pos.alias("all_p"), (n - pos).alias("all_q")))
        code = F.ln(((F.col("p") + reg) / (F.col("all_p") + 2 * reg)) / ((F.col("q") + reg) / (F.col("all_q") + 2 * reg)))
        return g.select("level", code.alias("code"), F.lit(0.0).alias("prior"))
    g = with_row(_sums(train, col, y), _prior(train, y))
    if method == "target":
        weight = 1 / (1 + F.exp(-(F.col("n") - min_leaf) / F.lit(smoothing)))
        code = F.col("prior") * (1 - weight) + F.col("m") * weight
    elif method == "m_estimate":
        code = (F.col("s") + F.col("prior") * m) / (F.col("n") + m)
    elif method == "james_stein":
        # Shrink by the variance of the group mean against the overall variance.
        noise = F.coalesce(F.col("v"), F.col("prior_var")) / F.col("n")
        b = F.coalesce(div(noise, noise + F.col("prior_var")), F.lit(0.0))
        code = (1 - b) * F.col("m") + b * F.col("prior")
    else:
        raise ValueError(f"unknown method {method!r}")
    return g.select("level", code.alias("code"), "prior")


def apply_target_table(df: DataFrame, col: str, table: DataFrame, out: str) -> DataFrame:
    """Unseen levels get the prior."""
    codes = table.select(F.col("level").alias("__k"), F.col("code").alias("__code"))
    joined = df.join(codes, F.col(col).eqNullSafe(F.col("__k")), "left")
    joined = with_row(joined, table.agg(F.max("prior").alias("__prior")))
    return joined.withColumn(out, F.coalesce("__code", "__prior")).drop("__k", "__code", "__prior")


def target_family_encode(df: DataFrame, col: str, y: str, method: str, fit_on: DataFrame | None = None, out: str | None = None, **kw) -> DataFrame:
    table = fit_target_table(df if fit_on is None else fit_on, col, y, method, **kw)
    return apply_target_table(df, col, table, out or f"{col}_{method}")


def leave_one_out_encode(df: DataFrame, col: str, y: str, out: str | None = None) -> DataFrame:
    """Training rows: mean of the other rows of the level; a lone row gets the overall mean."""
    sums = _sums(df, col, y).select(F.col("level").alias("__k"), "n", "s")
    joined = with_row(df.join(sums, F.col(col).eqNullSafe(F.col("__k")), "left"), _prior(df, y).select("prior"))
    code = F.when(F.col("n") > 1, (F.col("s") - dbl(y)) / (F.col("n") - 1)).otherwise(F.col("prior"))
    return joined.withColumn(out or f"{col}_loo", code).drop("__k", "n", "s", "prior")


def catboost_encode(df: DataFrame, col: str, y: str, order, a: float = 1.0, out: str | None = None) -> DataFrame:
    """Training rows: mean of the earlier rows of the level, with `a` rows of prior."""
    rows = running(df, order, col, sums={"__s": dbl(y), "__n": F.lit(1)})
    rows = with_row(rows, _prior(df, y).select("prior"))
    code = (F.col("__s") - dbl(y) + F.col("prior") * a) / (F.col("__n") - 1 + a)
    return rows.withColumn(out or f"{col}_catboost", code).drop("__s", "__n", "prior")


def contrast_matrix(k: int, kind: str) -> np.ndarray:
    """k x (k - 1) coding of k levels."""
    i, j = np.arange(k)[:, None], np.arange(k - 1)[None, :]
    if kind == "sum":
        return np.where(i == k - 1, -1.0, (i == j).astype(float))
    if kind == "helmert":
        return np.where(i <= j, -1.0, np.where(i == j + 1, j + 1.0, 0.0))
    if kind == "backward_difference":
        return np.where(i <= j, -(k - 1.0 - j) / k, (j + 1.0) / k)
    if kind == "polynomial":
        x = np.arange(k) - (k - 1) / 2
        q, upper = np.linalg.qr(np.vander(x, k, increasing=True))
        return (q * np.sign(np.diag(upper)))[:, 1:]
    raise ValueError(f"unknown contrast {kind!r}")


def contrast_encode(df: DataFrame, col: str, kind: str, max_levels: int = 64) -> DataFrame:
    """k - 1 contrast columns of the value-ordered levels. k columns only make sense for few levels; more raise."""
    levels = level_table(df, col, "value")
    k = levels.count()
    if k > max_levels:
        raise ValueError(f"{col} has {k} levels; contrast coding adds one column per level")
    matrix = contrast_matrix(k, kind)
    coded = encode_levels(df, col, levels, "__code")

    def column(j: int) -> Column:
        return F.array(*[F.lit(float(v)) for v in matrix[:, j]])[F.col("__code")]

    return coded.withColumns({f"{col}_{kind}_{j}": column(j) for j in range(k - 1)}).drop("__code")
