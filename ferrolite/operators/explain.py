"""Feature selection and model explanation."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cols import as_list, dbl, div, r, same_keys, with_row
from ..functions.hashing import hash_cell, portable_hash
from ..functions.ordered import cells_for, number_rows
from ..functions.quantiles import quantiles, quantiles_long
from .profile import chi_square, corr_matrix, value_counts_long
from .search import _driver_unit

KEPT_ROWS = 0  # more rows are kept for a round; joining them again for each pass of a forest took longer at every size measured


def variances(df: DataFrame, cols) -> DataFrame:
    row = df.agg(*[F.var_pop(dbl(c)).alias(c) for c in as_list(cols)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("variance")) for c in as_list(cols)])))


def variance_filter(df: DataFrame, cols, threshold: float = 0.0) -> DataFrame:
    """Drop the columns whose variance is not above the threshold."""
    low = [row["column"] for row in variances(df, cols).where(F.col("variance") <= threshold).collect()]  # one row per column
    return df.drop(*low)


def anova_f(df: DataFrame, features, label: str) -> DataFrame:
    """F statistic of numeric features between the label's classes, from grouped sums."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), dbl(c).alias("x")) for c in as_list(features)])
    cells = df.select(label, F.inline(pairs)).groupBy("feature", label).agg(F.count("x").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    t = cells.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.count(F.lit(1)).alias("k"))
    between = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    within = F.col("q") - F.col("b")
    return t.select("feature", r(div(between / (F.col("k") - 1), within / (F.col("n") - F.col("k"))), 5).alias("score"))


def mutual_information(df: DataFrame, features, label: str) -> DataFrame:
    """Mutual information (nats) of categorical features with the label, from cell counts."""
    cells = value_counts_long(df, features, group=[label])
    rows = cells.groupBy("column", "value").agg(F.sum("n").alias("__r"))
    cols = cells.groupBy("column", label).agg(F.sum("n").alias("__c"))
    alls = cells.groupBy("column").agg(F.sum("n").alias("__n"))
    j = same_keys(same_keys(same_keys(cells, rows, ["column", "value"]), cols, ["column", label]), alls, "column")
    n = F.col("n").cast("double")
    part = n / F.col("__n") * F.ln(n * F.col("__n") / (F.col("__r").cast("double") * F.col("__c")))
    return j.groupBy("column").agg(r(F.sum(part)).alias("score")).withColumnRenamed("column", "feature")


def univariate_scores(df: DataFrame, features, label: str, score: str = "f") -> DataFrame:
    if score == "f":
        return anova_f(df, features, label)
    if score == "chi2":
        return chi_square(df, features, label).select("feature", F.col("statistic").alias("score"))
    if score == "mutual_information":
        return mutual_information(df, features, label)
    raise ValueError(f"unknown score {score!r}")


def select_univariate(df: DataFrame, features, label: str, score: str = "f", mode: str = "k_best", param=10) -> list[str]:
    """Names of the features kept: best k, best share (percentile), or by p-value (fpr)."""
    features = as_list(features)
    if mode == "fpr":
        vec = VectorAssembler(inputCols=features, outputCol="__f").transform(df)
        sel = UnivariateFeatureSelector(featuresCol="__f", labelCol=label, outputCol="__s", selectionMode="fpr")
        sel = sel.setFeatureType("categorical" if score == "chi2" else "continuous").setLabelType("categorical").setSelectionThreshold(param)
        return [features[i] for i in sel.fit(vec).selectedFeatures]
    k = int(param) if mode == "k_best" else max(1, int(len(features) * param / 100))
    best = univariate_scores(df, features, label, score).orderBy(F.desc("score"), "feature").limit(k)
    return [row["feature"] for row in best.collect()]  # at most one row per column


def _binomial_tail(hits: int, n: int) -> float:
    """P(X >= hits) for X ~ Binomial(n, 1/2)."""
    return sum(math.comb(n, i) for i in range(hits, n + 1)) / 2**n


def boruta(df: DataFrame, features, label: str, key, classify: bool = True, perc: float = 100, alpha: float = 0.05, max_iter: int = 20, trees: int = 20,
           depth: int = 5, seed: int = 1) -> DataFrame:
    """Shadow-feature selection: (feature, hits, decision, rank).

    Every round permutes all features against the label (two hash orders joined
    by position), fits a forest on features and shadows, and counts the
    features that beat the shadows' percentile. A two-sided binomial test with
    a Bonferroni correction confirms or rejects.
    """
    features = as_list(features)
    base = df.select(*as_list(key), label, *[dbl(c).alias(c) for c in features])
    n = df.count()
    n_cells = cells_for(n, df.sparkSession)

    def positions(frame, s):
        h = frame.withColumn("__h", portable_hash(s, *as_list(key)))
        return number_rows(h, ["__h", *as_list(key)], out="__pos", cell=hash_cell(F.col("__h"), n_cells)).drop("__h")

    rows = positions(base, f"{seed}:base").persist()
    hits, status, done, sums = {f: 0 for f in features}, {f: "tentative" for f in features}, 0, {f: 0.0 for f in features}
    make = RandomForestClassifier if classify else RandomForestRegressor
    try:
        for it in range(1, max_iter + 1):
            live = [f for f in features if status[f] != "rejected"]
            if not any(status[f] == "tentative" for f in live):
                break
            shadow = positions(base.select(*as_list(key), *live), f"{seed}:{it}").select("__pos", *[F.col(f).alias(f"__s_{f}") for f in live])
            both = rows.select("__pos", label, *live).join(shadow, "__pos")
            vec = VectorAssembler(inputCols=[*live, *[f"__s_{f}" for f in live]], outputCol="features").transform(both)
            vec = vec.select(label, "features")
            if n > KEPT_ROWS:  # a forest goes through its rows several times before it keeps them itself
                vec.persist()
            try:
                imp = make(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed + it).fit(vec).featureImportances.toArray()
            finally:
                vec.unpersist()
            bar = float(np.percentile(imp[len(live):], perc))
            done = it
            for i, f in enumerate(live):
                hits[f] += int(imp[i] > bar)
                sums[f] += float(imp[i])
                if status[f] == "tentative":
                    if _binomial_tail(hits[f], it) * len(features) <= alpha:
                        status[f] = "confirmed"
                    elif _binomial_tail(it - hits[f], it) * len(features) <= alpha:
                        status[f] = "rejected"
    finally:
        rows.unpersist()
    order = {"confirmed": 1, "tentative": 2, "rejected": 3}
    out = [(f, hits[f], done, status[f], order[status[f]], sums[f] / max(done, 1)) for f in features]
    return df.sparkSession.createDataFrame(out, "feature string, hits int, iterations int, decision string, rank int, mean_importance double")


def importances(df: DataFrame, model, names) -> DataFrame:
    """Ranked importances or absolute coefficients of a fitted model."""
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(np.asarray(model.coefficients.toArray()))
    rows = sorted(zip(names, map(float, values)), key=lambda p: (-p[1], p[0]))
    return df.sparkSession.createDataFrame([(i + 1, n, v) for i, (n, v) in enumerate(rows)], "rank int, feature string, importance double")


def select_by_model(df: DataFrame, model, names, threshold: float | str = "mean", keep=()) -> DataFrame:
    """Columns whose importance (or absolute weight) reaches the threshold."""
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(model.coefficients.toArray())
    bar = float(np.mean(values)) if threshold == "mean" else float(threshold)
    return df.select(*as_list(keep), *[n for n, v in zip(names, values) if v >= bar])


def feature_response(df: DataFrame, model, names, delta: float = 0.5, features: str = "features", digits: int = 6) -> DataFrame:
    """Change of the prediction when a feature moves by -/+ delta standard deviations: mean, mean and median absolute change.

    All shifted copies are scored in one job: one copy of a row per feature and direction.
    """
    names = as_list(names)
    base = df.select(features)
    sd = base.select(*[vector_to_array(features)[i].alias(f"f{i}") for i in range(len(names))])
    sd = sd.agg(*[F.stddev_samp(f"f{i}").alias(f"f{i}") for i in range(len(names))]).first()  # one number per feature
    steps = [(i, s, (sd[i] or 0.0) * delta * s) for i in range(len(names)) for s in (-1, 1)]
    scored = model.transform(base).select(vector_to_array(features).alias("__x"), F.col("prediction").alias("__base"))
    moves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("side"), F.lit(float(d)).alias("d")) for i, s, d in steps])
    copies = scored.withColumn("__m", F.explode(moves))
    moved = F.transform("__x", lambda x, j: F.when(j == F.col("__m.i"), x + F.col("__m.d")).otherwise(x))
    copies = model.transform(copies.withColumn(features, array_to_vector(moved)))
    change = copies.select(F.col("__m.i").alias("i"), F.col("__m.side").alias("side"), F.col("__m.d").alias("d"), (F.col("prediction") - F.col("__base")).alias("value"))
    stats = change.groupBy("i", "side").agg(F.max(F.abs("d")).alias("delta"), F.avg("value").alias("mean"), F.avg(F.abs("value")).alias("mean_abs"))
    med = quantiles_long(change.select("i", "side", F.abs("value").alias("value")), {"median_abs": 0.5}, ["i", "side"])
    label = F.array(*[F.lit(n) for n in names])[F.col("i")]
    return same_keys(stats, med, ["i", "side"]).select(label.alias("feature"), F.col("side").alias("direction"), *[r(F.col(c), digits).alias(c) for c in ("delta", "mean", "mean_abs", "median_abs")])


def pca(df: DataFrame, features: str, k: int, whiten: bool = False, out: str = "components") -> DataFrame:
    scored = PCA(k=k, inputCol=features, outputCol=out).fit(df).transform(df)
    if whiten:
        scaled = StandardScaler(withMean=True, withStd=True, inputCol=out, outputCol="__w").fit(scored).transform(scored)
        scored = scaled.drop(out).withColumnRenamed("__w", out)
    return scored


def _hashed_normal(*parts) -> float:
    u, v = _driver_unit(*parts, "u"), _driver_unit(*parts, "v")
    return math.sqrt(-2 * math.log(1 - u)) * math.cos(2 * math.pi * v)


def random_fourier(df: DataFrame, cols, gamma: float, n: int, seed=1, out: str = "rbf") -> DataFrame:
    """Random features of the RBF kernel exp(-gamma |x - y|^2): sqrt(2 / n) cos(w x + b), hashed weights."""
    cols = as_list(cols)
    parts = []
    for j in range(n):
        dot = F.lit(2 * math.pi * _driver_unit(seed, "b", j))
        for c in cols:
            dot = dot + dbl(c) * F.lit(math.sqrt(2 * gamma) * _hashed_normal(seed, j, c))
        parts.append(F.cos(dot) * math.sqrt(2 / n))
    return df.withColumn(out, F.array(*parts))


def nystroem(df: DataFrame, cols, gamma: float, n: int, key, seed=1, out: str = "rbf") -> DataFrame:
    """Kernel map through n landmark rows (a hash sample): k(x, L) K(L, L)^(-1/2)."""
    cols = as_list(cols)
    marks = df.select(*[dbl(c).alias(c) for c in cols], portable_hash(seed, *as_list(key)).alias("__h")).orderBy("__h").limit(n).drop("__h").toPandas().to_numpy()
    gram = np.exp(-gamma * ((marks[:, None, :] - marks[None, :, :]) ** 2).sum(-1))
    vals, vecs = np.linalg.eigh(gram)
    root = vecs @ np.diag(1 / np.sqrt(np.maximum(vals, 1e-12))) @ vecs.T
    kernel = [F.exp(-gamma * sum(((dbl(c) - F.lit(float(m[i]))) * (dbl(c) - F.lit(float(m[i]))) for i, c in enumerate(cols)), F.lit(0.0))) for m in marks]
    df = df.withColumn("__k", F.array(*kernel))
    mapped = [F.aggregate(F.zip_with("__k", F.array(*[F.lit(float(v)) for v in root[:, j]]), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x) for j in range(len(marks))]
    return df.withColumn(out, F.array(*mapped)).drop("__k")


def agglomerate(df: DataFrame, cols, threshold: float = 0.9, keep=()) -> tuple[DataFrame, list[list[str]]]:
    """Average the groups of columns linked by |correlation| >= threshold (the matrix is columns x columns)."""
    cols = as_list(cols)
    root = {c: c for c in cols}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for row in corr_matrix(df, cols).where(F.abs("corr") >= threshold).orderBy("a", "b").collect():
        a, b = find(row["a"]), find(row["b"])
        root[max(a, b)] = min(a, b)
    groups: dict[str, list[str]] = {}
    for c in cols:
        groups.setdefault(find(c), []).append(c)
    members = list(groups.values())
    return df.select(*as_list(keep), *[(sum((dbl(c) for c in g), F.lit(0.0)) / len(g)).alias("+".join(g)) for g in members]), members


def lime_text(df: DataFrame, model, key: str, text: str = "text", n: int = 30, pattern: str = r"[.!?]+\s*", seed: int = 1, positive: int = 1, ridge: float = 1.0) -> DataFrame:
    """(key, part_no, weight): how much each part of a text moves the model's probability.

    Each text is scored n times with hashed parts left out; a weighted ridge fit
    per text (in its n x n dual form, whatever the number of parts) gives the weights.
    """
    parts = F.filter(F.split(F.col(text), pattern), lambda s: s != "")
    rows = df.select(key, parts.alias("__parts")).withColumn("__draw", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    bit = lambda i: (F.col("__draw") == 0) | (F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("__draw"), i), F.lit(2)) == 0)
    rows = rows.withColumn("__mask", F.transform("__parts", lambda p, i: bit(i)))
    kept = F.transform(F.filter(F.arrays_zip("__parts", "__mask"), lambda z: z["__mask"]), lambda z: z["__parts"])
    scored = model.transform(rows.withColumn(text, F.array_join(kept, ". ")))
    draw = F.struct(F.transform("__mask", lambda b: b.cast("byte")).alias("mask"), vector_to_array("probability")[positive].alias("p"))
    texts = scored.groupBy(key).agg(F.collect_list(draw).alias("__d")).select(key, F.col("__d.mask").alias("mask"), F.col("__d.p").alias("p"))

    def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        w = np.exp(-((1 - x.mean(1)) ** 2) / 0.25)
        mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
        xs, ys = (x - mx) * np.sqrt(w)[:, None], (y - my) * np.sqrt(w)
        return xs.T @ np.linalg.solve(xs @ xs.T + ridge * np.eye(len(y)), ys)

    def fits(batches):
        for batch in batches:
            masks, scores = batch.column("mask"), batch.column("p")
            at, ends, bits = masks.offsets.to_numpy(), masks.values.offsets.to_numpy(), masks.values.values.to_numpy()
            begin, p = scores.offsets.to_numpy(), scores.values.to_numpy()
            found = []
            for i in range(len(masks)):
                width = set(np.diff(ends[at[i]:at[i + 1] + 1]))
                if len(width) != 1:
                    raise ValueError(f"texts of different lengths share a {key}")
                x = bits[ends[at[i]]:ends[at[i + 1]]].reshape(-1, max(*width, 1))
                found.append(fit(x.astype(float), p[begin[i]:begin[i + 1]]) if len(x) else np.zeros(0))
            sizes = [len(beta) for beta in found]
            owner = pa.array(np.repeat(np.arange(len(found)), sizes))
            part = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            yield pa.RecordBatch.from_arrays([batch.column(key).take(owner), pa.array(part, pa.int32()), pa.array(np.concatenate(found), pa.float64())], names=[key, "part_no", "weight"])

    return texts.mapInArrow(fits, f"{key} {df.schema[key].dataType.simpleString()}, part_no int, weight double")


def top_weight_parts(df: DataFrame, key: str, weight: str, percentile: float) -> DataFrame:
    """Parts whose weight is above the row's percentile."""
    bars = quantiles(df, weight, {"__bar": percentile / 100}, key).drop("column")
    return same_keys(df, bars, key).where(F.col(weight) > F.col("__bar")).drop("__bar")


def relevance_filter(tests: DataFrame, fdr: float, p: str = "p_value", feature: str = "feature") -> DataFrame:
    """Benjamini-Hochberg: keep every feature up to the largest p <= rank / m * fdr."""
    ranked = number_rows(tests, [p, feature], out="__pos", total="__m")
    passing = ranked.where(F.col(p) <= (F.col("__pos") + 1) / F.col("__m") * fdr).agg(F.max(p).alias("__cut"))
    return with_row(tests, passing).withColumn("relevant", F.coalesce(F.col(p) <= F.col("__cut"), F.lit(False))).drop("__cut")
