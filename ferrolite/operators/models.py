"""Typed wrappers on Spark ML, plus the model-side operators Spark lacks.

Preprocessing lives inside pipelines, so it is fitted on the training frame
only. Parameters that are None are left out, so an estimator keeps its default.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as C, regression as R
from pyspark.ml.feature import FeatureHasher, HashingTF, Imputer, OneHotEncoder, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.cols import NUMERIC, as_list, dbl, r, require, skew_safe_lookup, union_all, with_row
from .evaluate import CLIP
from .split import kfold, stratified_kfold

CLASSIFIERS = {
    "logistic": C.LogisticRegression, "decision_tree": C.DecisionTreeClassifier, "random_forest": C.RandomForestClassifier, "gbt": C.GBTClassifier,
    "naive_bayes": C.NaiveBayes, "svm": C.LinearSVC, "mlp": C.MultilayerPerceptronClassifier, "fm": C.FMClassifier}
REGRESSORS = {
    "linear": R.LinearRegression, "tree_reg": R.DecisionTreeRegressor, "forest_reg": R.RandomForestRegressor, "gbt_reg": R.GBTRegressor,
    "glm": R.GeneralizedLinearRegression, "isotonic": R.IsotonicRegression, "aft": R.AFTSurvivalRegression, "fm_reg": R.FMRegressor,
    "ridge": lambda **kw: R.LinearRegression(elasticNetParam=0.0, **kw)}
# Search spaces name tree counts the forest way; boosted trees call them iterations.
RENAMED = {"gbt": {"numTrees": "maxIter"}, "gbt_reg": {"numTrees": "maxIter"}}
SENT_WEIGHTS = 10_000


def estimator(kind: str, features: str = "features", label: str = "label", **params) -> Estimator:
    """Unconfigured or configured estimator by name; unknown names fail before any job runs."""
    make = CLASSIFIERS.get(kind) or REGRESSORS.get(kind)
    if make is None:
        raise ValueError(f"unknown model {kind!r}; known: {sorted([*CLASSIFIERS, *REGRESSORS])}")
    renamed = {RENAMED.get(kind, {}).get(k, k): v for k, v in params.items() if v is not None}
    return make(featuresCol=features, labelCol=label, **renamed)


def fit(kind: str, df: DataFrame, features: str = "features", label: str = "label", **params):
    require(df, features, label)
    return estimator(kind, features, label, **params).fit(df)


def fit_one_vs_rest(kind: str, df: DataFrame, features: str = "features", label: str = "label", parallelism: int = 4, **params) -> C.OneVsRestModel:
    """k binary fits side by side on one cached frame, one for each class 0 .. k - 1; the class with the largest margin wins, the lowest of equal ones."""
    require(df, features, label)
    return C.OneVsRest(classifier=estimator(kind, features, label, **params), featuresCol=features, labelCol=label, parallelism=parallelism).fit(df)


def score(df: DataFrame, model) -> DataFrame:
    return model.transform(df)


def fit_quantile(df: DataFrame, alpha: float, features: str = "features", label: str = "label", max_iter: int = 15, tol: float = 1e-4,
                 eps: float | None = None, reg: float = 0.0):
    """Conditional quantile by reweighted least squares: weight = alpha or 1 - alpha over |residual|."""
    data = df.select(features, dbl(label).alias(label)).persist()
    try:
        if eps is None:
            eps = 1e-3 * (data.agg(F.stddev_pop(label)).first()[0] or 1.0)
        model, last = R.LinearRegression(featuresCol=features, labelCol=label, regParam=reg).fit(data), None
        for _ in range(max_iter):
            res = F.col(label) - F.col("prediction")
            weight = F.when(res >= 0, alpha).otherwise(1 - alpha) / F.greatest(F.abs(res), F.lit(eps))
            rows = model.transform(data).withColumn("__w", weight).drop("prediction")
            model = R.LinearRegression(featuresCol=features, labelCol=label, weightCol="__w", regParam=reg).fit(rows)
            now = np.append(model.coefficients.toArray(), model.intercept)
            if last is not None and np.max(np.abs(now - last)) <= tol * (1 + np.max(np.abs(last))):
                break
            last = now
        return model
    finally:
        data.unpersist()


def hashed_linear(cols, label: str, n: int = 1 << 12, loss: str = "logistic", passes: int = 20, reg: float = 0.0) -> Pipeline:
    """Hashed features and a linear learner: logistic, hinge or squared loss."""
    learner = {"logistic": lambda: C.LogisticRegression(featuresCol="__hashed", labelCol=label, maxIter=passes, regParam=reg),
               "hinge": lambda: C.LinearSVC(featuresCol="__hashed", labelCol=label, maxIter=passes, regParam=reg),
               "squared": lambda: R.LinearRegression(featuresCol="__hashed", labelCol=label, maxIter=passes, regParam=reg)}[loss]()
    return Pipeline(stages=[FeatureHasher(inputCols=as_list(cols), outputCol="__hashed", numFeatures=n), learner])


def bernoulli_counts(df: DataFrame, flags, label: str) -> DataFrame:
    """(label, feature, n, ones, log_p): the counts a Bernoulli naive Bayes needs, with add-one smoothing."""
    flags = as_list(flags)
    sums = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in flags])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("ones")) for c in flags])
    long = sums.select(label, "n", F.inline(rows))
    return long.withColumn("log_p", r(F.ln((F.col("ones") + 1) / (F.col("n") + 2))))


def featurizer(df: DataFrame, label: str, exclude=(), num_features: int = 1 << 10, max_levels: int = 100, text_words: int = 3, out: str = "features") -> Pipeline:
    """Stages chosen by schema: numbers imputed, few-level strings one-hot, many-level strings hashed, prose tokenized and hashed.

    One aggregation over the training frame decides; level lists are only
    learned for columns whose distinct count is known to be small.
    """
    skip = {label, *as_list(exclude)}
    fields = [f for f in df.schema.fields if f.name not in skip]
    nums = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    few, many, prose = [], [], []
    if texts:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"{c}\u0001n") for c in texts], *[F.avg(F.size(F.split(c, r"\s+"))).alias(f"{c}\u0001w") for c in texts]).first()
        for c in texts:
            if row[f"{c}\u0001n"] <= max_levels:
                few.append(c)
            elif (row[f"{c}\u0001w"] or 0) >= text_words:
                prose.append(c)
            else:
                many.append(c)
    stages, inputs = [], []
    if nums:
        stages.append(Imputer(inputCols=nums, outputCols=[f"__num_{c}" for c in nums]))
        inputs += [f"__num_{c}" for c in nums]
    if few:
        stages.append(StringIndexer(inputCols=few, outputCols=[f"__idx_{c}" for c in few], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"__idx_{c}" for c in few], outputCols=[f"__hot_{c}" for c in few]))
        inputs += [f"__hot_{c}" for c in few]
    if many:
        stages.append(FeatureHasher(inputCols=many, outputCol="__hashed", numFeatures=num_features))
        inputs.append("__hashed")
    for c in prose:
        stages.append(RegexTokenizer(inputCol=c, outputCol=f"__tok_{c}"))
        stages.append(HashingTF(inputCol=f"__tok_{c}", outputCol=f"__tf_{c}", numFeatures=num_features))
        inputs.append(f"__tf_{c}")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)


def train_any(df: DataFrame, label: str, model: str = "logistic", num_features: int = 1 << 10, exclude=(), **params) -> PipelineModel:
    """Auto-featurize by schema, then fit."""
    stages = [*featurizer(df, label, exclude, num_features).getStages(), estimator(model, "features", label, **params)]
    return Pipeline(stages=stages).fit(df)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def with_params(est: Estimator, params: dict) -> Estimator:
    """A copy with parameters set by name; the given estimator is left alone, None means default."""
    return est.copy({est.getParam(k): v for k, v in params.items() if v is not None})


def params_table(spark: SparkSession, est) -> DataFrame:
    """Effective parameters as rows."""
    rows = [(p.name, str(est.getOrDefault(p)) if est.hasParam(p.name) and est.isDefined(p) else None, est.isSet(p)) for p in est.params]
    return spark.createDataFrame(rows, "param string, value string, is_set boolean")


def model_table(spark: SparkSession, model, names=None) -> DataFrame:
    """Coefficients, importances, intercept, depth and history of a fitted model as rows (item, name, value)."""
    rows = []

    def add(item, values):
        for i, v in enumerate(np.asarray(values, dtype=float).ravel()):
            rows.append((item, names[i] if names is not None and i < len(names) else str(i), float(v)))

    have = set(dir(model))
    if "coefficientMatrix" in have:
        add("coefficient", model.coefficientMatrix.toArray())
        rows += [("intercept", str(i), float(v)) for i, v in enumerate(model.interceptVector.toArray())]
    elif "coefficients" in have:
        add("coefficient", model.coefficients.toArray())
        rows.append(("intercept", "0", float(model.intercept)))
    if "featureImportances" in have:
        add("importance", model.featureImportances.toArray())
    if "depth" in have:
        rows.append(("depth", "0", float(model.depth)))
    if "numNodes" in have:
        rows.append(("nodes", "0", float(model.numNodes)))
    if "hasSummary" in have and model.hasSummary and hasattr(model.summary, "objectiveHistory"):
        rows += [("objective", str(i), float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "item string, name string, value double")


def early_stop(kind: str, df: DataFrame, valid_flag: str, features: str = "features", label: str = "label", tol: float = 0.01, **params):
    """Boosting that stops when the validation rows stop improving."""
    return fit(kind, df, features, label, validationIndicatorCol=valid_flag, validationTol=tol, **params)


def batch_infer(df: DataFrame, layers: list[tuple[np.ndarray, np.ndarray]], array_col: str, batch_size: int = 1024, inner: int | None = None,
                out: str = "scores") -> DataFrame:
    """Apply a dense net (relu between layers) trained elsewhere, batch by batch; `inner` returns that layer instead."""
    keep = layers if inner is None else layers[:inner]
    width = int(keep[-1][0].shape[1])

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            h = x.astype(np.float64)
            for i, (w, b) in enumerate(keep):
                h = h @ w + b
                if inner is not None or i < len(keep) - 1:
                    h = np.maximum(h, 0.0)
            return h
        return predict

    udf = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[layers[0][0].shape[0]]])
    return df.withColumn(out, udf(F.transform(array_col, lambda v: v.cast("double")))).withMetadata(out, {"width": width})


def grouped_fit(df: DataFrame, group, features, label: str, ridges=(0.0,)) -> DataFrame:
    """One least-squares model per group and ridge value, from grouped sums of products.

    The sums are combined before the shuffle, so a group of any size reaches its
    task as one row; only the small solve runs in Python.
    """
    group, features = as_list(group), as_list(features)
    x = [F.lit(1.0), *[dbl(c) for c in features]]
    k = len(x)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.sum(x[i] * x[j]).alias(f"__x{i}_{j}") for i, j in upper] + [F.sum(x[i] * dbl(label)).alias(f"__y{i}") for i in range(k)]
    sums = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *aggs).withColumn("ridge", F.explode(F.array(*[F.lit(float(v)) for v in ridges])))
    names = ["intercept", *features]
    schema = T.StructType([*[sums.schema[g] for g in group], T.StructField("ridge", T.DoubleType()), T.StructField("n", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in names]])

    def solve(batches):
        for part in batches:
            out = part[[*group, "ridge", "n"]].copy()
            coefs = []
            for row in part.to_dict("records"):
                a = np.zeros((k, k))
                for i, j in upper:
                    a[i, j] = a[j, i] = row[f"__x{i}_{j}"]
                a[np.arange(1, k), np.arange(1, k)] += row["ridge"]
                coefs.append(np.linalg.lstsq(a, np.array([row[f"__y{i}"] for i in range(k)]), rcond=None)[0])
            yield out.assign(**{c: [v[i] for v in coefs] for i, c in enumerate(names)})

    return sums.mapInPandas(solve, schema)


def weighted_ensemble(preds: DataFrame, weights: DataFrame, key: str, model: str = "model", value: str = "p") -> DataFrame:
    """Blend of long predictions (key, model, p) by (model, weight), weights scaled to one.

    A model's predictions are as many as the keys, so they never meet in one task: weights of at most SENT_WEIGHTS rows are sent to the predictions, more are joined by salted keys.
    """
    scaled = with_row(weights, weights.agg(F.sum("weight").alias("__sum"))).select(model, (F.col("weight") / F.col("__sum")).alias("__w"))
    few = weights.limit(SENT_WEIGHTS + 1).count() <= SENT_WEIGHTS
    weighed = preds.join(F.broadcast(scaled), model) if few else skew_safe_lookup(preds, scaled, model, key)
    return weighed.groupBy(key).agg(r(F.sum(F.col(value) * F.col("__w"))).alias("blend"))


def squared_loss(label: Column, p: Column) -> Column:
    return F.avg((label - p) * (label - p))


def log_loss_of(label: Column, p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return -F.avg(F.when(label == 1, F.ln(q)).otherwise(F.ln(1 - q)))


def ensemble_select(preds: DataFrame, models, label: str, size: int, loss=squared_loss) -> list[tuple[str, float]]:
    """Greedy forward selection with replacement: each step scores every candidate in one aggregation.

    `preds` holds one column per model. Returns the chosen model and the blend's loss per step.
    """
    models, counts, steps = as_list(models), {}, []
    preds = preds.select(label, *models).persist()
    try:
        for step in range(size):
            total = sum((F.col(m) * c for m, c in counts.items()), F.lit(0.0))
            row = preds.agg(*[loss(F.col(label), (total + F.col(m)) / (step + 1)).alias(m) for m in models]).first()
            best = min(models, key=lambda m: (round(row[m], 12), m))
            counts[best] = counts.get(best, 0) + 1
            steps.append((best, row[best]))
        return steps
    finally:
        preds.unpersist()


def _fold_frames(df: DataFrame, fold: str, k: int):
    for i in range(k):
        yield i, df.where(F.col(fold) != i), df.where(F.col(fold) == i)


def _fitted_by_fold(df: DataFrame, weak: dict[str, Estimator], k: int, key, label: str | None, seed: int) -> tuple[DataFrame, dict[str, list]]:
    """The frame with `__fold`, and k models of each estimator, fitted on one cached copy of it."""
    folded = stratified_kfold(df, label, k, seed, key, "__fold") if label else kfold(df, k, seed, key, "__fold")
    cached = folded.persist()
    try:
        return folded, {name: [est.fit(train) for _, train, _ in _fold_frames(cached, "__fold", k)] for name, est in weak.items()}
    finally:
        cached.unpersist()


def _by_own_models(folded: DataFrame, models: list, prefix: str = "__") -> DataFrame:
    """Every row scored by all k models in one pass; prediction `<prefix>p` (and probability `<prefix>q`) is that of the model that has not seen it."""
    outs = {"prediction": f"{prefix}p", "probability": f"{prefix}q"}
    scored = folded
    for i, m in enumerate(models):
        before = set(scored.columns)
        scored = m.transform(scored)
        scored = scored.drop(*[c for c in scored.columns if c not in before and c not in outs])
        scored = scored.withColumnsRenamed({c: f"{p}{i}" for c, p in outs.items() if c in scored.columns and c not in before})
    made = [p for p in outs.values() if f"{p}0" in scored.columns]
    own = {p: F.coalesce(*[F.when(F.col("__fold") == i, F.col(f"{p}{i}")) for i in range(len(models))]) for p in made}
    return scored.withColumns(own).drop(*[f"{p}{i}" for p in made for i in range(len(models))])


def cross_val_predict(df: DataFrame, est: Estimator, k: int, key, label: str | None = None, seed: int = 1, keep=()) -> DataFrame:
    """Out-of-fold predictions for every row; folds by key hash, class-balanced when a label is given.

    The k models are fitted on a cached frame; every row is then scored by all
    of them in one pass and keeps the prediction of the model that has not seen it.
    """
    folded, models = _fitted_by_fold(df, {"": est}, k, key, label, seed)
    scored = _by_own_models(folded, models[""])
    cols = [*as_list(key), *as_list(keep), F.col("__p").alias("prediction"), F.col("__fold").alias("fold")]
    if "__q" in scored.columns:
        cols.append(vector_to_array("__q").alias("probability"))
    return scored.select(*cols)


def cross_val_score(df: DataFrame, est: Estimator, k: int, key, evaluator, label: str | None = None, seed: int = 1) -> DataFrame:
    """Metric per fold."""
    folded = (stratified_kfold(df, label, k, seed, key, "__fold") if label else kfold(df, k, seed, key, "__fold")).persist()
    try:
        scores = [(i, float(evaluator.evaluate(est.fit(train).transform(test)))) for i, train, test in _fold_frames(folded, "__fold", k)]
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(scores, "fold int, score double")


def stack_features(df: DataFrame, weak: dict[str, Estimator], k: int, key: str, label: str, seed: int = 1) -> DataFrame:
    """Out-of-fold predictions of weak models as extra columns.

    If no key repeats or is null, all models share the folds and score the rows in one pass; else each model's predictions are joined by the key.
    """
    if df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where((F.col("__n") > 1) | F.col(key).isNull()).isEmpty():
        folded, models = _fitted_by_fold(df, weak, k, key, label, seed)
        for name in weak:
            folded = _by_own_models(folded, models[name], f"__{name}_")
        return folded.select(*df.columns, *[F.col(f"__{name}_p").alias(f"weak_{name}") for name in weak])
    for name, est in weak.items():
        preds = cross_val_predict(df, est, k, key, label, seed).select(F.col(key).alias("__k"), F.col("prediction").alias(f"weak_{name}"))
        df = df.join(preds, F.col(key) == F.col("__k")).drop("__k")
    return df
