"""Tuning: trials are Spark jobs, suggestions are DataFrame queries, history is a Parquet table."""

from __future__ import annotations

import hashlib
import json
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.cols import as_list, dbl, div, r, same_keys, union_all, with_row
from ..functions.hashing import HASH_SPACE, unit_draw
from ..functions.ordered import number_rows
from ..functions.quantiles import quantile_row, quantiles
from . import space as K
from .models import CLASSIFIERS, cross_val_score, estimator, train_any, with_params
from .stages import CURVES, CurveEvaluator

TRIAL_SCHEMA = "study string, number long, iteration int, loss double, params map<string,string>, state string, train_time double, source string, error string, attrs map<string,string>"


# ---------------------------------------------------------------- history

def append_history(df: DataFrame, path: str) -> None:
    """Append evaluations; earlier files are never rewritten, so a lost driver loses at most the running trial."""
    df.write.mode("append").partitionBy("study").parquet(path)


def read_history(spark: SparkSession, path: str, study: str | None = None) -> DataFrame:
    df = spark.read.schema(TRIAL_SCHEMA).parquet(path)
    return df.where(F.col("study") == study) if study else df


def trials_dataframe(history: DataFrame, study: str | None = None, attrs=(), user_attrs=()) -> DataFrame:
    """History as a flat table: number, value, state, the wanted parameters and the wanted attributes that objectives have set."""
    df = history.where(F.col("study") == study) if study else history
    return df.select("study", "number", F.col("loss").alias("value"), "state", *[F.try_element_at("params", F.lit(a)).alias(f"params_{a}") for a in as_list(attrs)],
                     *[F.try_element_at("attrs", F.lit(a)).alias(f"user_attrs_{a}") for a in as_list(user_attrs)])


def best_trial(history: DataFrame, direction: str = "minimize", group=()) -> DataFrame:
    """The best completed trial (ties: lowest number), as a row; one per group if given."""
    done = history.where((F.col("state") == "COMPLETE") & F.col("loss").isNotNull())
    sign = 1 if direction == "minimize" else -1
    row = F.struct(*[c for c in done.columns if c not in as_list(group)])
    out = done.groupBy(*as_list(group)).agg(F.min_by(row, F.struct(F.col("loss") * sign, F.col("number"))).alias("b"))
    return out.select(*as_list(group), "b.*")


def best_params(history: DataFrame, direction: str = "minimize") -> dict:
    row = best_trial(history, direction).first()
    return dict(row["params"] or {}) if row else {}


def compare_searches(history: DataFrame, study: str = "study") -> DataFrame:
    """Per search: evaluations, mean, best, and how many evaluations it took to reach the best."""
    g = history.groupBy(study).agg(F.count(F.lit(1)).alias("n"), r(F.avg("loss")).alias("mean_loss"), F.min("loss").alias("best_loss"),
                                   F.min_by("number", F.struct("loss", "number")).alias("__best"))
    best = g.select(F.col(study).alias("__s"), F.col("__best"))
    upto = (history.join(best, F.col(study) == F.col("__s")).where(F.col("number") <= F.col("__best"))
            .groupBy(study).agg(F.count(F.lit(1)).alias("evaluations_to_best")))
    return same_keys(g.drop("__best"), upto, study, "left")


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict, tags: dict | None = None) -> None:
    row = (run_id, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in (tags or {}).items()}, time.time())
    schema = "run_id string, params map<string,string>, metrics map<string,double>, tags map<string,string>, logged_at double"
    spark.createDataFrame([row], schema).write.mode("append").parquet(path)


def search_runs(spark: SparkSession, path: str, condition: str = "true", order_by: str | None = None) -> DataFrame:
    df = spark.read.parquet(path).where(condition)
    return df.orderBy(F.expr(order_by)) if order_by else df


# ---------------------------------------------------------------- suggestions

GAMMA, PRIOR_WEIGHT, BANDWIDTH = 0.25, 1.0, 0.1


def _scaled(leaf: K.Leaf, c: Column) -> tuple[Column, float, float]:
    """Numeric image of a parameter (logarithm for log types) and its range."""
    d = leaf.dist
    if "loguniform" in d["dist"]:
        return F.ln(c.cast("double")), d["low"], d["high"]
    if d["dist"] in ("normal", "lognormal"):
        x = F.ln(c.cast("double")) if d["dist"] == "lognormal" else c.cast("double")
        return x, d["mu"] - 3 * d["sigma"], d["mu"] + 3 * d["sigma"]
    return c.cast("double"), d["low"], d["high"]


def _is_category(leaf: K.Leaf) -> bool:
    return leaf.dist["dist"] in ("choice", "pchoice")


def tpe_scores(trials: DataFrame, candidates: DataFrame, spec: dict, gamma: float = GAMMA, index: str = "draw") -> DataFrame:
    """(draw, score): log l(x) - log g(x) with Parzen estimates of the good and the other trials.

    The candidates are a bounded set of draws, sent along as one literal array;
    trials meet them by an explode that is summed up before the shuffle.
    A parameter that is null (another branch) adds nothing.
    """
    todo = K.leaves(spec)
    cut = quantile_row(trials, "loss", {"__cut": gamma})
    rows = with_row(trials, cut).withColumn("__good", F.col("loss") <= F.col("__cut"))
    bounded = candidates.select(F.collect_list(F.struct(index, *[leaf.label for leaf in todo])).alias("c")).scalar()
    pairs = rows.withColumn("__c", F.explode(bounded))
    aggs = []
    for i, leaf in enumerate(todo):
        mine, theirs = F.col(leaf.label), F.col("__c")[leaf.label]
        if _is_category(leaf):
            k = F.when(mine.cast("string") == theirs.cast("string"), 1.0).otherwise(0.0)
        else:
            x, low, high = _scaled(leaf, mine)
            y, _, _ = _scaled(leaf, theirs)
            bw = max((high - low) * BANDWIDTH, 1e-12)
            k = F.exp(-0.5 * F.pow((y - x) / bw, 2)) / (bw * 2.5066282746310002)
        for tag, side in (("l", F.col("__good")), ("g", ~F.col("__good"))):
            known = side & mine.isNotNull() & theirs.isNotNull()
            aggs += [F.sum(F.when(known, k).otherwise(0.0)).alias(f"{tag}{i}"), F.count(F.when(known, 1)).alias(f"{tag}n{i}")]
    sums = pairs.groupBy(F.col("__c").alias("__c")).agg(*aggs)
    score = F.lit(0.0)
    for i, leaf in enumerate(todo):
        if _is_category(leaf):
            size = len(leaf.dist.get("options") or leaf.dist.get("pairs"))
            prior = PRIOR_WEIGHT / size
        else:
            _, low, high = _scaled(leaf, F.lit(1.0))
            prior = PRIOR_WEIGHT / max(high - low, 1e-12)
        density = {t: (F.col(f"{t}{i}") + prior) / (F.col(f"{t}n{i}") + PRIOR_WEIGHT) for t in ("l", "g")}
        score = score + F.when(F.col("__c")[leaf.label].isNull(), 0.0).otherwise(F.ln(density["l"]) - F.ln(density["g"]))
    return sums.select(F.col("__c")[index].alias(index), r(score, 9).alias("score"))


def tpe_suggest(trials: DataFrame, candidates: DataFrame, spec: dict, gamma: float = GAMMA, index: str = "draw") -> DataFrame:
    """The candidate with the largest l / g (ties: lowest index)."""
    s = tpe_scores(trials, candidates, spec, gamma, index)
    return s.agg(F.min_by(F.struct(index, "score"), F.struct(-F.col("score"), F.col(index))).alias("b")).select("b.*")


def _numeric_leaves(spec: dict):
    return [leaf for leaf in K.leaves(spec) if not _is_category(leaf)]


def forest_suggest(trials: DataFrame, candidates: DataFrame, spec: dict, trees: int = 20, seed: int = 7, index: str = "draw") -> DataFrame:
    """Expected improvement under a forest surrogate: mean and spread over its trees."""
    num = _numeric_leaves(spec)
    cats = [leaf for leaf in K.leaves(spec) if _is_category(leaf)]

    def features(df):
        cols = {f"__f{i}": F.coalesce(_scaled(leaf, F.col(leaf.label))[0], F.lit(0.0)) for i, leaf in enumerate(num)}
        for i, leaf in enumerate(cats):
            options = list(leaf.dist["options"]) if "options" in leaf.dist else [v for _, v in leaf.dist["pairs"]]
            cols.update({f"__c{i}_{j}": (F.col(leaf.label).cast("string").eqNullSafe(F.lit(str(o)))).cast("double") for j, o in enumerate(options)})
        return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df.withColumns(cols))

    data = features(trials.where(F.col("loss").isNotNull()))
    forest = RandomForestRegressor(labelCol="loss", numTrees=trees, seed=seed).fit(data)
    scored = features(candidates)
    for i, tree in enumerate(forest.trees):
        tree.setPredictionCol(f"__t{i}")
        scored = tree.transform(scored)
    preds = F.array(*[F.col(f"__t{i}") for i in range(len(forest.trees))])
    mean = F.aggregate(preds, F.lit(0.0), lambda a, x: a + x) / len(forest.trees)
    scored = with_row(scored.withColumn("mean", mean), trials.agg(F.min("loss").alias("__best")))
    sd = F.sqrt(F.aggregate(preds, F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / len(forest.trees)) + 1e-9
    scored = scored.withColumn("sd", sd)
    z = (F.col("__best") - F.col("mean")) / F.col("sd")
    density = F.exp(-z * z / 2) / 2.5066282746310002
    ei = (F.col("__best") - F.col("mean")) * _normal_cdf(z) + F.col("sd") * density
    scored = scored.withColumn("score", r(F.greatest(ei, F.lit(0.0)), 12))
    best = F.struct(-F.col("score"), F.col("mean"), F.col(index))  # equal improvements: lowest mean, then lowest index
    return scored.agg(F.min_by(F.struct(index, "score"), best).alias("b")).select("b.*")


# Abramowitz and Stegun 26.2.17, absolute error below 7.5e-8.
_CDF = (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530)


def _normal_cdf(z: Column) -> Column:
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = F.lit(0.0)
    for c in _CDF:
        poly = (poly + c) * t
    upper = F.exp(-z * z / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, 1 - upper).otherwise(upper)


# ---------------------------------------------------------------- objectives and loops

def metric_evaluator(metric: str, label: str = "label") -> Evaluator:
    """Spark's evaluators by metric name; auc, auc_pr, ks and log_loss are the exact curve metrics."""
    if metric in (*CURVES, "log_loss"):
        return CurveEvaluator(metricName=metric, labelCol=label)
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    if metric in ("rmse", "mse", "mae", "r2"):
        return RegressionEvaluator(labelCol=label, metricName=metric)
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric)


def loss_of(evaluator: Evaluator, value: float) -> float:
    """Lower is better, whatever the metric; a value that is none is worse than all."""
    return math.inf if math.isnan(value) else -value if evaluator.isLargerBetter() else value


def model_from_params(params: dict, kind: str | None = None, features: str = "features", label: str = "label") -> Estimator:
    """`model` names the estimator; the other labels are its parameters."""
    kind = kind or params["model"]
    named = {k: v for k, v in K.short_names(params).items() if k != "model"}
    if kind.startswith("gbt") and "numTrees" in named:
        named["maxIter"] = named.pop("numTrees")
    est = estimator(kind, features, label)
    return with_params(est, {k: _as_param(est, k, v) for k, v in named.items()})


def _as_param(est: Estimator, name: str, value):
    """Numbers in the type of the parameter's default (a draw of 5.0 serves an int parameter)."""
    p = est.getParam(name)
    default = est.getOrDefault(p) if est.isDefined(p) else None
    if isinstance(value, str) and isinstance(default, (int, float)) and not isinstance(default, bool):
        value = float(value)  # as the history keeps it
    return type(default)(value) if isinstance(default, (int, float)) and not isinstance(default, bool) else value


def validation_objective(train: DataFrame, valid: DataFrame, evaluator: Evaluator, kind: str | None = None, build=None):
    """params -> loss on a given validation frame."""
    make = build or (lambda p: model_from_params(p, kind))

    def objective(params: dict) -> float:
        return loss_of(evaluator, float(evaluator.evaluate(make(params).fit(train).transform(valid))))

    return objective


def tune(spark: SparkSession, objective, spec: dict, path: str, study: str = "study", algo: str = "tpe", max_evals: int = 20, timeout: float | None = None,
         n_candidates: int = 24, n_startup: int = 5, seed: int = 1, parallelism: int = 1, pruner=None, trial_secs: float | None = None) -> DataFrame:
    """suggest -> fit -> evaluate -> append, until the count or the time is used up. Continues a stored study.

    objective(params) or objective(params, trial); a trial takes step reports, by which `pruner` may end it, and user attributes. Jobs of a trial that runs
    longer than `trial_secs` are cancelled. A failed trial's reason is kept in the history.
    """
    from .trials import Trial, run_trial

    done = _next_number(spark, path, study)
    start, end = time.time(), done + max_evals
    while done < end and (timeout is None or time.time() - start < timeout):
        batch = min(parallelism, end - done)
        chosen = [_suggest(spark, path, study, spec, algo, done + i, n_candidates, n_startup, seed) for i in range(batch)]
        todo = [Trial(spark, path, study, done + i, p, pruner) for i, p in enumerate(chosen)]
        with ThreadPoolExecutor(batch) as pool:  # each trial is a set of Spark jobs
            results = list(pool.map(lambda trial: run_trial(objective, trial, trial_secs), todo))
        rows = [(study, t.number, t.number, loss, {k: str(v) for k, v in t.params.items()}, state, secs, algo, error, attrs) for t, (loss, state, secs, error, attrs) in zip(todo, results)]
        append_history(spark.createDataFrame(rows, TRIAL_SCHEMA), path)
        done += batch
    return read_history(spark, path, study)


def resume(spark: SparkSession, objective, spec: dict, path: str, study: str, **kw) -> DataFrame:
    """More trials for a stored study; numbering goes on."""
    return tune(spark, objective, spec, path, study, **kw)


def random_search(spark: SparkSession, objective, spec: dict, n: int, path: str, study: str = "random", seed: int = 1, parallelism: int = 1) -> DataFrame:
    return tune(spark, objective, spec, path, study, "random", n, seed=seed, parallelism=parallelism)


def _next_number(spark: SparkSession, path: str, study: str) -> int:
    if not _exists(spark, path):
        return 0
    last = read_history(spark, path, study).agg(F.max("number")).first()[0]
    return 0 if last is None else last + 1


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _suggest(spark, path, study, spec, algo, number, n_candidates, n_startup, seed) -> dict:
    if algo == "random" or number < n_startup:
        return K.params_of(K.sample_space(spark, spec, 1, seed, start=number).first().asDict(), spec)
    pool = K.sample_space(spark, spec, n_candidates, f"{seed}:{number}")
    history = read_history(spark, path, study).where("state = 'COMPLETE'")
    trials = history.select("loss", *[F.try_element_at("params", F.lit(leaf.label)).cast(pool.schema[leaf.label].dataType).alias(leaf.label) for leaf in K.leaves(spec)])
    pick = {"tpe": tpe_suggest, "forest": forest_suggest}[algo](trials, pool, spec).first()
    index = pick["draw"] if pick and pick["draw"] is not None else 0
    return K.params_of(pool.where(F.col("draw") == index).first().asDict(), spec)


@dataclass(frozen=True)
class CvResult:
    """Settings, their mean metric over the folds, and the best setting refitted on all rows."""

    settings: list[dict]
    metrics: list[float]
    larger_is_better: bool
    best_model: object


def cross_validate_grid(df: DataFrame, est: Estimator, grid: list[dict], evaluator: Evaluator, fold_col: str, k: int, parallelism: int = 4) -> CvResult:
    """Every setting on every fold, then a refit of the best. The folded rows are kept in memory or on disk once
    and all (setting, fold) fits run on them side by side."""
    rows = df.persist()
    try:
        rows.count()

        def run(job: tuple[int, int]) -> float:
            i, fold = job
            model = est.copy(grid[i]).fit(rows.where(F.col(fold_col) != fold))
            return float(evaluator.evaluate(model.transform(rows.where(F.col(fold_col) == fold))))

        jobs = [(i, fold) for i in range(len(grid)) for fold in range(k)]
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(inheritable_thread_target(df.sparkSession)(run), jobs))
        metrics = [sum(s for (i, _), s in zip(jobs, scores) if i == g) / k for g in range(len(grid))]
        best = min(range(len(grid)), key=lambda i: (loss_of(evaluator, metrics[i]), i))
        return CvResult(grid, metrics, evaluator.isLargerBetter(), est.copy(grid[best]).fit(rows))
    finally:
        rows.unpersist()


def cv_results(spark: SparkSession, result: CvResult) -> DataFrame:
    """Settings with their mean metric, best first."""
    rows = [({p.name: str(v) for p, v in m.items()}, float(a)) for m, a in zip(result.settings, result.metrics)]
    best = F.desc("metric") if result.larger_is_better else F.asc("metric")
    return spark.createDataFrame(rows, "params map<string,string>, metric double").orderBy(best)


def tune_on_validation(train: DataFrame, valid: DataFrame, settings: list[tuple[Estimator, dict]], evaluator: Evaluator, parallelism: int = 2):
    """Fit copies per setting on train, choose on the given validation frame. Returns (best model, results frame)."""
    train, valid = train.persist(), valid.persist()
    try:
        def run(i: int):
            est, params = settings[i]
            model = with_params(est, params).fit(train)
            return model, float(evaluator.evaluate(model.transform(valid)))

        with ThreadPoolExecutor(parallelism) as pool:
            done = list(pool.map(inheritable_thread_target(train.sparkSession)(run), range(len(settings))))
    finally:
        train.unpersist(), valid.unpersist()
    best = min(range(len(done)), key=lambda i: (loss_of(evaluator, done[i][1]), i))
    rows = [(i, type(settings[i][0]).__name__, {k: str(v) for k, v in settings[i][1].items()}, done[i][1], i == best) for i in range(len(done))]
    frame = train.sparkSession.createDataFrame(rows, "setting int, model string, params map<string,string>, metric double, is_best boolean")
    return done[best][0], frame


def find_best_model(models: dict, df: DataFrame, metrics, label: str = "label"):
    """Fitted models scored on one frame: (best model by the first metric, table of all metrics)."""
    metrics = as_list(metrics)
    evals = {m: metric_evaluator(m, label) for m in metrics}
    rows, best = [], None
    for name in sorted(models):
        scored = models[name].transform(df).persist()
        try:
            values = [float(evals[m].evaluate(scored)) for m in metrics]
        finally:
            scored.unpersist()
        rows.append((name, *values))
        key = (loss_of(evals[metrics[0]], values[0]), name)
        best = min(best, key) if best else key
    schema = "model string, " + ", ".join(f"{m} double" for m in metrics)
    return models[best[1]], df.sparkSession.createDataFrame(rows, schema).withColumn("is_best", F.col("model") == best[1])


# ---------------------------------------------------------------- early stopping of trials

def median_prune(steps: DataFrame, from_trial, trial: str = "trial", step: str = "step", value: str = "value", group=()) -> DataFrame:
    """Trials numbered from `from_trial` on whose step value is worse than the median of the earlier trials at that step.

    One row per (trial, step) with the median and the verdict; a step no earlier trial reached never prunes.
    """
    group = as_list(group)
    earlier = steps.where(F.col(trial) < from_trial)
    medians = quantiles(earlier, value, {"median": 0.5}, [*group, step]).drop("column")
    now = steps.where(F.col(trial) >= from_trial)
    out = same_keys(now, medians, [*group, step], "left")
    return out.withColumn("prune", F.coalesce(F.col(value) > F.col("median"), F.lit(False)))


def rung_survivors(results: DataFrame, eta: int, rung: str = "rung", trial: str = "trial", loss: str = "loss") -> DataFrame:
    """The best floor(n / eta) trials (at least one) of every rung."""
    rows = number_rows(results, [loss, trial], rung, out="__pos", total="__n")
    return rows.where(F.col("__pos") < F.greatest(F.floor(F.col("__n") / eta), F.lit(1))).drop("__pos", "__n")


def hyperband_brackets(max_r: int, eta: int = 3) -> list[list[tuple[int, int]]]:
    """Per bracket the (trials, budget) of each rung."""
    s_max = 0
    while eta ** (s_max + 1) <= max_r:
        s_max += 1
    out = []
    for s in range(s_max, -1, -1):
        n = -(-(s_max + 1) * eta**s // (s + 1))
        out.append([(max(n // eta**i, 1), max(max_r // eta ** (s - i), 1)) for i in range(s + 1)])
    return out


def successive_halving(spark: SparkSession, objective, spec: dict, n: int, eta: int = 3, min_r: int = 1, max_r: int = 9, seed: int = 1, parallelism: int = 2) -> DataFrame:
    """objective(params, budget) -> loss. Each rung keeps the best 1/eta and multiplies the budget by eta."""
    draws = [K.params_of(row.asDict(), spec) for row in K.sample_space(spark, spec, n, seed).orderBy("draw").collect()]  # n settings
    alive, budget, rung, rows = list(range(n)), min_r, 0, []
    while True:
        with ThreadPoolExecutor(parallelism) as pool:
            losses = list(pool.map(lambda i: float(objective(draws[i], budget)), alive))
        rows += [(rung, budget, i, loss, {k: str(v) for k, v in draws[i].items()}) for i, loss in zip(alive, losses)]
        if budget * eta > max_r or len(alive) == 1:
            break
        keep = max(len(alive) // eta, 1)
        alive = [i for _, i in sorted(zip(losses, alive))[:keep]]
        budget, rung = budget * eta, rung + 1
    return spark.createDataFrame(rows, "rung int, budget int, trial long, loss double, params map<string,string>")


def param_importance(trials: DataFrame, params, bins: int = 8, loss: str = "loss") -> DataFrame:
    """Share of the loss variance between the levels (numbers: equal-width bins) of each parameter."""
    numeric = [p for p in as_list(params) if trials.schema[p].dataType.typeName() != "string"]
    if numeric:
        edges = trials.agg(*[F.min(dbl(p)).alias(f"__lo_{p}") for p in numeric], *[F.max(dbl(p)).alias(f"__hi_{p}") for p in numeric])
        trials = with_row(trials, edges)
    levels = []
    for p in as_list(params):
        c = F.col(p).cast("string")
        if p in numeric:
            lo, hi = F.col(f"__lo_{p}"), F.col(f"__hi_{p}")
            c = F.least(F.floor(F.try_divide(dbl(p) - lo, hi - lo) * bins), F.lit(bins - 1)).cast("string")
        levels.append(F.struct(F.lit(p).alias("param"), c.alias("level")))
    cells = trials.select(dbl(loss).alias("y"), F.inline(F.array(*levels))).groupBy("param", "level").agg(
        F.count("y").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    sums = cells.groupBy("param").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    centre = F.col("s") * F.col("s") / F.col("n")
    return sums.select("param", r(div(F.col("b") - centre, F.col("q") - centre)).alias("importance"))


def param_importance_forest(trials: DataFrame, params, loss: str = "loss", trees: int = 20, seed: int = 3) -> DataFrame:
    params = as_list(params)
    data = VectorAssembler(inputCols=params, outputCol="features", handleInvalid="skip").transform(trials.select(loss, *[dbl(p).alias(p) for p in params]))
    imp = RandomForestRegressor(labelCol=loss, numTrees=trees, seed=seed).fit(data).featureImportances.toArray()
    return trials.sparkSession.createDataFrame([(p, float(v)) for p, v in zip(params, imp)], "param string, importance double")


def minimize_on_grid(spark: SparkSession, fn, low: float, high: float, n: int) -> DataFrame:
    """Arg-min of a column function on a dense grid (ties: lowest x)."""
    grid = spark.range(n).select((F.lit(low) + F.col("id") * F.lit((high - low) / (n - 1))).alias("x"))
    grid = grid.withColumn("y", fn(F.col("x")))
    return grid.agg(F.min_by(F.struct("x", "y"), F.struct("y", "x")).alias("b")).select("b.*")


# ---------------------------------------------------------------- evolution and top level

def _driver_unit(*parts) -> float:
    """Hash draw for decisions about the (small) population, never about rows."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / HASH_SPACE


def evolve(spark: SparkSession, fitness, spec: dict, generations: int = 3, population: int = 6, seed: int = 1, start: list[dict] | None = None,
           mutation: float = 0.7, parallelism: int = 2) -> DataFrame:
    """Genetic search: rank selection, mutation (redraw one parameter in its branch) and crossover.

    fitness(params) -> loss, usually a cross-validated Spark fit. `start` warm-starts the population.
    """
    fresh = iter(K.params_of(row.asDict(), spec) for row in K.sample_space(spark, spec, population * (generations + 1) * 2, seed).orderBy("draw").collect())
    pool = [dict(p) for p in (start or [])]  # all of them, even beyond the population
    pool += [next(fresh) for _ in range(max(0, population - len(pool)))]
    cache, rows = {}, []
    for g in range(generations):
        todo = [p for p in {json.dumps(p, sort_keys=True): p for p in pool}.items() if p[0] not in cache]
        with ThreadPoolExecutor(parallelism) as ex:
            cache.update(dict(zip([k for k, _ in todo], ex.map(lambda kp: float(fitness(kp[1])), todo))))
        ranked = sorted(pool, key=lambda p: (cache[json.dumps(p, sort_keys=True)], json.dumps(p, sort_keys=True)))
        rows += [(g, i, cache[json.dumps(p, sort_keys=True)], {k: str(v) for k, v in p.items()}) for i, p in enumerate(ranked)]
        parents = ranked[:max(2, population // 2)]
        pool = parents[:1]
        while len(pool) < population:
            i = len(pool)
            a = parents[int(_driver_unit(seed, g, i, "a") * len(parents))]
            b = parents[int(_driver_unit(seed, g, i, "b") * len(parents))]
            other = next(fresh, a)
            donor = other if _driver_unit(seed, g, i, "m") < mutation else b
            shared = sorted(k for k in a if k in donor and "__" in k) if donor.get("model") == a.get("model") else []
            if shared:
                gene = shared[int(_driver_unit(seed, g, i, "k") * len(shared))]
                pool.append({**a, gene: donor[gene]})
            else:
                pool.append(dict(donor))
    return spark.createDataFrame(rows, "generation int, rank int, loss double, params map<string,string>")


def feature_set_selector(df: DataFrame, sets: DataFrame, chosen, keep=()) -> DataFrame:
    """Columns of the named feature sets; `sets` is a small table (name, features) listing columns."""
    rows = {row["name"]: list(row["features"]) for row in sets.where(F.col("name").isin(as_list(chosen))).collect()}
    missing = [c for c in as_list(chosen) if c not in rows]
    if missing:
        raise ValueError(f"unknown feature sets {missing}")
    wanted = list(dict.fromkeys([*as_list(keep), *[f for c in as_list(chosen) for f in rows[c]]]))
    return df.select(*wanted)


class CachedPrefix:
    """A fitted pipeline prefix whose output is kept while the last stage is tuned."""

    def __init__(self, prefix: Pipeline, train: DataFrame):
        self.model: PipelineModel = prefix.fit(train)
        self.train = self.model.transform(train).persist()

    def fit(self, last: Estimator) -> PipelineModel:
        return PipelineModel(stages=[*self.model.stages, last.fit(self.train)])

    def close(self) -> None:
        self.train.unpersist()


def leaderboard(df: DataFrame, label: str, key, families: dict[str, dict], metric: str, max_models: int | None = None, max_secs: float | None = None, k: int = 3, seed: int = 1) -> DataFrame:
    """Model families cross-validated under a budget, best first; families that the budget leaves out follow with the state SKIPPED. `df` holds an assembled `features` column."""
    evaluator, start, rows = metric_evaluator(metric, label), time.time(), []
    for i, (name, params) in enumerate(families.items()):
        if (max_models is not None and i >= max_models) or (max_secs is not None and rows and time.time() - start > max_secs):
            rows.append((name, None, None, None, "SKIPPED"))
            continue
        t = time.time()
        kind = params.get("model", name)
        est = estimator(kind, "features", label, **{p: v for p, v in params.items() if p != "model"})
        stats = cross_val_score(df, est, k, key, evaluator, label if kind in CLASSIFIERS else None, seed).agg(F.avg("score"), F.stddev_pop("score")).first()
        rows.append((name, stats[0], stats[1], time.time() - t, "COMPLETE"))
    out = df.sparkSession.createDataFrame(rows, f"model string, mean_{metric} double, sd_{metric} double, seconds double, state string")
    best = F.desc_nulls_last(f"mean_{metric}") if evaluator.isLargerBetter() else F.asc_nulls_last(f"mean_{metric}")
    return out.orderBy(best, "model")


class Predictor:
    """Column roles to a trained, scored, storable predictor.

    Roles: `output` (exactly one), `categorical`, `ignore`; other columns are used by their type.
    """

    def __init__(self, kind: str, roles: dict[str, str]):
        if kind not in ("classifier", "regressor"):
            raise ValueError("kind is classifier or regressor")
        outputs = [c for c, role in roles.items() if role == "output"]
        if len(outputs) != 1:
            raise ValueError("exactly one column must have the role output")
        self.kind, self.roles, self.output, self.model = kind, roles, outputs[0], None

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("string") for c, role in self.roles.items() if role == "categorical"})

    def train(self, df: DataFrame, model: str | None = None, **params) -> "Predictor":
        ignored = [c for c, role in self.roles.items() if role == "ignore"]
        model = model or ("random_forest" if self.kind == "classifier" else "forest_reg")
        self.model = train_any(self._typed(df), self.output, model, exclude=ignored, **params)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self._typed(df))

    def score(self, df: DataFrame) -> DataFrame:
        from .evaluate import accuracy, regression_stats
        scored = self.predict(df)
        return accuracy(scored, self.output) if self.kind == "classifier" else regression_stats(scored, self.output)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def load(self, path: str) -> "Predictor":
        self.model = PipelineModel.load(path)
        return self
