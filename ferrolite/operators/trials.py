"""Trials that report while they run, Hyperband on nested samples, pipelines bred from a template, and the report after a search."""

from __future__ import annotations

import inspect
import json
import logging
import math
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import feature as ML
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cols import as_list
from ..functions.hashing import unit_draw
from . import search as S, space as K
from .models import CLASSIFIERS, REGRESSORS, estimator, with_params
from .split import kfold

STEP_SCHEMA = "study string, trial long, step long, value double"

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- trials that report

class TrialPruned(Exception):
    """Raised in an objective to end its trial early."""


@dataclass(frozen=True)
class MedianPruner:
    """Ends a trial whose value at a step is worse than the median of the earlier completed trials there, once `startup` trials are complete and from step `warmup` on."""

    startup: int = 4
    warmup: int = 0

    def prunes(self, spark: SparkSession, path: str, study: str, trial: int, step: int, value: float) -> bool:
        if step < self.warmup or not S._exists(spark, path):
            return False
        done = S.read_history(spark, path, study).where("state = 'COMPLETE'").select(F.col("number").alias("trial"))
        if done.count() < self.startup:
            return False
        earlier = read_steps(spark, path, study).join(done, "trial").select("trial", "step", "value")
        now = spark.createDataFrame([(trial, step, value)], "trial long, step long, value double")
        verdict = S.median_prune(earlier.where(F.col("trial") < trial).unionByName(now), trial).first()
        return bool(verdict and verdict["prune"])


@dataclass
class Trial:
    """One run of an objective: its number and parameters, what it reports, and attributes of the user's own."""

    spark: SparkSession
    path: str
    study: str
    number: int
    params: dict
    pruner: MedianPruner | None = None
    attrs: dict = field(default_factory=dict)
    last: float | None = None

    @property
    def tag(self) -> str:
        return f"trial-{abs(hash((self.path, self.study)))}-{self.number}"

    def report(self, step: int, value: float) -> None:
        """Store a step's loss; ends the trial, and cancels the jobs it still has running, if the pruner says so."""
        self.last = float(value)
        row = [(self.study, self.number, int(step), self.last)]
        self.spark.createDataFrame(row, STEP_SCHEMA).coalesce(1).write.mode("append").partitionBy("study").parquet(_steps_path(self.path))
        if self.pruner is not None and self.pruner.prunes(self.spark, self.path, self.study, self.number, int(step), self.last):
            self.cancel()
            raise TrialPruned(f"worse than the median at step {step}")

    def cancel(self) -> None:
        """Stop the Spark jobs that the trial has running, in whichever thread it started them."""
        self.spark.sparkContext.cancelJobsWithTag(self.tag)


def _steps_path(path: str) -> str:
    return f"{path.rstrip('/')}-steps"


def read_steps(spark: SparkSession, path: str, study: str | None = None) -> DataFrame:
    """(study, trial, step, value) of all reports; empty where nothing has been reported."""
    if not S._exists(spark, _steps_path(path)):
        return spark.createDataFrame([], STEP_SCHEMA)
    df = spark.read.schema(STEP_SCHEMA).parquet(_steps_path(path))
    return df.where(F.col("study") == study) if study else df


def run_trial(objective, trial: Trial, secs: float | None = None) -> tuple:
    """(loss, state, seconds, error, attributes). All jobs carry the trial's tag; after `secs` they are cancelled and the trial counts as pruned."""
    sc, start, late = trial.spark.sparkContext, time.time(), threading.Event()
    clock = threading.Timer(secs, lambda: (late.set(), trial.cancel())) if secs else None
    sc.addJobTag(trial.tag)
    try:
        if clock:
            clock.start()
        wants_trial = len(inspect.signature(objective).parameters) > 1
        loss = float(objective(trial.params, trial) if wants_trial else objective(trial.params))
        loss, state, error = (None, "FAIL", "the loss is not a number") if math.isnan(loss) else (loss, "COMPLETE", None)
    except TrialPruned as e:
        loss, state, error = trial.last, "PRUNED", str(e)
    except Exception as e:  # noqa: BLE001  a failed setting and its reason are part of the history
        if late.is_set():
            loss, state, error = trial.last, "PRUNED", f"stopped after {secs} s"
        else:
            log.warning("trial %s failed with %s: %s", trial.number, trial.params, e)
            loss, state, error = None, "FAIL", f"{type(e).__name__}: {e}"
    finally:
        if clock:
            clock.cancel()
        sc.removeJobTag(trial.tag)
    return loss, state, time.time() - start, error, {k: str(v) for k, v in trial.attrs.items()}


# ---------------------------------------------------------------- Hyperband

def nested_sample(df: DataFrame, fraction: float, seed, key) -> DataFrame:
    """The rows whose key hashes below the fraction: a larger fraction keeps all rows of a smaller one."""
    return df.where(unit_draw(seed, *as_list(key)) < fraction)


def fraction_objective(train: DataFrame, valid: DataFrame, evaluator, key, max_r: int, seed=1, build=None, kind: str | None = None):
    """(params, budget) -> loss of a model fitted on the budget / max_r sample of the training rows, scored on all validation rows."""
    make = build or (lambda p: S.model_from_params(p, kind))

    def objective(params: dict, budget: int) -> float:
        rows = train if budget >= max_r else nested_sample(train, budget / max_r, seed, key)
        return S.loss_of(evaluator, float(evaluator.evaluate(make(params).fit(rows).transform(valid))))

    return objective


def hyperband(spark: SparkSession, objective, spec: dict, max_r: int = 27, eta: int = 3, seed: int = 1, parallelism: int = 4) -> DataFrame:
    """All brackets of Hyperband side by side, their fits shared among `parallelism` workers.

    Bracket s draws its own settings and gives each rung's best 1 / eta the next larger budget. Rows: bracket, rung, budget, trial, loss, params;
    a fit that fails has the loss null and goes no further.
    """
    brackets = S.hyperband_brackets(max_r, eta)
    first = [sum(rungs[0][0] for rungs in brackets[:i]) for i in range(len(brackets))]
    drawn = K.sample_space(spark, spec, first[-1] + brackets[-1][0][0], seed).orderBy("draw").collect()  # bounded by the brackets
    settings = [K.params_of(row.asDict(), spec) for row in drawn]

    def fit(trial: int, budget: int) -> float | None:
        try:
            loss = float(objective(settings[trial], budget))
        except Exception as e:  # noqa: BLE001
            log.warning("setting %s failed: %s", settings[trial], e)
            return None
        return None if math.isnan(loss) else loss

    def bracket(i: int, workers) -> list[tuple]:
        alive, rows = list(range(first[i], first[i] + brackets[i][0][0])), []
        for rung, (n, budget) in enumerate(brackets[i]):
            alive = alive[:n]
            losses = dict(zip(alive, workers.map(inheritable_thread_target(spark)(lambda t: fit(t, budget)), alive)))
            rows += [(i, rung, budget, t, losses[t], {k: str(v) for k, v in settings[t].items()}) for t in alive]
            alive = sorted((t for t in alive if losses[t] is not None), key=lambda t: (losses[t], t))
        return rows

    with ThreadPoolExecutor(parallelism) as workers, ThreadPoolExecutor(len(brackets)) as each:
        rows = [row for part in each.map(lambda i: bracket(i, workers), range(len(brackets))) for row in part]
    return spark.createDataFrame(rows, "bracket int, rung int, budget int, trial long, loss double, params map<string,string>")


# ---------------------------------------------------------------- pipelines from a template

#: Operators of each kind of slot, as (input column, output column, parameters) -> stage.
SELECTORS = {"variance": lambda i, o, p: ML.VarianceThresholdSelector(featuresCol=i, outputCol=o, **p),
             "univariate": lambda i, o, p: ML.UnivariateFeatureSelector(featuresCol=i, outputCol=o, selectionMode="numTopFeatures").setFeatureType("continuous").setLabelType("categorical")
             .setSelectionThreshold(p.get("top", 2))}
TRANSFORMERS = {"standard": lambda i, o, p: ML.StandardScaler(inputCol=i, outputCol=o, withMean=True, **p), "minmax": lambda i, o, p: ML.MinMaxScaler(inputCol=i, outputCol=o, **p),
                "robust": lambda i, o, p: ML.RobustScaler(inputCol=i, outputCol=o, **p), "normalize": lambda i, o, p: ML.Normalizer(inputCol=i, outputCol=o, **p),
                "pca": lambda i, o, p: ML.PCA(inputCol=i, outputCol=o, **p), "polynomial": lambda i, o, p: ML.PolynomialExpansion(inputCol=i, outputCol=o, **p)}
SLOTS = {"Selector": SELECTORS, "Transformer": TRANSFORMERS, "Classifier": CLASSIFIERS, "Regressor": REGRESSORS}

#: One gene: (operator, its parameters).
Gene = tuple[str, dict]


@dataclass(frozen=True)
class Template:
    """Slots in a row, such as `Selector-Transformer-Classifier`; the last one is the model. A slot may also name one operator.

    `config` lists the operators of each slot and the values of their parameters: {slot: {operator: {parameter: [values]}}}.
    """

    text: str
    config: dict[str, dict[str, dict[str, list]]]

    @property
    def slots(self) -> list[str]:
        return self.text.split("-")

    def kind(self, slot: str) -> str:
        if slot in SLOTS:
            return slot
        found = [k for k, ops in SLOTS.items() if slot in ops]
        if not found:
            raise ValueError(f"unknown slot {slot!r}")
        return found[0]

    def operators(self, slot: str) -> dict[str, dict[str, list]]:
        kind = self.kind(slot)
        allowed = self.config.get(kind, {})
        out = dict(allowed) if slot == kind else {slot: allowed.get(slot, {})}
        unknown = [op for op in out if op not in SLOTS[kind]]
        if unknown or not out:
            raise ValueError(f"slot {slot}: unknown operators {unknown}" if unknown else f"slot {slot} has no operators")
        return out

    def gene(self, slot: str, *draw) -> Gene:
        ops = self.operators(slot)
        name = sorted(ops)[int(S._driver_unit(*draw, "op") * len(ops))]
        return name, {p: values[int(S._driver_unit(*draw, "p", p) * len(values))] for p, values in ops[name].items()}

    def genotype(self, *draw) -> tuple[Gene, ...]:
        return tuple(self.gene(slot, *draw, i) for i, slot in enumerate(self.slots))

    def follows(self, genes) -> bool:
        """Is this one gene for each slot, with listed operators and values?"""
        return len(genes) == len(self.slots) and all(
            op in self.operators(s) and set(p) == set(self.operators(s)[op]) and all(v in self.operators(s)[op][k] for k, v in p.items()) for s, (op, p) in zip(self.slots, genes))

    def crossover(self, a, b, *draw) -> tuple[Gene, ...]:
        """The first slots of one parent and the others of the second, so that every gene stays in its slot."""
        cut = 1 + int(S._driver_unit(*draw, "cut") * (len(a) - 1)) if len(a) > 1 else 1
        return tuple(a[:cut]) + tuple(b[cut:])

    def mutate(self, genes, *draw) -> tuple[Gene, ...]:
        """One slot drawn anew: the operator with its parameters, or one parameter of the operator it has."""
        i = int(S._driver_unit(*draw, "slot") * len(genes))
        op, params = genes[i]
        fresh = self.gene(self.slots[i], *draw, "new")
        if params and S._driver_unit(*draw, "what") < 0.5:
            name = sorted(params)[int(S._driver_unit(*draw, "which") * len(params))]
            values = self.operators(self.slots[i])[op][name]
            fresh = op, {**params, name: values[int(S._driver_unit(*draw, "value") * len(values))]}
        return (*genes[:i], fresh, *genes[i + 1 :])

    def build(self, genes, features: str = "features", label: str = "label") -> Pipeline:
        stages, at = [], features
        for i, (slot, (op, params)) in enumerate(zip(self.slots, genes)):
            kind = self.kind(slot)
            if kind in ("Classifier", "Regressor"):
                stages.append(with_params(estimator(op, at, label), params))
            else:
                stage = SLOTS[kind][op](at, f"__step{i}", params)
                stages.append(stage.setLabelCol(label) if stage.hasParam("labelCol") else stage)
                at = f"__step{i}"
        return Pipeline(stages=stages)


def _named(genes) -> str:
    return json.dumps(genes, sort_keys=True)


def evolve_pipelines(df: DataFrame, template: Template, evaluator, key, folds: int = 5, generations: int = 5, population: int = 10, mutation: float = 0.9, seed: int = 1,
                     label: str = "label", parallelism: int = 4) -> tuple[DataFrame, PipelineModel]:
    """Breed pipelines that follow a template, by their mean loss over folds. Returns all generations and the best pipeline, fitted on all rows.

    The better half of a generation are parents, the best one goes on unchanged; children are crossed and then mutated with the given rate. A pipeline is
    fitted once however often it is bred; one that fails has the loss null and ranks last.
    """
    spark = df.sparkSession
    rows = kfold(df, folds, seed, key, "__fold").persist()
    cache, out = {}, []

    def loss(genes) -> float:
        try:
            pipe, total = template.build(genes, label=label), 0.0
            for fold in range(folds):
                total += S.loss_of(evaluator, float(evaluator.evaluate(pipe.fit(rows.where(F.col("__fold") != fold)).transform(rows.where(F.col("__fold") == fold)))))
            return total / folds
        except Exception as e:  # noqa: BLE001
            log.warning("pipeline %s failed: %s", genes, e)
            return math.inf

    try:
        pool = [template.genotype(seed, "start", i) for i in range(population)]
        for g in range(generations):
            todo = list({_named(p): p for p in pool if _named(p) not in cache}.values())
            with ThreadPoolExecutor(parallelism) as ex:
                cache.update(zip(map(_named, todo), ex.map(inheritable_thread_target(spark)(loss), todo)))
            ranked = sorted(pool, key=lambda p: (cache[_named(p)], _named(p)))
            for i, p in enumerate(ranked):
                found = cache[_named(p)]
                out.append((g, i, found if math.isfinite(found) else None, [(s, op, {k: str(v) for k, v in params.items()}) for s, (op, params) in zip(template.slots, p)]))
            parents = ranked[: max(2, population // 2)]
            pool = parents[:1]
            while len(pool) < population:
                draw = (seed, g, len(pool))
                a, b = (parents[int(S._driver_unit(*draw, x) * len(parents))] for x in "ab")
                child = template.crossover(a, b, *draw)
                pool.append(template.mutate(child, *draw) if S._driver_unit(*draw, "m") < mutation else child)
        best = min(ranked, key=lambda p: (cache[_named(p)], _named(p)))
        if not math.isfinite(cache[_named(best)]):
            raise RuntimeError("no pipeline could be fitted")
        model = template.build(best, label=label).fit(rows.drop("__fold"))
    finally:
        rows.unpersist()
    return spark.createDataFrame(out, "generation int, rank int, loss double, pipeline array<struct<slot:string,operator:string,params:map<string,string>>>"), model


# ---------------------------------------------------------------- after a search

def refit_best(history: DataFrame, rows: DataFrame, kind: str | None = None, build=None, direction: str = "minimize"):
    """The best completed setting, fitted on all the given rows. A study without a completed trial raises, with the first failure's reason."""
    best = S.best_trial(history, direction).first()
    if best is None or best["number"] is None:
        failed = history.where("error IS NOT NULL").orderBy("number").select("error").first() if "error" in history.columns else None
        raise RuntimeError(f"no trial was completed{': ' + failed[0] if failed else ''}")
    make = build or (lambda p: S.model_from_params(p, kind))
    return make(dict(best["params"])).fit(rows)


def held_out_report(model, test: DataFrame, metrics, label: str = "label") -> DataFrame:
    """(metric, value) of a fitted model on rows that neither the fits nor the choice have seen."""
    scored = model.transform(test).persist()
    try:
        rows = [(m, float(S.metric_evaluator(m, label).evaluate(scored))) for m in as_list(metrics)]
    finally:
        scored.unpersist()
    return test.sparkSession.createDataFrame(rows, "metric string, value double")
