"""Trials that report and are ended, Hyperband's brackets and samples, pipelines from a template, the report after a search."""

import math
import threading
import time

import pytest
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ferrolite.functions.store import work_dir
from ferrolite.operators import search as S, space as K, split, trials as R
from ferrolite.operators.stages import CurveEvaluator


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select("id", F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("x"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10)).cast("double").alias("z"), F.lit(1.0).alias("same"))
    df = df.withColumn("label", (F.col("x") + 3 * F.col("z") > 65).cast("double"))
    return VectorAssembler(inputCols=["x", "z", "same"], outputCol="features").transform(df).cache()


def test_bad_trials_end_early(spark):
    path = work_dir(spark, "prune")

    def objective(params, trial):
        trial.attrs["kind"] = "good" if trial.number < 3 else "late"
        for step in range(4):
            trial.report(step, 1.0 - step / 10 if trial.number != 3 else 5.0)
        return 0.5

    history = S.tune(spark, objective, {"a": K.uniform(0, 1)}, path, "s", "random", 5, pruner=R.MedianPruner(startup=3, warmup=1))
    got = {r["number"]: (r["state"], r["value"], r["user_attrs_kind"]) for r in S.trials_dataframe(history, "s", (), "kind").collect()}
    assert got == {i: ("COMPLETE", 0.5, "good") for i in range(3)} | {3: ("PRUNED", 5.0, "late"), 4: ("COMPLETE", 0.5, "late")}
    steps = {r["trial"]: r["n"] for r in R.read_steps(spark, path, "s").groupBy("trial").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert steps == {0: 4, 1: 4, 2: 4, 3: 2, 4: 4}
    assert S.best_trial(history).first()["number"] == 0



def test_pruning_stops_jobs_of_other_threads(spark):
    ended = []

    def slow():
        try:
            spark.range(8).repartition(8).mapInPandas(lambda it: (time.sleep(60) or b for b in it), "id long").collect()
        except Exception:  # noqa: BLE001
            ended.append(time.time())

    def objective(params, trial):
        thread = threading.Thread(target=inheritable_thread_target(spark)(slow))
        thread.start()
        time.sleep(3)
        trial.cancel()
        thread.join(30)
        raise R.TrialPruned("stop")

    start = time.time()
    row = S.tune(spark, objective, {"a": K.uniform(0, 1)}, work_dir(spark, "cancel"), "s", "random", 1).first()
    assert row["state"] == "PRUNED" and ended and ended[0] - start < 30
    assert spark.range(5).count() == 5


def test_time_limit_and_failures(spark):
    def endless(params):
        return spark.range(4).mapInPandas(lambda it: (time.sleep(60) or b for b in it), "id long").count()

    start = time.time()
    row = S.tune(spark, endless, {"a": K.uniform(0, 1)}, work_dir(spark, "late"), "s", "random", 1, trial_secs=3).first()
    assert row["state"] == "PRUNED" and "3 s" in row["error"] and time.time() - start < 40
    failed = S.tune(spark, lambda p: 1 / 0, {"a": K.uniform(0, 1)}, work_dir(spark, "fail"), "f", "random", 2)
    assert {(r["state"], r["error"]) for r in failed.collect()} == {("FAIL", "ZeroDivisionError: division by zero")}
    assert S.tune(spark, lambda p: math.nan, {"a": K.uniform(0, 1)}, work_dir(spark, "nan"), "f", "random", 1).first()["state"] == "FAIL"
    with pytest.raises(RuntimeError, match="division by zero"):
        R.refit_best(failed, spark.range(3))


def test_samples_are_nested(spark, rows):
    before = set()
    for share in (0.1, 0.3, 0.9, 1.0):
        ids = {r["id"] for r in R.nested_sample(rows, share, 1, "id").select("id").collect()}
        assert before <= ids and abs(len(ids) / 900 - share) < 0.06
        before = ids
    assert len(before) == 900


def test_hyperband_brackets_and_survivors(spark):
    seen = []
    out = R.hyperband(spark, lambda p, b: seen.append(b) or (1 / 0 if p["a"] > 0.9 else p["a"] / b), {"a": K.uniform(0, 1)}, 9, 3, parallelism=3).collect()
    brackets = S.hyperband_brackets(9, 3)
    for i, rungs in enumerate(brackets):
        earlier = None
        for j, (n, budget) in enumerate(rungs):
            at = [r for r in out if (r["bracket"], r["rung"]) == (i, j)]
            assert {r["budget"] for r in at} == {budget} and len(at) <= n and (j > 0 or len(at) == n)
            if earlier is not None:
                best = sorted((r["loss"], r["trial"]) for r in earlier if r["loss"] is not None)[:n]
                assert {r["trial"] for r in at} == {t for _, t in best}
            earlier = at
    assert len({r["trial"] for r in out}) == sum(rungs[0][0] for rungs in brackets) and len(seen) == len(out)
    assert all((r["loss"] is None) == (float(r["params"]["a"]) > 0.9) for r in out)


def test_budget_is_a_share_of_the_rows(spark, rows):
    train, valid = split.split(rows, [0.7, 0.3], 1, "id")
    fitted = []

    class Seen:
        def fit(self, df):
            fitted.append({r["id"] for r in df.select("id").collect()})
            return self

        def transform(self, df):
            return df.withColumn("probability", F.lit(0.5))

    objective = R.fraction_objective(train, valid, CurveEvaluator(metricName="log_loss"), "id", 9, build=lambda p: Seen())
    assert objective({}, 1) == objective({}, 3) == objective({}, 9)
    assert fitted[0] < fitted[1] < fitted[2] == {r["id"] for r in train.select("id").collect()}


CONFIG = {"Selector": {"variance": {"varianceThreshold": [0.0, 0.5]}, "univariate": {"top": [1, 2]}}, "Transformer": {"standard": {}, "pca": {"k": [1, 40]}},
          "Classifier": {"logistic": {"regParam": [0.0, 0.1]}, "decision_tree": {"maxDepth": [2, 3]}}}


def test_offspring_follow_the_template():
    template = R.Template("Selector-Transformer-Transformer-Classifier", CONFIG)
    pool = [template.genotype(1, i) for i in range(20)]
    for i in range(200):
        a, b = pool[i % 20], pool[(7 * i + 3) % 20]
        child = template.crossover(a, b, i)
        assert template.follows(child) and all(g in (x, y) for g, x, y in zip(child, a, b))
        changed = template.mutate(child, i)
        assert template.follows(changed) and sum(g != h for g, h in zip(child, changed)) <= 1
        pool[i % 20] = changed
    assert len({R._named(p) for p in pool}) > 5
    fixed = R.Template("Selector-logistic", CONFIG).genotype(3)
    assert fixed[1][0] == "logistic" and not template.follows(fixed)
    with pytest.raises(ValueError):
        R.Template("Selector-nothing", CONFIG).genotype(1)


def test_pipelines_evolve(spark, rows):
    template = R.Template("Selector-Transformer-Classifier", CONFIG)
    history, model = R.evolve_pipelines(rows, template, CurveEvaluator(metricName="auc"), "id", folds=2, generations=2, population=4, parallelism=2)
    got = history.collect()
    assert len(got) == 8 and all([g["slot"] for g in r["pipeline"]] == template.slots for r in got)
    best = [min(r["loss"] for r in got if r["generation"] == g and r["loss"] is not None) for g in (0, 1)]
    assert best[1] <= best[0] < -0.6
    assert any(r["loss"] is None for r in got) == any(g["params"].get("k") == "40" for r in got for g in r["pipeline"])
    assert len(model.stages) == 3 and CurveEvaluator().evaluate(model.transform(rows)) > 0.6


def test_report_on_held_out_rows(spark, rows):
    train, valid, test = split.split(rows, [0.5, 0.25, 0.25], 2, "id")
    spec = {"maxDepth": K.integer(1, 5)}
    history = S.tune(spark, S.validation_objective(train, valid, S.metric_evaluator("auc"), "decision_tree"), spec, work_dir(spark, "report"), "s", "random", 3)
    model = R.refit_best(history, train.unionByName(valid), "decision_tree")
    assert model.getMaxDepth() == int(S.best_params(history)["maxDepth"])
    got = {r["metric"]: r["value"] for r in R.held_out_report(model, test, ["auc", "accuracy"]).collect()}
    assert got["auc"] == CurveEvaluator().evaluate(model.transform(test)) and 0.5 < got["accuracy"] <= 1
