"""Stages that are saved and loaded, the evaluators that choose models, and the reduction to binary fits."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ferrolite.functions.store import work_dir
from ferrolite.operators import encode, evaluate, models, search, shape, split, stages as G


def blanks(c):
    return F.length(F.regexp_replace(c, "[^ ]", ""))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select("id", F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("c"), F.when(F.col("id") % 11 > 0, F.col("id") % 13).alias("n"),
                                 F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("x"))
    return df.withColumn("label", ((F.col("x") + F.col("id") % 7 * 8) > 75).cast("double"))


@pytest.mark.parametrize("method", G.TARGETS)
def test_encoder_equals_the_table_encoders(rows, method):
    train, test = rows.where("id < 400"), rows.where("id >= 300").withColumn("c", F.when(F.col("id") % 50 == 0, "new").otherwise(F.col("c")))
    model = G.CategoryEncoder(inputCols=["c", "n"], outputCols=["a", "b"], method=method).fit(train)
    got = model.transform(test)
    for col, out in (("c", "a"), ("n", "b")):
        want = encode.target_family_encode(test, col, "label", method, train, "want").select(F.col("id").alias("i"), "want")
        both = got.join(want, F.col("id") == F.col("i"))
        assert both.count() == 300 and both.where(F.abs(F.col(out) - F.col("want")) > 1e-9).count() == 0


def test_codes_follow_the_values_own_order(rows):
    train = rows.where("id < 400")
    got = G.CategoryEncoder(inputCols=["n", "c"], outputCols=["a", "b"], method="label", unknown=-9.0).fit(train).transform(rows)
    assert {(r["n"], r["a"]) for r in got.collect()} == {(None, -9.0)} | {(i, float(i)) for i in range(13)}
    got = G.CategoryEncoder(inputCols=["c"], outputCols=["a"], method="index").fit(train).transform(rows.withColumn("c", F.when(F.col("id") > 590, "new").otherwise(F.col("c"))))
    assert {r["a"] for r in got.where("c = 'new'").collect()} == {-1.0} and got.where("a >= 0").agg(F.max("a")).first()[0] == 6.0


def test_fitted_inside_each_fold_saved_and_loaded(spark, rows):
    folded = split.kfold(rows, 3, 1, "id")
    pipe = Pipeline(stages=[G.CategoryEncoder(inputCols=["c", "n"], outputCols=["a", "b"], method="target"), G.CategoryEncoder(inputCols=["c"], outputCols=["w"], method="woe"),
                            G.CategoryEncoder(inputCols=["n"], outputCols=["l"], method="label"), VectorAssembler(inputCols=["a", "b", "w", "l", "x"], outputCol="features"), models.estimator("logistic", maxIter=4)])
    for fold in range(3):
        path = work_dir(spark, "saved")
        fitted = pipe.fit(folded.where(F.col("fold") != fold))
        fitted.write().save(path)
        cols = ["id", "a", "b", "w", "l", "prediction"]
        test = folded.where(F.col("fold") == fold)
        assert sorted(fitted.transform(test).select(cols).collect()) == sorted(PipelineModel.load(path).transform(test).select(cols).collect())


def test_empty_and_one_sided_training(spark, rows):
    none = rows.limit(0)
    for method in (*G.TARGETS, *G.CODES):
        got = G.CategoryEncoder(inputCols=["c"], outputCols=["a"], method=method).fit(none).transform(rows.limit(3))
        assert got.count() == 3
    with pytest.raises(ValueError):
        G.CategoryEncoder(inputCols=["c"], outputCols=["a"], method="other").fit(rows)


@pytest.mark.parametrize("weighting", ["mean", "idf"])
def test_mean_embedding(spark, weighting):
    texts = [["a", "b", "a"], ["b", "c"], [], None, ["zzz"], ["a", "zzz", "c"]] * 6
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, words array<string>")
    model = G.MeanEmbedding(inputCol="words", outputCol="e", vectorSize=4, minCount=7, weighting=weighting).fit(df)
    path = work_dir(spark, "embedding")
    model.write().save(path)
    known = {r["term"]: np.array(r["vector"]) for r in model.table.collect()}
    assert set(known) == {"a", "b", "c", "zzz"}
    joined = G.mean_of_vectors(df, model.table, "words", "e", 4, most_bytes=0)
    for out in (model.transform(df), G.MeanEmbeddingModel.load(path).transform(df), joined):
        got = {r["id"]: r["e"] for r in out.collect()}
        for i, t in enumerate(texts):
            want = np.mean([known[w] for w in t], axis=0) if t else np.zeros(4)
            assert got[i] == pytest.approx(want.tolist())


def test_evaluators(spark, rows):
    scored = rows.withColumn("score", F.col("x") / 101 + 0.001)
    for name, fn in (("auc", evaluate.auc_roc), ("auc_pr", evaluate.auc_pr), ("ks", evaluate.ks_statistic)):
        e = G.CurveEvaluator(metricName=name, scoreCol="score")
        assert e.isLargerBetter() and e.evaluate(scored) == fn(scored).first()[0]
    e = G.CurveEvaluator(metricName="log_loss", scoreCol="score")
    want = scored.agg(F.avg(-F.ln(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))))).first()[0]
    assert not e.isLargerBetter() and e.evaluate(scored) == pytest.approx(want, abs=1e-6)
    assert math.isnan(G.CurveEvaluator(scoreCol="score").evaluate(scored.limit(0)))
    assert search.loss_of(e, math.nan) == math.inf
    with pytest.raises(ValueError):
        G.CurveEvaluator(metricName="x", scoreCol="score").evaluate(scored)


@pytest.mark.parametrize("metric", ["auc", "ks", "log_loss"])
def test_evaluators_choose_models(spark, rows, metric):
    df = split.kfold(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows), 2, 1, "id").cache()
    est = models.estimator("logistic", maxIter=5)
    result = search.cross_validate_grid(df, est, [{est.regParam: v} for v in (0.0, 50.0)], search.metric_evaluator(metric), "fold", 2)
    by_loss = [search.loss_of(search.metric_evaluator(metric), m) for m in result.metrics]
    assert result.best_model.getRegParam() == (0.0, 50.0)[by_loss.index(min(by_loss))]
    objective = search.validation_objective(df.where("fold = 0"), df.where("fold = 1"), search.metric_evaluator(metric), "logistic")
    assert objective({"regParam": 0.0}) <= objective({"regParam": 50.0})


def test_one_vs_rest_is_the_arg_max_of_separate_fits(spark):
    df = spark.range(900).select("id", (F.pmod(F.xxhash64("id"), F.lit(90)) / 10.0).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10))).cast("double").alias("z"))
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df.withColumn("label", F.least(F.floor(F.col("x") / 3), F.lit(2)).cast("double")))
    got = {r["id"]: r["prediction"] for r in models.fit_one_vs_rest("svm", df, maxIter=8).transform(df).collect()}
    margins = {}
    for k in range(3):
        one = models.fit("svm", df.withColumn("label", (F.col("label") == k).cast("double")), maxIter=8)
        for r in one.transform(df).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect():
            margins.setdefault(r["id"], []).append(r["m"])
    assert got == {i: float(np.argmax(m)) for i, m in margins.items()}


def test_stage_outlives_its_session(spark):
    df = spark.createDataFrame([("a b  c",), (None,)], "`t x` string")
    for fn in (blanks, "test_stages:blanks", "length(regexp_replace(__IN__, '[^ ]', ''))"):
        stage, path = shape.udf_stage("t x", "n", fn), work_dir(spark, "stage")
        Pipeline(stages=[stage]).fit(df).write().save(path)
        other = PipelineModel.load(path)
        fresh = spark.newSession().createDataFrame([("a b  c",), (None,)], "`t x` string")
        assert [r["n"] for r in other.transform(fresh).collect()] == [r["n"] for r in stage.transform(df).collect()] == [3, None]
    nameless = shape.udf_stage("t x", "n", lambda c: F.length(c))
    assert nameless.transform(df).first()["n"] == 6
    with pytest.raises(ValueError):
        nameless.write()


def test_grouped_predictions_leave_no_view(spark, rows):
    a = shape.predictions_by(rows, "c", "x")
    b = shape.predictions_by(rows.where("id < 100"), "c", "x")
    assert a.agg(F.sum("n")).first()[0] == 600 and b.agg(F.sum("n")).first()[0] == 100
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("scored_")]
