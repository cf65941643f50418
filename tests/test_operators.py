"""Literal examples and properties."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ferrolite.functions.store import work_dir
from ferrolite.operators import encode as N, evaluate as J, explain as L, models as I, profile as P, scale as C, search as S, shape as B, space as K, split as H, synthesize as M, text as X
from ferrolite.sources import readers as R, writers as W
from ferrolite.streaming import streams as T


@pytest.fixture(scope="module")
def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


@pytest.fixture(scope="module")
def scored(orders):
    return orders.select((F.col("o_totalprice") > 250000).cast("int").alias("label"), (F.col("o_custkey") % 17).cast("double").alias("score")).persist()


# ------------------------------------------------------------ small cases

def test_binary_digits_of_first_seen_codes(spark):
    df = spark.createDataFrame(list(enumerate(["oak", "elm", "oak", "fir", "elm", "ash"])), "i int, c string")
    out = N.binary_encode(df, "c", "i").orderBy("i").collect()
    codes = {"oak": 1, "elm": 2, "fir": 3, "ash": 4}
    assert [4 * r["c_0"] + 2 * r["c_1"] + r["c_2"] for r in out] == [codes[r["c"]] for r in out]


def test_correlations_equal_numpy(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(40, 3)) @ np.array([[1.0, 0.4, 0.0], [0.0, 1.0, -0.7], [0.0, 0.0, 1.0]])
    df = spark.createDataFrame([tuple(map(float, row)) for row in x], "a double, b double, d double")
    for method, data in (("pearson", x), ("spearman", x.argsort(axis=0).argsort(axis=0))):
        want = np.corrcoef(data.T)
        for r in P.corr_matrix(df, ["a", "b", "d"], method).collect():
            assert r["corr"] == pytest.approx(want["abd".index(r["a"]), "abd".index(r["b"])], abs=1e-5)


def test_chi_square_equals_the_ml_test(spark):
    df = spark.range(90).select((F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 3).cast("double").alias("even"), F.floor(F.sqrt("id") + F.col("id") % 2 * 3).cast("double").alias("tied"))
    got = {r["feature"]: (r["statistic"], r["degrees"]) for r in P.chi_square(df, ["even", "tied"], "y").collect()}
    want = {r["feature"]: (r["statistic"], r["degrees"]) for r in P.chi_square_test(df, ["even", "tied"], "y").collect()}
    assert got["even"] == pytest.approx(want["even"]) and got["tied"] == pytest.approx(want["tied"])
    assert got["even"][0] == pytest.approx(0.0) and got["tied"][0] > 10


def test_weighted_means(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, size=(25, 3)).astype(float)
    df = spark.createDataFrame([tuple(map(float, row)) for row in x], "a double, b double, w double")
    got = [r["mean"] for r in P.weighted_summary(df, ["a", "b"], "w").orderBy("column").collect()]
    assert got == pytest.approx(np.average(x[:, :2], axis=0, weights=x[:, 2]).tolist(), abs=1e-5)


def test_changed_parameters_leave_the_estimator_alone(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(60).select(F.col("id").cast("double").alias("x"), (F.col("id") + F.col("id") % 5 * 4 > 34).cast("double").alias("label")))
    plain = I.estimator("logistic", maxIter=25)
    tight = I.with_params(plain, {"regParam": 2.0, "elasticNetParam": None})
    assert plain.getRegParam() == 0.0 and tight.getRegParam() == 2.0 and tight.getMaxIter() == 25
    assert abs(tight.fit(df).coefficients[0]) < abs(plain.fit(df).coefficients[0])
    rows = {r["param"]: (r["value"], r["is_set"]) for r in I.params_table(spark, tight).collect()}
    assert rows["regParam"] == ("2.0", True) and rows["elasticNetParam"][1] is False


def test_polynomial_minimum(spark):
    coefs = [1, -2, -28, 28, 12, -26, 100]

    def f(x):
        acc = F.lit(0.0)
        for c in coefs:
            acc = acc * x + F.lit(float(c))
        return acc * 0.05

    got = S.minimize_on_grid(spark, f, -5.0, 6.0, 10000).first()
    xs = np.linspace(-5, 6, 10000)
    ys = np.polyval(coefs, xs) * 0.05
    assert got["x"] == pytest.approx(xs[ys.argmin()], abs=1e-9) and got["y"] == pytest.approx(ys.min())


def test_dfs_names(spark):
    customers = spark.createDataFrame([(1, "2011-04-17"), (2, "2012-04-15"), (3, "2011-08-13")], "customer_id long, join_date string").withColumn("join_date", F.to_date("join_date"))
    sessions = spark.createDataFrame([(10, 1), (11, 1), (12, 3)], "session_id long, customer_id long")
    es = M.EntitySet({"customers": M.Entity(customers, "customer_id", "join_date"), "sessions": M.Entity(sessions, "session_id")}, [("customers", "sessions", "customer_id")])
    df, names = M.dfs(es, "customers", ["count"], ["month"])
    assert {"COUNT(sessions)", "MONTH(join_date)"} <= set(names)
    got = {r["customer_id"]: (r["COUNT(sessions)"], r["MONTH(join_date)"]) for r in df.collect()}
    assert got == {1: (2, 4), 2: (0, 4), 3: (1, 8)}
    with pytest.raises(ValueError):
        M.dfs(es, "customers", ["count"], ["month"], max_features=1)


# ------------------------------------------------------------ splits and folds

def test_split_is_a_partition_and_stable(orders):
    parts = H.split(orders, [0.5, 0.3, 0.2], 4, "o_orderkey")
    again = H.split(orders.repartition(13), [0.5, 0.3, 0.2], 4, "o_orderkey")
    keys = [{r[0] for r in p.select("o_orderkey").collect()} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == orders.count()
    assert keys == [{r[0] for r in p.select("o_orderkey").collect()} for p in again]


def test_stratified_folds_are_even(orders):
    rows = H.stratified_kfold(orders, "o_orderstatus", 5, 1, "o_orderkey").groupBy("o_orderstatus", "fold").count().collect()
    for s in {r["o_orderstatus"] for r in rows}:
        sizes = [r["count"] for r in rows if r["o_orderstatus"] == s]
        assert max(sizes) - min(sizes) <= 1


# ------------------------------------------------------------ metrics against the library

def test_binary_metrics_match_library(scored):
    auc = J.auc_roc(scored).first()[0]
    lib = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert auc == pytest.approx(lib.evaluate(scored), abs=1e-6)
    assert J.auc_pr(scored).first()[0] == pytest.approx(lib.setMetricName("areaUnderPR").evaluate(scored), abs=1e-6)
    flipped = J.auc_roc(scored.withColumn("score", -F.col("score"))).first()[0]
    assert auc + flipped == pytest.approx(1.0, abs=2e-6)


def test_multiclass_and_regression_metrics_match_library(orders):
    df = orders.select(F.substring("o_orderpriority", 1, 1).cast("double").alias("label"), (F.col("o_custkey") % 5 + 1).cast("double").alias("prediction"))
    row = J.weighted_label_stats(df).first()
    for mine, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"), ("weighted_fpr", "weightedFalsePositiveRate")):
        assert row[mine] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=2e-5)
    reg = J.regression_stats(df).first()
    for name in ("mse", "rmse", "mae", "r2"):
        assert reg[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df), abs=1e-5)


# ------------------------------------------------------------ encoders and scalers

def test_encoders_use_the_training_frame_only(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 1.0)], "c string, y double")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = [r["c_m_estimate"] for r in N.target_family_encode(test, "c", "y", "m_estimate", fit_on=train).orderBy(F.col("c").asc_nulls_last()).collect()]
    assert got == pytest.approx([(1 + 2 / 3) / 3, 2 / 3, 2 / 3])
    coded = [r["c_index"] for r in N.index_categories(test, "c", fit_on=train, unknown=-1).orderBy(F.col("c").asc_nulls_last()).collect()]
    assert coded == [0, -1, -1]
    assert C.fit_clean(train, "y", "mean") == {"y": pytest.approx(2 / 3)}
    with pytest.raises(ValueError):
        N.fit_target_table(train, "c", "y", "other")


def test_gauss_rank(spark):
    got = C.gauss_rank(spark.range(200).withColumn("v", (F.col("id") * 7) % 200), "v", "id").orderBy("v").collect()
    want = [NormalDist().inv_cdf((i + 0.5) / 200) for i in range(200)]
    assert [r["gauss"] for r in got] == pytest.approx(want, abs=1e-6)


def test_contrasts_are_orthonormal():
    m = N.contrast_matrix(6, "polynomial")
    assert np.allclose(m.T @ m, np.eye(5)) and np.allclose(m.sum(0), 0)


@pytest.mark.parametrize("chunk", [4, 1024])
def test_oversample_of_a_tiny_class(spark, chunk):
    df = spark.range(101).withColumn("y", (F.col("id") == 0).cast("int"))
    out = C.oversample(df, "y", 1, "id", chunk=chunk)
    rows = {r["y"]: (r["n"], r["d"]) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("d")).collect()}
    assert rows == {0: (100, 1), 1: (100, 100)}


def test_sketch_transform_is_monotone(spark):
    df = spark.range(1000).withColumn("v", F.sqrt("id"))
    rows = C.quantile_transform_sketch(df, "v", df, 100).orderBy("v").collect()
    u = [r["uniform"] for r in rows]
    assert u == sorted(u) and abs(u[500] - 0.5) < 0.03


# ------------------------------------------------------------ text

def test_text_featurizer_and_padding(spark):
    df = spark.createDataFrame([(1, "The cat sat. The dog!"), (2, "")], "id long, text string")
    feats = X.text_featurizer(n=32).fit(df).transform(df)
    assert feats.count() == 2
    seq = X.texts_to_sequences(X.tokenize(df), "id", 3)
    assert [r["sequence"] for r in X.pad_sequences(seq, "sequence", 4).orderBy("id").collect()][1] == [0, 0, 0, 0]


# ------------------------------------------------------------ models

@pytest.fixture(scope="module")
def noisy(spark):
    df = spark.range(3000).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    df = df.withColumn("junk", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000.0)
    df = df.withColumn("label", F.col("x") * 10 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 500.0)
    return VectorAssembler(inputCols=["x", "junk"], outputCol="features").transform(df).persist()


@pytest.mark.parametrize("alpha", [0.2, 0.8])
def test_quantile_coverage(noisy, alpha):
    m = I.fit_quantile(noisy, alpha)
    covered = m.transform(noisy).agg(F.avg((F.col("label") <= F.col("prediction")).cast("double"))).first()[0]
    assert covered == pytest.approx(alpha, abs=0.04)


def test_none_parameters_keep_defaults():
    est = I.estimator("decision_tree", maxDepth=None)
    assert est.getMaxDepth() == 5
    assert I.estimator("gbt", numTrees=7).getMaxIter() == 7
    with pytest.raises(ValueError):
        I.estimator("no such model")


def test_out_of_fold_predictions_cover_every_row(noisy):
    out = I.cross_val_predict(noisy, I.estimator("linear"), 3, "id", keep="label")
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000
    assert J.regression_stats(out).first()["r2"] > 0.9


def test_grouped_fit_matches_numpy(noisy):
    df = noisy.withColumn("g", F.when(F.col("id") % 4 == 0, "a").otherwise("b"))
    got = {r["g"]: (r["intercept"], r["x"], r["junk"]) for r in I.grouped_fit(df, "g", ["x", "junk"], "label").collect()}
    rows = df.where("g = 'a'").select("x", "junk", "label").toPandas().to_numpy()
    want = np.linalg.lstsq(np.c_[np.ones(len(rows)), rows[:, :2]], rows[:, 2], rcond=None)[0]
    assert got["a"] == pytest.approx(tuple(want), abs=1e-6)


def test_early_stop_and_importances(spark, noisy):
    df = noisy.withColumn("valid", F.col("id") % 5 == 0)
    m = I.early_stop("gbt_reg", df, "valid", maxIter=15, maxDepth=3, tol=0.05)
    assert m.getNumTrees < 15
    assert L.importances(df, m, ["x", "junk"]).first()["feature"] == "x"
    assert L.select_by_model(df, m, ["x", "junk"]).columns == ["x"]


def test_boruta_finds_the_signal(noisy):
    df = noisy.withColumn("y", (F.col("label") > 5).cast("double"))
    got = {r["feature"]: r["decision"] for r in L.boruta(df, ["x", "junk"], "y", "id", max_iter=9, trees=10, depth=3).collect()}
    assert got["x"] == "confirmed" and got["junk"] != "confirmed"


def test_train_any_and_predictor(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "n_chars", F.col("lang").eqNullSafe("en").cast("double").alias("y"))
    p = S.Predictor("classifier", {"y": "output", "doc_id": "ignore"}).train(d, "logistic", num_features=256, maxIter=10, regParam=0.01)
    assert p.score(d).first()[0] > 0.9
    with pytest.raises(ValueError):
        S.Predictor("classifier", {"y": "ignore"})


def test_lime_blames_the_telling_part(spark):
    texts = [(i, "good word here. filler text now. more filler text.", 1.0) if i % 2 else (i, "bad word here. filler text now. more filler text.", 0.0) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, text string, label double")
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, Tokenizer
    model = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="t"), HashingTF(inputCol="t", outputCol="features", numFeatures=128), I.estimator("logistic", regParam=0.01)]).fit(df)
    rows = L.lime_text(df.where("id = 1"), model, "id", n=40).collect()
    assert max(rows, key=lambda r: abs(r["weight"]))["part_no"] == 0


# ------------------------------------------------------------ search

def test_tpe_with_one_candidate_returns_it(spark):
    spec = {"a": K.uniform(0, 1)}
    trials = spark.createDataFrame([(0.1, 0.5), (0.9, 0.1), (0.4, 0.7)], "loss double, a double")
    pool = K.sample_space(spark, spec, 1, 3, start=42)
    assert S.tpe_suggest(trials, pool, spec).first()["draw"] == 42


def test_tpe_and_forest_prefer_the_good_region(spark):
    spec = {"a": K.uniform(0, 1)}
    trials = spark.range(60).withColumn("a", F.col("id") / 60.0).withColumn("loss", F.abs(F.col("a") - 0.25))
    pool = K.sample_space(spark, spec, 40, 5)
    for suggest in (S.tpe_suggest, S.forest_suggest):
        i = suggest(trials, pool, spec).first()["draw"]
        assert abs(pool.where(F.col("draw") == i).first()["a"] - 0.25) < 0.15


def test_conditional_parameters_never_reach_the_estimator(spark):
    spec = {"model": K.choice({"decision_tree": {"maxDepth": K.integer(2, 4)}, "logistic": {"regParam": K.loguniform(-5, 0)}})}
    for row in K.sample_space(spark, spec, 20, 1).collect():
        params = K.params_of(row.asDict(), spec)
        assert len(params) == 2 and all(params["model"] in k for k in params if k != "model")
        est = S.model_from_params(params)
        assert est.getOrDefault("maxDepth") >= 2 if params["model"] == "decision_tree" else est.getRegParam() > 0


def test_tune_stores_and_resumes(spark):
    spec, path = {"a": K.uniform(-2, 2)}, work_dir(spark, "tune")
    first = S.tune(spark, lambda p: (p["a"] - 1) ** 2, spec, path, "s", "tpe", 6, n_candidates=8)
    assert sorted(r["number"] for r in first.collect()) == list(range(6))
    more = S.resume(spark, lambda p: (p["a"] - 1) ** 2, spec, path, "s", algo="random", max_evals=3)
    assert sorted(r["number"] for r in more.collect()) == list(range(9))
    assert abs(float(S.best_params(more)["a"]) - 1) < 1
    assert S.tune(spark, lambda p: 1 / 0, spec, work_dir(spark, "fail"), "f", "random", 1).first()["state"] == "FAIL"


def test_hyperband_and_halving(spark):
    assert S.hyperband_brackets(9, 3) == [[(9, 1), (3, 3), (1, 9)], [(5, 3), (1, 9)], [(3, 9)]]
    out = S.successive_halving(spark, lambda p, b: p["a"] / b, {"a": K.uniform(0, 1)}, 9, 3, 1, 9)
    assert [r["count"] for r in out.groupBy("rung").count().orderBy("rung").collect()] == [9, 3, 1]


def test_evolution_does_not_get_worse(spark):
    out = S.evolve(spark, lambda p: abs(p["a"] - 0.3), {"a": K.uniform(0, 1)}, 4, 6)
    best = [r["b"] for r in out.groupBy("generation").agg(F.min("loss").alias("b")).orderBy("generation").collect()]
    assert best == sorted(best, reverse=True)


# ------------------------------------------------------------ series, sources, streams

@pytest.mark.parametrize("block", [16, 2048])
def test_approx_entropy_in_blocks(spark, block):
    x = [math.sin(i / 3) * 5 + (i * 7919 % 13) / 4 for i in range(120)] + [1.0] * 30
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "id long, t long, v double")

    def phi(m):
        w = np.array([x[i:i + m] for i in range(len(x) - m + 1)])
        c = (np.abs(w[:, None] - w[None]).max(-1) <= 1.5).sum(1)
        return np.log(c / len(w)).mean()

    got = M.approx_entropy(df, "id", "t", "v", 2, 1.5, block=block).first()["approx_entropy"]
    assert got == pytest.approx(phi(2) - phi(3), abs=1e-5)


def test_images_and_nested_unroll(spark, tmp_path):
    import struct
    w = h = 2
    pixels = bytes(range(12))
    body = b"".join(pixels[r * 6:(r + 1) * 6] + b"\0\0" for r in range(h))
    header = b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0)
    (tmp_path / "a.bmp").write_bytes(header + body)
    row = R.read_images(spark, str(tmp_path)).first()
    assert (row["height"], row["width"], row["nChannels"]) == (2, 2, 3)
    assert R.read_images(spark, str(tmp_path), decode=False).first()["length"] == len(header) + len(body)
    df = spark.createDataFrame([(1, [[[1, 2], [3, 4]]])], "id int, image array<array<array<int>>>")
    assert C.array_to_unit_rows(df, "image", levels=2).first()["flat"] == [1.0, 2.0, 3.0, 4.0]


def test_delimited_header_and_inner_separators(spark, tmp_path):
    (tmp_path / "t.txt").write_text("ID||Text\n1||plain\n2||has || inside\n")
    rows = [tuple(r) for r in R.read_delimited(spark, str(tmp_path), ["ID", "Text"]).orderBy("ID").collect()]
    assert rows == [("1", "plain"), ("2", "has || inside")]
    with pytest.raises(ValueError):
        R.read_csv(spark, str(tmp_path))


def test_stream_score_equals_batch_and_restarts(spark, sf):
    from pyspark.ml import Pipeline
    events = spark.read.parquet(f"{sf}/events.parquet")
    parsed = events.select("event_id", "value", F.from_json("props", "k double").alias("p")).select("event_id", "value", "p.k")
    model = Pipeline(stages=[VectorAssembler(inputCols=["k"], outputCol="features"), I.estimator("linear", label="value")]).fit(parsed)
    src, sink, ck = work_dir(spark, "src"), work_dir(spark, "sink"), work_dir(spark, "ck")
    events.repartition(4).write.parquet(src)
    stream = T.stream_files(spark, src, events.schema, files_per_batch=2)
    for _ in range(2):  # the second run finds nothing new
        T.stream_score(stream, "props", "k double", model, sink, ck, keep=["event_id"])
    got = {r["event_id"]: round(r["prediction"], 9) for r in spark.read.parquet(sink).collect()}
    want = {r["event_id"]: round(r["prediction"], 9) for r in model.transform(parsed).collect()}
    assert got == want and spark.read.parquet(sink).count() == events.count()


def test_udf_stage_takes_a_pandas_udf(spark):
    import pandas as pd

    @F.pandas_udf("long")
    def size(s: pd.Series) -> pd.Series:
        return s.str.len()

    df = spark.createDataFrame([("abc",)], "t string")
    assert B.udf_stage("t", "n", size).transform(df).first()["n"] == 3
