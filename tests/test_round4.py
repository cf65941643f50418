"""Cases of the third round's findings, on rows of their own."""

from collections import Counter
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from ferrolite.operators import explain, models, text


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_inside_the_row(spark):
    texts = {1: ["b", "a", "b", "b"], 2: ["a"], 3: [], 4: None, 5: ["c", "a", "c"]}
    df = spark.createDataFrame([*texts.items()], "id long, tokens array<string>")
    got = text.term_counts(df, "id")
    assert "Exchange" not in plan(got)
    want = {(k, w, n) for k, v in texts.items() for w, n in Counter(v or []).items()}
    assert {tuple(x) for x in got.collect()} == want
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "string", "bigint"]


def test_rows_that_share_a_key_are_counted_together(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["a"]), (None, ["a"]), (None, ["a", None]), (2, ["b"])], "id long, tokens array<string>")
    got = {tuple(x) for x in text.term_counts(df, "id").collect()}
    assert got == {(1, "a", 2), (1, "b", 1), (None, "a", 2), (None, None, 1), (2, "b", 1)}


def test_frequent_and_rare_terms_meet_their_rows(spark):
    counts = spark.createDataFrame([(i, f"t{i % 7}", i) for i in range(50)] + [(99, "gone", 1), (98, None, 1)], "id long, term string, tf long")
    table = spark.createDataFrame([(f"t{i}", 10 - i // 2) for i in range(7)] + [("t1", 2)], "term string, df long")
    want = sorted([(f"t{i % 7}", i, i, 10 - i % 7 // 2) for i in range(50)] + [("t1", i, i, 2) for i in range(1, 50, 7)])
    for most in (0, 1, 2, 3, 8):
        got = text.of_terms(counts, table, "df", most).select("term", "id", "tf", "df")
        assert sorted(tuple(x) for x in got.collect()) == want


def test_boruta_fits_on_kept_rows(spark, monkeypatch):
    """A forest goes through its rows several times: they are kept, and the shadows hold the same values as their features."""
    seen = []

    class Forest:
        def __init__(self, **kw):
            pass

        def fit(self, rows):
            plan_ = plan(rows)
            seen.append((rows.is_cached, sorted(float(r[0][0]) for r in rows.select("features").collect()), sorted(float(r[0][1]) for r in rows.select("features").collect())))
            assert "InMemoryTableScan" in plan_
            return SimpleNamespace(featureImportances=SimpleNamespace(toArray=lambda: np.array([1.0, 0.0])))

    monkeypatch.setattr(explain, "RandomForestClassifier", Forest)
    monkeypatch.setattr(explain, "KEPT_ROWS", 50)
    df = spark.range(60).select("id", (F.col("id") * 3).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    got = explain.boruta(df, ["x"], "y", "id", max_iter=2).first()
    assert got["hits"] == 2 and len(seen) == 2
    for cached, own, shadow in seen:
        assert cached and own == shadow == [3.0 * i for i in range(60)]


def _weak():
    return {"tree": models.estimator("decision_tree", maxDepth=2), "nb": models.estimator("naive_bayes", modelType="gaussian")}


def test_stacking_scores_all_models_in_one_pass(spark):
    df = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(400).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(50)) > 20).cast("double").alias("label")))
    got = models.stack_features(df, _weak(), 2, "id", "label")
    assert got.columns == [*df.columns, "weak_tree", "weak_nb"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 400") <= 2  # the rows, and the sizes of their cells
    want = {}
    for name, est in _weak().items():
        for row in models.cross_val_predict(df, est, 2, "id", "label").collect():
            want.setdefault(row["id"], {})[name] = row["prediction"]
    assert {r["id"]: {"tree": r["weak_tree"], "nb": r["weak_nb"]} for r in got.collect()} == want
    twice = df.unionByName(df.where("id < 2"))
    assert models.stack_features(twice, _weak(), 2, "id", "label").where("id < 2").count() == 2 * (2 * 2) ** 2  # joined twice


def test_lime_fits_many_texts_a_batch(spark):
    """No frame is made for each text; an empty text has no parts, one key's texts are fitted together."""
    def scored(df):
        return df.withColumn("probability", models.array_to_vector(F.array(F.lit(0.0), F.when(F.col("text").contains("good"), 0.9).otherwise(0.1))))

    df = spark.createDataFrame([(1, "good one. other part. third"), (2, ""), (3, "plain. good"), (4, "a. b"), (4, "a. b")], "id long, text string")
    got = explain.lime_text(df, SimpleNamespace(transform=scored), "id", n=40)
    assert "FlatMapGroupsInPandas" not in plan(got)
    rows = {(r["id"], r["part_no"]): r["weight"] for r in got.collect()}
    assert sorted(rows) == [(1, 0), (1, 1), (1, 2), (3, 0), (3, 1), (4, 0), (4, 1)]
    assert rows[1, 0] > 0.5 and rows[3, 1] > 0.5 and max(abs(rows[k]) for k in ((1, 1), (1, 2), (3, 0), (4, 0), (4, 1))) < 0.1
