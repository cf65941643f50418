"""Faults found in earlier rounds, held down."""

import re
from pathlib import Path

from pyspark.sql import Window, functions as F

from ferrolite.functions import ordered
from ferrolite.operators import encode, evaluate, models, scale, text


def test_models_with_summaries_after_ordered_work(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("label"), (F.pmod(F.xxhash64("id"), F.lit(50)) + F.col("id") % 2 * 20).cast("double").alias("x"))
    assert ordered.number_rows(df, ["x"]).count() == 400
    assert 0.5 < evaluate.auc_roc(df, "x", "label").first()[0] <= 1
    data = df.withColumn("features", models.array_to_vector(F.array("x")))
    for kind in ("logistic", "svm"):
        fitted = models.fit(kind, data, maxIter=3)
        assert fitted.transform(data).where("prediction = label").count() > 200
        assert fitted.summary().areaUnderROC > 0.5 if kind == "svm" else fitted.summary.areaUnderROC > 0.5


def test_nothing_observes():
    """An Observation makes the session unfit for the closures of models with a summary."""
    for path in Path(ordered.__file__).parents[1].rglob("*.py"):
        assert not re.search(r"\bobserve\(|\bObservation\b", path.read_text()), path


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 3000")


def test_scans_grow_with_the_columns_only(spark):
    """One scan of the frame, and one or two for each column: nothing that earlier columns added is worked out again."""
    df = spark.range(3000).select("id", *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(9)).alias(f"c{i}") for i in range(4)])
    for k in (1, 2, 4):
        cols = [f"c{i}" for i in range(k)]
        assert scans(scale.bin_quantiles(df, cols, 7, "id")) <= 1 + k
        assert scans(encode.multi_label_encode(df, cols)) <= 1 + 2 * k
        assert scans(encode.label_encode(df, cols)) <= 1 + 2 * k
    binned = scale.bin_quantiles(df, ["c0", "c3"], 7, "id")
    w = {c: Window.orderBy(c, "id") for c in ("c0", "c3")}
    assert binned.select("*", *[F.ntile(7).over(w[c]).alias(f"want_{c}") for c in w]).where("c0_bin <> want_c0 OR c3_bin <> want_c3").count() == 0
    assert binned.count() == 3000


def test_tf_idf_works_its_weights_out_once(spark):
    docs = spark.range(3000).select("id", F.array(*[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(30))) for i in range(6)]).alias("tokens"))
    weights = text.tf_idf(docs, "id", min_df=2)
    assert scans(weights) <= 4
    norms = weights.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert norms.count() == 3000 and norms.where("abs(n - 1) > 1e-9").count() == 0


def test_sequences_inside_the_row_and_by_join(spark, monkeypatch):
    rows = [(1, ["b", "a", "a", "x"]), (2, []), (3, None), (4, ["c", "a", "b", "a"]), (5, ["zz"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    want = {1: [2, 1, 1], 2: [], 3: [], 4: [3, 1, 2, 1], 5: []}
    inside = text.texts_to_sequences(df, "id", 3)
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    assert {r["id"]: r["sequence"] for r in inside.collect()} == want
    monkeypatch.setattr(text, "BROADCAST_WORDS", 0)
    assert {r["id"]: r["sequence"] for r in text.texts_to_sequences(df, "id", 3).collect()} == want
    nothing = df.where("id > 9")
    assert text.texts_to_sequences(nothing, "id", 3).count() == 0
