"""Queries: saved and loaded stages, evaluators and reductions."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.cols import r, union_all
from ..functions.store import work_dir
from ..operators import evaluate as J, models as I, search as S, shape as B, split as H, stages as G, text as X
from .models import orders_frame
from .registry import query

FOLDS = 3


def _orders(t):
    return t.orders.select("o_orderkey", (F.col("o_orderkey") % FOLDS).cast("int").alias("fold"), "o_orderpriority", "o_orderstatus", (F.col("o_custkey") % 7).alias("day"),
                           (F.col("o_totalprice") > 250000).cast("double").alias("label"))


def _encoders():
    return Pipeline(stages=[G.CategoryEncoder(inputCols=["o_orderpriority", "day"], outputCols=["by_target", "day_target"], method="target"),
                            G.CategoryEncoder(inputCols=["o_orderpriority"], outputCols=["by_woe"], method="woe"),
                            G.CategoryEncoder(inputCols=["o_orderstatus", "day"], outputCols=["status_label", "day_label"], method="label")])


@query("saved_encoders_by_fold", "F4", "F21", "F26", sql="""
    WITH o AS (SELECT o_orderkey, (o_orderkey % 3)::INT AS fold, o_orderpriority AS p, o_orderstatus AS s, o_custkey % 7 AS d, (o_totalprice > 250000)::INT::DOUBLE AS y FROM orders),
    x AS (SELECT f.fold AS own, o.* FROM o, (SELECT unnest([0, 1, 2]) AS fold) f WHERE o.fold <> f.fold),
    a AS (SELECT own, avg(y) AS prior, sum(y) AS p, count(*) - sum(y) AS q FROM x GROUP BY 1),
    g AS (SELECT own, p, count(*) AS n, avg(y) AS m, sum(y) AS s FROM x GROUP BY 1, 2), h AS (SELECT own, d, count(*) AS n, avg(y) AS m FROM x GROUP BY 1, 2),
    l AS (SELECT own, s, dense_rank() OVER (PARTITION BY own ORDER BY s) - 1 AS c FROM (SELECT DISTINCT own, s FROM x)), k AS (SELECT own, d, dense_rank() OVER (PARTITION BY own ORDER BY d) - 1 AS c FROM (SELECT DISTINCT own, d FROM x))
    SELECT o_orderkey, fold, round(coalesce(a.prior + (g.m - a.prior) / (1 + exp(1 - g.n)), a.prior), 6) AS by_target, round(coalesce(a.prior + (h.m - a.prior) / (1 + exp(1 - h.n)), a.prior), 6) AS day_target,
           round(coalesce(ln(((g.s + 1) / (a.p + 2)) / ((g.n - g.s + 1) / (a.q + 2))), 0), 6) + 0.0 AS by_woe, coalesce(l.c, -1)::DOUBLE AS status_label, coalesce(k.c, -1)::DOUBLE AS day_label
    FROM o JOIN a ON a.own = fold LEFT JOIN g ON g.own = fold AND g.p = o.p LEFT JOIN h ON h.own = fold AND h.d = o.d LEFT JOIN l ON l.own = fold AND l.s = o.s LEFT JOIN k ON k.own = fold AND k.d = o.d""")
def _(t):
    """Each fold is encoded by a pipeline that was fitted on the others, saved and loaded."""
    df, path = _orders(t), work_dir(t.spark, "encoders")
    done = []
    for fold in range(FOLDS):
        _encoders().fit(df.where(F.col("fold") != fold)).write().save(f"{path}/{fold}")
        done.append(PipelineModel.load(f"{path}/{fold}").transform(df.where(F.col("fold") == fold)))
    return union_all(done).select("o_orderkey", "fold", *[r(F.col(c)).alias(c) for c in ("by_target", "day_target", "by_woe")], "status_label", "day_label")


@query("encoder_grid", "K5", "K7", "K10", "F21", "F23", "F24", "F26")
def _(t):
    """Which encoding of the categories gives the best Kolmogorov-Smirnov statistic, each fitted inside its fold?"""
    encoder = G.CategoryEncoder(inputCols=["o_orderpriority", "o_orderstatus", "c_mktsegment"], outputCols=["p", "s", "m"])
    model = I.estimator("logistic", maxIter=5)
    pipe = Pipeline(stages=[encoder, VectorAssembler(inputCols=["p", "s", "m", "c_acctbal", "month"], outputCol="features"), model])
    grid = [{encoder.method: e, model.regParam: reg} for e in ("target", "m_estimate", "james_stein", "woe") for reg in (0.0, 0.1)]
    df = H.kfold(orders_frame(t), FOLDS, 3, "o_orderkey")
    return S.cv_results(t.spark, S.cross_validate_grid(df, pipe, grid, G.CurveEvaluator(metricName="ks"), "fold", FOLDS))


_SCORED = "(SELECT (o_totalprice > 250000)::INT AS y, ((o_custkey % 97) + 1) / 99.0 AS s FROM orders)"


@query("curve_evaluators", "J3", "J11", "J13", sql=f"""
    WITH d AS (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM {_SCORED} GROUP BY 1), c AS (SELECT p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS ap, sum(n) OVER () AS an FROM d WINDOW w AS (ORDER BY s DESC))
    SELECT 'auc' AS metric, round(sum(p * (an - fp + n / 2)) / (max(ap) * max(an)), 6)::DOUBLE AS value FROM c
    UNION ALL SELECT 'ks', round(max(abs(tp / ap - fp / an)), 6) FROM c UNION ALL SELECT 'log_loss', round(-avg(ln(CASE WHEN y = 1 THEN s ELSE 1 - s END)), 6) FROM {_SCORED}""")
def _(t):
    df = t.orders.select((F.col("o_totalprice") > 250000).cast("int").alias("label"), ((F.col("o_custkey") % 97 + 1) / F.lit(99.0)).alias("score"))
    path, rows = work_dir(t.spark, "evaluators"), []
    for name in ("auc", "ks", "log_loss"):
        G.CurveEvaluator(metricName=name, scoreCol="score").write().save(f"{path}/{name}")
        rows.append((name, G.CurveEvaluator.load(f"{path}/{name}").evaluate(df)))
    return t.spark.createDataFrame(rows, "metric string, value double")


def _flags(t):
    """Line items whose class is the return flag: A 0, N 1, R 2."""
    label = F.array_position(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("l_returnflag")).cast("double") - 1
    day = F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")) / 365
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", day.alias("day"), label.alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_tax", "day"], outputCol="features").transform(df)


@query("one_vs_rest", "I12", "I21")
def _(t):
    train, test = H.split(_flags(t), [0.7, 0.3], 5, ["l_orderkey", "l_linenumber"])
    return I.score(test, I.fit_one_vs_rest("svm", train, maxIter=10)).select("l_orderkey", "l_linenumber", "label", "prediction")


@query("saved_udf_stage", "B12", sql="SELECT doc_id, length(regexp_replace(text, '[^ ]', '', 'g'))::INT AS blanks FROM documents")
def _(t):
    path = work_dir(t.spark, "stage")
    B.udf_stage("text", "blanks", "length(regexp_replace(__IN__, '[^ ]', ''))").write().save(path)
    return B.ColumnStage.load(path).transform(t.documents).select("doc_id", "blanks")


@query("saved_mean_embedding", "G13", "G12")
def _(t):
    """Labelled texts as idf-weighted means of word vectors learned on the training part; the loaded model scores the rest."""
    df = X.tokenize(t.documents.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id"), "text", out="tokens")
    train, test = H.split(df.select("doc_id", "tokens", "label"), [0.7, 0.3], 3, "doc_id")
    path = work_dir(t.spark, "embedding")
    G.MeanEmbedding(inputCol="tokens", outputCol="embedding", vectorSize=8, minCount=3, weighting="idf").fit(train).write().save(path)
    loaded = G.MeanEmbeddingModel.load(path)
    vectors = lambda d: loaded.transform(d).withColumn("features", array_to_vector("embedding"))
    fitted = I.fit("logistic", vectors(train), maxIter=10)
    return J.accuracy(fitted.transform(vectors(test)))
