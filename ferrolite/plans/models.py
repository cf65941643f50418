"""Queries: training, scoring and ensembles."""

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.cols import r
from ..functions.hashing import unit_draw
from ..functions.layout import spread
from ..operators import evaluate as J, models as I, split as H
from ..operators.scale import clean_missing
from .registry import query


def orders_frame(t):
    """Order rows with customer attributes and a 0/1 label: is the order large for its year?"""
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    return spread(t.orders).join(c, "o_custkey").select("o_orderkey", (F.col("o_totalprice") > 250000).cast("double").alias("label"), "c_acctbal", "c_mktsegment",
                                                "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def lines(t, label="l_extendedprice"):
    """Line items with an assembled vector; the label is the price (regression) or a high-price flag."""
    df = spread(t.lineitem).select(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate").alias("row_id"), "l_quantity", "l_discount", "l_tax",
                           F.month("l_shipdate").alias("month"), dbl_label(label).alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax", "month"], outputCol="features").transform(df)


def dbl_label(label):
    return (F.col("l_extendedprice") > 40000).cast("double") if label == "flag" else F.col(label).cast("double")


@query("order_value_model", "I1", "I21", "I16", "J2")
def _(t):
    """Flagship: split, auto-featurize on the training part, fit, score the test part, report its statistics."""
    train, test = H.split(orders_frame(t), [0.7, 0.3], 11, "o_orderkey")
    model = I.train_any(train, "label", "logistic", exclude="o_orderkey", maxIter=10, regParam=0.01)
    scored = model.transform(test).withColumn("score", vector_to_array("probability")[1])
    return J.classification_stats(scored)


def _fit_score(kind, item, label="flag", **params):
    @query(f"fit_{kind}", item, "I21")
    def _(t):
        train, test = H.split(lines(t, label), [0.7, 0.3], 5, "row_id")
        scored = I.score(test, I.fit(kind, train, **params))
        return J.accuracy(scored) if label == "flag" else J.regression_stats(scored, digits=3)


_fit_score("logistic", "I1", maxIter=10)
_fit_score("decision_tree", "I2", maxDepth=4)
_fit_score("random_forest", "I3", numTrees=5, maxDepth=4, seed=3)
_fit_score("gbt", "I4", numTrees=4, maxDepth=3, seed=3)
_fit_score("svm", "I12", maxIter=10)
_fit_score("mlp", "I13", layers=[4, 4, 2], maxIter=15, seed=3)
_fit_score("fm", "I14", factorSize=2, maxIter=10, stepSize=0.05, seed=3)
_fit_score("naive_bayes", "I11", modelType="gaussian")
_fit_score("linear", "I5", "l_extendedprice")
_fit_score("ridge", "I15", "l_extendedprice", regParam=1.0)
_fit_score("tree_reg", "I6", "l_extendedprice", maxDepth=4)
_fit_score("forest_reg", "I6", "l_extendedprice", numTrees=4, maxDepth=4, seed=3)
_fit_score("gbt_reg", "I6", "l_extendedprice", numTrees=4, maxDepth=3, seed=3)
_fit_score("glm", "I7", "l_extendedprice", family="gamma", link="log", maxIter=10)
_fit_score("isotonic", "I8", "l_extendedprice")


@query("pick_probability", "B13")
def _(t):
    from ..operators.shape import pick_probability
    df = lines(t, "flag")
    return pick_probability(I.fit("logistic", df, maxIter=5).transform(df), 1).select("row_id", r(F.col("p")).alias("p"))


@query("fit_aft", "I8")
def _(t):
    df = lines(t).withColumn("censor", F.lit(1.0)).withColumn("label", F.col("label") + 1)
    return J.regression_stats(I.fit("aft", df, censorCol="censor", maxIter=10).transform(df), digits=3)


@query("linear_one_variable", "I5", sql="SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem")
def _(t):
    df = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(t.lineitem)
    m = I.fit("linear", df, label="l_extendedprice", solver="normal")
    rows = I.model_table(t.spark, m)
    return rows.agg(r(F.max(F.when(F.col("item") == "coefficient", F.col("value"))), 3).alias("slope"), r(F.max(F.when(F.col("item") == "intercept", F.col("value"))), 2).alias("intercept"))


@query("fit_quantile", "I9")
def _(t):
    df = lines(t)
    m = I.fit_quantile(df, 0.8, max_iter=6)
    return m.transform(df).agg(r(F.avg((F.col("label") <= F.col("prediction")).cast("double")), 2).alias("coverage"))


@query("hashed_linear", "I10")
def _(t):
    df = orders_frame(t)
    m = I.hashed_linear(["o_orderstatus", "o_orderpriority", "c_mktsegment", "c_acctbal"], "label", 256, passes=5).fit(df)
    return J.accuracy(m.transform(df))


@query("bernoulli_counts", "I11", sql=" UNION ALL ".join(
    f"SELECT l_returnflag, '{n}' AS feature, count(*) AS n, count(*) FILTER ({c}) AS ones, round(ln((count(*) FILTER ({c}) + 1) / (count(*) + 2)), 6) AS log_p FROM lineitem GROUP BY 1"
    for n, c in (("bulk", "l_quantity > 30"), ("taxed", "l_tax > 0.03"))))
def _(t):
    df = t.lineitem.select("l_returnflag", (F.col("l_quantity") > 30).cast("int").alias("bulk"), (F.col("l_tax") > 0.03).cast("int").alias("taxed"))
    return I.bernoulli_counts(df, ["bulk", "taxed"], "l_returnflag")


@query("train_any", "I16")
def _(t):
    df = t.documents.join(t.labels, "doc_id").select("doc_id", "text", "lang", "source", "n_chars", F.col("quality").cast("double").alias("label"))
    train, test = H.split(df, [0.7, 0.3], 3, "doc_id")
    m = I.train_any(train, "label", "random_forest", 256, exclude="doc_id", numTrees=5, maxDepth=4, seed=1)
    return J.accuracy(m.transform(test))


@query("with_params", "I17")
def _(t):
    df, base = lines(t, "flag"), I.estimator("logistic", maxIter=5)
    strong = I.with_params(base, {"regParam": 0.5, "elasticNetParam": None})
    a, b = base.fit(df), strong.fit(df)
    return I.model_table(t.spark, a).withColumn("model", F.lit("base")).unionByName(I.model_table(t.spark, b).withColumn("model", F.lit("strong")))


@query("model_table", "I18", "L4")
def _(t):
    m = I.fit("random_forest", lines(t, "flag"), numTrees=4, maxDepth=3, seed=2)
    return I.model_table(t.spark, m, ["l_quantity", "l_discount", "l_tax", "month"])


@query("early_stop", "I20")
def _(t):
    df = lines(t, "flag").withColumn("valid", unit_draw(9, "row_id") < 0.2)
    m = I.early_stop("gbt", df, "valid", maxIter=8, maxDepth=3, tol=0.01, seed=1)
    return df.where("valid").transform(m.transform).transform(J.accuracy)


_W1 = np.linspace(-1, 1, 64 * 8).reshape(64, 8)
_W2 = np.linspace(1, -1, 8 * 3).reshape(8, 3)


@query("batch_infer", "I22")
def _(t):
    layers = [(_W1, np.zeros(8)), (_W2, np.full(3, 0.5))]
    df = I.batch_infer(t.embeddings, layers, "embedding")
    df = I.batch_infer(df, layers, "embedding", inner=1, out="inner")
    return df.select("vec_id", F.transform("scores", lambda x: r(x)).alias("scores"), F.transform("inner", lambda x: r(x)).alias("inner"))


@query("grouped_fit", "I23", sql="""SELECT l_returnflag, 0.0::DOUBLE AS ridge, count(*) AS n, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_slope(l_extendedprice, l_quantity), 4) AS l_quantity FROM lineitem GROUP BY 1""")
def _(t):
    out = I.grouped_fit(t.lineitem, "l_returnflag", "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", "ridge", "n", r(F.col("intercept"), 3).alias("intercept"), r(F.col("l_quantity"), 4).alias("l_quantity"))


@query("weighted_ensemble", "I24", sql="""SELECT event_id, round((value * 0.5 + user_id * 0.3 + (event_id % 10) * 0.2) / 1.0, 6)::DOUBLE AS blend FROM events""")
def _(t):
    preds = t.events.select("event_id", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), c.cast("double").alias("p")) for m, c in
                                                          (("a", F.col("value")), ("b", F.col("user_id")), ("c", F.col("event_id") % 10))])))
    weights = t.spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 2.0)], "model string, weight double")
    return I.weighted_ensemble(preds, weights, "event_id")


ENS = "(SELECT l_extendedprice AS y, l_quantity * 1500 AS a, 38000 + 0 * l_tax AS b, l_quantity * 1000 + 20000 AS c FROM lineitem)"


@query("ensemble_select", "I25", sql=f"""WITH s1 AS (SELECT unnest([{{'m': 'a', 'l': avg((y-a)*(y-a))}}, {{'m': 'b', 'l': avg((y-b)*(y-b))}}, {{'m': 'c', 'l': avg((y-c)*(y-c))}}]) AS s FROM {ENS}),
   f AS (SELECT s.m AS m, s.l AS l FROM s1 ORDER BY s.l LIMIT 1),
   e AS (SELECT y, a, b, c, CASE m WHEN 'a' THEN a WHEN 'b' THEN b ELSE c END AS p FROM {ENS}, f),
   s2 AS (SELECT unnest([{{'m': 'a', 'l': avg(power(y-(p+a)/2, 2))}}, {{'m': 'b', 'l': avg(power(y-(p+b)/2, 2))}}, {{'m': 'c', 'l': avg(power(y-(p+c)/2, 2))}}]) AS s FROM e)
   SELECT 1 AS step, m AS model, round(l, 2) AS loss FROM f UNION ALL (SELECT 2, s.m, round(s.l, 2) FROM s2 ORDER BY s.l LIMIT 1)""")
def _(t):
    q = F.col("l_quantity")
    df = t.lineitem.select(F.col("l_extendedprice").alias("y"), (q * 1500).alias("a"), (F.lit(38000.0) + 0 * F.col("l_tax")).alias("b"), (q * 1000 + 20000).alias("c"))
    steps = I.ensemble_select(df, ["a", "b", "c"], "y", 2)
    return t.spark.createDataFrame([(i + 1, m, round(v, 2)) for i, (m, v) in enumerate(steps)], "step int, model string, loss double")


@query("stack_features", "I26")
def _(t):
    weak = {"tree": I.estimator("decision_tree", maxDepth=2), "nb": I.estimator("naive_bayes", modelType="gaussian")}
    return I.stack_features(lines(t, "flag"), weak, 2, "row_id", "label").select("row_id", "weak_tree", "weak_nb")


@query("cross_val_score", "J14")
def _(t):
    return I.cross_val_score(lines(t, "flag"), I.estimator("decision_tree", maxDepth=3), 3, "row_id", BinaryClassificationEvaluator(labelCol="label"), "label")


@query("cross_val_predict", "J15")
def _(t):
    return I.cross_val_predict(lines(t, "flag"), I.estimator("decision_tree", maxDepth=3), 3, "row_id", "label").select("row_id", "fold", "prediction", F.transform("probability", lambda x: r(x)).alias("probability"))
