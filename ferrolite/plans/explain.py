"""Queries: feature selection and explanation."""

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Tokenizer, VectorAssembler
from pyspark.sql import functions as F

from ..functions.cols import r, vec_to_array
from ..functions.layout import spread
from ..operators import explain as L, models as I
from .models import lines
from .registry import query

NUMS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@query("variances", "L1", sql=" UNION ALL ".join(f"""SELECT '{c}' AS "column", round(var_pop({c}), 4) AS variance FROM lineitem""" for c in NUMS))
def _(t):
    return L.variances(t.lineitem, NUMS).withColumn("variance", r(F.col("variance"), 4))


@query("variance_filter", "L1", sql="SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def _(t):
    return L.variance_filter(t.lineitem.select("l_orderkey", *NUMS), NUMS, 0.01)


@query("anova_f", "L2", sql=" UNION ALL ".join(f"""SELECT '{c}' AS feature, round((sum(n * power(m - mu, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 5) AS score FROM
   (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM lineitem GROUP BY l_returnflag), (SELECT avg({c}) AS mu FROM lineitem)""" for c in ("l_quantity", "l_tax")))
def _(t):
    return L.univariate_scores(t.lineitem, ["l_quantity", "l_tax"], "l_returnflag", "f")


@query("mutual_information", "L2", sql="""SELECT 'l_linestatus' AS feature, round(sum(n / a * ln(n * a / (x * y))), 6) AS score FROM (SELECT n::DOUBLE AS n, sum(n) OVER () AS a, sum(n) OVER (PARTITION BY l_linestatus) AS x, sum(n) OVER (PARTITION BY l_returnflag) AS y
   FROM (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2))""")
def _(t):
    return L.univariate_scores(t.lineitem, ["l_linestatus"], "l_returnflag", "mutual_information")


@query("select_univariate", "L2")
def _(t):
    df = t.lineitem.withColumn("y", (F.col("l_extendedprice") > 40000).cast("int"))
    kept = [("k_best", L.select_univariate(df, NUMS[:3], "y", param=1)), ("percentile", L.select_univariate(df, NUMS[:3], "y", mode="percentile", param=67)), ("fpr", L.select_univariate(df, NUMS[:3], "y", mode="fpr", param=0.05))]
    return t.spark.createDataFrame(kept, "mode string, kept array<string>")


@query("boruta", "L3")
def _(t):
    """At most 100 rounds, as in the reference; four features need seven for the first decision, and the last decision ends it."""
    df = t.lineitem.select(F.xxhash64(*t.lineitem.columns).alias("row_id"), (F.col("l_extendedprice") > 40000).cast("double").alias("y"), *NUMS[:3], F.col("l_linenumber").cast("double").alias("l_linenumber"))
    return L.boruta(df, [*NUMS[:3], "l_linenumber"], "y", "row_id", max_iter=100, trees=5, depth=3)


@query("importances", "L4")
def _(t):
    df = lines(t, "flag")
    return L.importances(df, I.fit("random_forest", df, numTrees=5, maxDepth=3, seed=2), ["l_quantity", "l_discount", "l_tax", "month"])


@query("select_by_model", "L12")
def _(t):
    df = lines(t, "flag")
    return L.select_by_model(df, I.fit("random_forest", df, numTrees=5, maxDepth=3, seed=2), ["l_quantity", "l_discount", "l_tax", "month"], keep="row_id")


@query("feature_response", "L5", sql=" UNION ALL ".join(f"""SELECT 'l_quantity' AS feature, {s} AS direction, round(d, 3) AS delta, round({s} * b * d, 3) AS mean, round(abs(b * d), 3) AS mean_abs, round(abs(b * d), 3) AS median_abs FROM
   (SELECT stddev_samp(l_quantity) * 0.5 AS d, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)""" for s in (-1, 1)))
def _(t):
    df = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(t.lineitem)
    return L.feature_response(df, I.fit("linear", df, label="l_extendedprice", solver="normal"), ["l_quantity"], digits=3)


@query("pca", "L6")
def _(t):
    df = VectorAssembler(inputCols=NUMS, outputCol="features").transform(t.lineitem)
    return vec_to_array(L.pca(df, "features", 2, whiten=True).select("l_orderkey", "components"), "components", digits=6)


def _weight(j, c):
    return L._hashed_normal(1, j, c) * math.sqrt(2 * 0.5)


@query("random_fourier", "L7", sql="SELECT l_orderkey, l_tax, [" + ", ".join(
    f"round(sqrt(2 / 4.0::DOUBLE) * cos({2 * math.pi * L._driver_unit(1, 'b', j)!r}::DOUBLE + l_tax * ({_weight(j, 'l_tax')!r}::DOUBLE) + l_discount * ({_weight(j, 'l_discount')!r}::DOUBLE)), 6)" for j in range(4)) + "] AS rbf FROM lineitem")
def _(t):
    df = L.random_fourier(t.lineitem, ["l_tax", "l_discount"], 0.5, 4)
    return df.select("l_orderkey", "l_tax", F.transform("rbf", lambda x: r(x)).alias("rbf"))


@query("nystroem", "L7")
def _(t):
    df = L.nystroem(t.events, ["value"], 0.01, 8, "event_id")
    return df.select("event_id", F.transform("rbf", lambda x: r(x)).alias("rbf"))


@query("agglomerate", "L8", sql="""SELECT l_orderkey, round((l_quantity + l_quantity * 2 + 1) / 2, 6) AS "l_quantity+twice", l_tax FROM lineitem""")
def _(t):
    df = t.lineitem.select("l_orderkey", "l_quantity", (F.col("l_quantity") * 2 + 1).alias("twice"), "l_tax")
    return L.agglomerate(df, ["l_quantity", "twice", "l_tax"], 0.95, "l_orderkey")[0]


@query("lime_text", "L9")
def _(t):
    df = spread(t.documents).select("doc_id", "text", F.col("lang").eqNullSafe("en").cast("double").alias("label"))
    model = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="tok"), HashingTF(inputCol="tok", outputCol="features", numFeatures=256), I.estimator("logistic", maxIter=5, regParam=0.1)]).fit(df)
    return L.lime_text(df, model, "doc_id", n=6).withColumn("weight", r(F.col("weight")))


@query("top_weight_parts", "L10", sql="SELECT user_id, event_id, value FROM events QUALIFY value > quantile_cont(value, 0.9) OVER (PARTITION BY user_id)")
def _(t):
    return L.top_weight_parts(t.events.select("user_id", "event_id", "value"), "user_id", "value", 90)


P_SQL = "SELECT user_id AS feature, round(min(value) / (5.0::DOUBLE * max(value)), 9) AS p_value FROM events GROUP BY 1"


@query("relevance_filter", "L11", sql=f"""WITH p AS ({P_SQL}), k AS (SELECT max(p_value) AS cut FROM (SELECT p_value, row_number() OVER (ORDER BY p_value, feature) AS i, count(*) OVER () AS m FROM p) WHERE p_value <= i / m * 0.01::DOUBLE)
   SELECT feature, p_value, coalesce(p_value <= cut, false) AS relevant FROM p, k""")
def _(t):
    tests = t.events.groupBy(F.col("user_id").alias("feature")).agg(r(F.min("value") / (5.0 * F.max("value")), 9).alias("p_value"))
    return L.relevance_filter(tests, 0.01)
