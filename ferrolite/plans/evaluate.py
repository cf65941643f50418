"""Queries: evaluation metrics over predictions derived from orders and lineitem."""

from pyspark.sql import functions as F

from ..operators import evaluate as J
from .registry import query

BINARY = "(SELECT o_orderkey, (o_totalprice > 250000)::INT AS label, (o_custkey % 97)::DOUBLE AS score, (o_custkey % 97 > 40)::INT AS prediction FROM orders)"
MULTI = "(SELECT o_orderkey, substr(o_orderpriority, 1, 1)::INT AS label, (o_custkey % 5 + 1)::INT AS prediction FROM orders)"
REGRESSION = "(SELECT l_orderkey, l_extendedprice AS label, l_quantity * 1500 + l_discount * 100000 AS prediction FROM lineitem)"
PROBA = """(SELECT event_id, user_id % 3 AS label, [a / (a + b + c), b / (a + b + c), c / (a + b + c)] AS probability FROM
   (SELECT *, value + 1 AS a, (event_id % 17 + 1)::DOUBLE AS b, (event_id % 5 + 1)::DOUBLE AS c FROM events))"""


def binary(t):
    return t.orders.select("o_orderkey", (F.col("o_totalprice") > 250000).cast("int").alias("label"),
                           (F.col("o_custkey") % 97).cast("double").alias("score"), (F.col("o_custkey") % 97 > 40).cast("int").alias("prediction"))


def multi(t):
    return t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("label"), (F.col("o_custkey") % 5 + 1).cast("int").alias("prediction"))


def regression(t):
    return t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500 + F.col("l_discount") * 100000).alias("prediction"))


def proba(t):
    a, b, c = F.col("value") + 1, (F.col("event_id") % 17 + 1).cast("double"), (F.col("event_id") % 5 + 1).cast("double")
    return t.events.select("event_id", (F.col("user_id") % 3).alias("label"), F.array(*[x / (a + b + c) for x in (a, b, c)]).alias("probability"))


CURVE = f"""b AS {BINARY}, g AS (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM b GROUP BY 1),
  c AS (SELECT threshold, pos::DOUBLE AS pos, neg::DOUBLE AS neg, (sum(pos) OVER w)::DOUBLE AS tp, (sum(neg) OVER w)::DOUBLE AS fp,
     (sum(pos) OVER ())::DOUBLE AS p, (sum(neg) OVER ())::DOUBLE AS n FROM g WINDOW w AS (ORDER BY threshold DESC))"""
AUC = f"""(SELECT round((sum(rk) FILTER (label = 1) - n1 * (n1 + 1) / 2.0::DOUBLE) / (n1 * n0::DOUBLE), 6) AS auc FROM (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM {BINARY}),
  (SELECT sum(label) AS n1, sum(1 - label) AS n0 FROM {BINARY}) GROUP BY n1, n0)"""


@query("confusion", "J1", sql=f"SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM (SELECT label, prediction, count(*) AS n FROM {MULTI} GROUP BY 1, 2)")
def _(t):
    return J.confusion(multi(t))


@query("classification_stats", "J2", sql=f"""SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
   round(tp / (tp + fn), 6) AS recall, auc FROM (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
   count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM {BINARY}), {AUC}""")
def _(t):
    return J.classification_stats(binary(t))


@query("auc_roc", "J3", sql=AUC[1:-1])
def _(t):
    return J.auc_roc(binary(t))


@query("auc_roc_custkey", "J3", sql=AUC[1:-1].replace("(o_custkey % 97)::DOUBLE AS score", "o_custkey::DOUBLE AS score"))
def _(t):
    return J.auc_roc(t.orders.select((F.col("o_totalprice") > 250000).cast("int").alias("label"), F.col("o_custkey").cast("double").alias("score")))


@query("auc_pr", "J4", sql=f"""WITH {CURVE}, d AS (SELECT threshold, pos, p, tp / (tp + fp) AS precision FROM c)
   SELECT round(sum((precision + coalesce(before, precision)) / 2 * pos / p), 6) AS auc_pr FROM (SELECT *, lag(precision) OVER (ORDER BY threshold DESC) AS before FROM d)""")
def _(t):
    return J.auc_pr(binary(t))


@query("roc_curve", "J5", sql=f"WITH {CURVE} SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c")
def _(t):
    return J.roc_curve(binary(t))


F_SQL = f"WITH {CURVE} SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall, round(2 * tp / (p + tp + fp), 6) AS f FROM c"


@query("f_by_threshold", "J6", sql=F_SQL)
def _(t):
    return J.f_by_threshold(binary(t))


@query("set_threshold", "I19", sql=f"SELECT * FROM ({F_SQL}) ORDER BY f DESC, threshold DESC LIMIT 1")
def _(t):
    return J.best_threshold(binary(t))


PER_LABEL = f"""SELECT l.label, count(*) FILTER (m.label = l.label) AS support, tp, count(*) FILTER (prediction = l.label) AS guessed, count(*) AS n
   FROM {MULTI} m, (SELECT label, count(*) FILTER (label = prediction) AS tp FROM {MULTI} GROUP BY 1) l GROUP BY l.label, tp"""
LABEL_RATES = f"""SELECT label, support, round((guessed - tp) / (n - support), 6) AS fpr, round(tp / support, 6) AS tpr, round(tp / guessed, 6) AS precision,
   round(tp / support, 6) AS recall, round(2 * tp / (guessed + support), 6) AS f1 FROM ({PER_LABEL})"""


@query("per_label_stats", "J7", sql=LABEL_RATES)
def _(t):
    return J.per_label_stats(multi(t))


@query("weighted_label_stats", "J7", sql="SELECT " + ", ".join(
    f"round(sum({c} * support) / sum(support), 5) AS {n}" for c, n in
    (("recall", "accuracy"), ("fpr", "weighted_fpr"), ("precision", "weighted_precision"), ("recall", "weighted_recall"), ("f1", "weighted_f1"))) + f" FROM ({LABEL_RATES})")
def _(t):
    return J.weighted_label_stats(multi(t))


REG = "round(sqrt(avg(d * d)), 4) AS rmse, round(avg(abs(d)), 4) AS mae, round(1 - avg(d * d) / var_pop(label), 4) AS r2"


@query("regression_stats", "J8", sql=f"SELECT round(avg(d * d), 4) AS mse, {REG} FROM (SELECT *, prediction - label AS d FROM {REGRESSION})")
def _(t):
    return J.regression_stats(regression(t), digits=4)


@query("advanced_regression_stats", "J9", sql=f"""SELECT {REG}, round(avg(prediction), 4) AS mean_prediction, round(avg(label), 4) AS mean_actual,
   round(median(prediction), 4) AS median_prediction, round(median(label), 4) AS median_actual, round(median(abs(d)), 4) AS median_absolute_error,
   round(1 - var_pop(d) / var_pop(label), 4) AS explained_variance, count(*) FILTER (d > 0) AS n_positive, count(*) FILTER (d < 0) AS n_negative,
   round(avg(d) FILTER (d > 0), 4) AS mean_positive, round(avg(d) FILTER (d < 0), 4) AS mean_negative FROM (SELECT *, prediction - label AS d FROM {REGRESSION})""")
def _(t):
    return J.advanced_regression_stats(regression(t), digits=4)


@query("per_row_stats", "J10", sql=f"SELECT *, round(abs(label - prediction), 6) AS l1_loss, round((label - prediction) * (label - prediction), 6) AS l2_loss FROM (SELECT l_orderkey, round(l_extendedprice) AS label, l_quantity * 1500 AS prediction FROM lineitem)")
def _(t):
    return J.per_row_stats(t.lineitem.select("l_orderkey", F.round("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")))


@query("per_row_log_loss", "J10", sql=f"SELECT event_id, round(-ln(greatest(probability[label + 1], 1e-15)), 6) + 0.0 AS log_loss FROM {PROBA}")
def _(t):
    return J.per_row_log_loss(proba(t)).select("event_id", "log_loss")


@query("log_loss", "J11", sql=f"SELECT round(-avg(ln(least(greatest(probability[label + 1], 1e-15), 1 - 1e-15))), 6) AS log_loss FROM {PROBA}")
def _(t):
    return J.log_loss(proba(t))


@query("mean_per_class_error", "J12", sql=f"SELECT round(avg(e), 6) AS mean_per_class_error FROM (SELECT avg((label <> prediction)::INT) AS e FROM {MULTI} GROUP BY label)")
def _(t):
    return J.mean_per_class_error(multi(t))


@query("ks_statistic", "J13", sql=f"WITH {CURVE} SELECT round(max(abs(tp / p - fp / n)), 6) AS ks FROM c")
def _(t):
    return J.ks_statistic(binary(t))


@query("compare_models", "J16", sql=" UNION ALL ".join(
    f"""SELECT '{m}' AS model, round(avg(power(y - h, 2)), 4) AS mse, round(sqrt(avg(power(y - h, 2))), 4) AS rmse, round(avg(abs(y - h)), 4) AS mae,
    round(1 - avg(power(y - h, 2)) / var_pop(y), 6) AS r2 FROM (SELECT l_extendedprice AS y, {h} AS h FROM lineitem)"""
    for m, h in (("per_unit", "l_quantity * 1500"), ("constant", "38000.0::DOUBLE"))))
def _(t):
    df = t.lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("a"), F.lit(38000.0).alias("b"))
    return J.compare_models(df, {"per_unit": "a", "constant": "b"})


@query("accuracy", "J17", sql=f"SELECT round(avg((label = prediction)::INT), 6) AS accuracy FROM {MULTI}")
def _(t):
    return J.accuracy(multi(t))
