"""Exact evaluation metrics as aggregations.

Curve metrics first count equal scores, then run along the distinct scores
with carried totals, so a tie or a hot score costs one row and no task sorts
the whole table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.cols import as_list, dbl, div, r, same_keys, union_all, with_row
from ..functions.ordered import running
from ..functions.quantiles import quantiles
from ..functions.store import saved

CLIP = 1e-15


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Counts per (label, prediction) and the share within the label."""
    cells = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(label).agg(F.sum("n").alias("__n"))
    return same_keys(cells, rows, label).select(label, pred, "n", r(F.col("n") / F.col("__n")).alias("share"))


def score_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score: positives, negatives, and their totals at or above it. The scores are worked out once, the counts are saved."""
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    rows = df.select(F.col(score).alias("threshold"), label)
    counts = saved(rows.groupBy("threshold").agg(pos.alias("pos"), (F.count(F.lit(1)) - pos).alias("neg")), "scores")
    curve = running(counts, "-threshold", sums={"tp": F.col("pos"), "fp": F.col("neg")})
    return with_row(curve, counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label", digits: int = 6) -> DataFrame:
    """Area under ROC, exact with ties."""
    c = score_curve(df, score, label)
    below = F.col("n") - F.col("fp")
    area = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0))) / (F.max("p").cast("double") * F.max("n"))
    return c.agg(r(area, digits).alias("auc"))


def auc_pr(df: DataFrame, score: str = "score", label: str = "label", digits: int = 6) -> DataFrame:
    """Area under precision-recall by trapezoids; the curve starts at recall 0 with the first precision."""
    c = score_curve(df, score, label)
    tp, fp = dbl("tp"), dbl("fp")
    before_tp, before_fp = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    before = F.coalesce(div(before_tp, before_tp + before_fp), precision)
    return c.agg(r(F.sum((precision + before) / 2 * F.col("pos")) / F.max("p"), digits).alias("auc_pr"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    c = score_curve(df, score, label)
    return c.select("threshold", r(div(F.col("fp"), F.col("n"))).alias("fpr"), r(div(F.col("tp"), F.col("p"))).alias("tpr"))


def f_by_threshold(df: DataFrame, score: str = "score", label: str = "label", beta: float = 1.0) -> DataFrame:
    c = score_curve(df, score, label)
    b = beta * beta
    tp, fp, p = dbl("tp"), dbl("fp"), dbl("p")
    return c.select("threshold", r(tp / (tp + fp)).alias("precision"), r(div(tp, p)).alias("recall"),
                    r((1 + b) * tp / (b * p + tp + fp)).alias("f"))


def best_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Threshold with the largest F (ties: highest threshold)."""
    f = f_by_threshold(df, score, label)
    return f.agg(F.max_by(F.struct(*f.columns), F.struct("f", "threshold")).alias("b")).select("b.*")


def ks_statistic(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    c = score_curve(df, score, label)
    return c.agg(r(F.max(F.abs(F.col("tp") / F.col("p") - F.col("fp") / F.col("n")))).alias("ks"))


def classification_stats(df: DataFrame, label: str = "label", pred: str = "prediction", score: str = "score") -> DataFrame:
    """Confusion counts, accuracy, precision, recall and AUC in one row."""
    y, h = F.col(label) == 1, F.col(pred) == 1
    n = lambda c: F.count(F.when(c, 1))
    counts = df.agg(n(y & h).alias("tp"), n(~y & h).alias("fp"), n(y & ~h).alias("fn"), n(~y & ~h).alias("tn"))
    stats = counts.select("tp", "fp", "fn", "tn",
                          r(div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).alias("accuracy"),
                          r(div(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
                          r(div(F.col("tp"), F.col("tp") + F.col("fn"))).alias("recall"))
    return with_row(stats, auc_roc(df, score, label))


def per_label_stats(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One-vs-rest rates per label, from the confusion counts alone."""
    cells = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    actual = cells.select(F.col("y").alias("label"), "n", F.lit(0).alias("h"), F.when(F.col("y") == F.col("h"), F.col("n")).otherwise(0).alias("tp"))
    guessed = cells.select(F.col("h").alias("label"), F.lit(0).alias("n"), F.col("n").alias("h"), F.lit(0).alias("tp"))
    sums = actual.unionByName(guessed).groupBy("label").agg(F.sum("n").alias("support"), F.sum("h").alias("guessed"), F.sum("tp").alias("tp"))
    sums = with_row(sums, df.agg(F.count(F.lit(1)).alias("__all")))
    fp, fn = F.col("guessed") - F.col("tp"), F.col("support") - F.col("tp")
    precision, recall = div(F.col("tp"), F.col("guessed")), div(F.col("tp"), F.col("support"))
    return sums.select("label", "support", r(div(fp, F.col("__all") - F.col("support"))).alias("fpr"), r(recall).alias("tpr"),
                       r(precision).alias("precision"), r(recall).alias("recall"),
                       r(div(F.col("tp") * 2, F.col("guessed") + F.col("support"))).alias("f1"))


def weighted_label_stats(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Support-weighted averages of the per-label rates, and accuracy."""
    s = per_label_stats(df, label, pred)
    avg = lambda c: r(F.sum(F.coalesce(F.col(c), F.lit(0.0)) * F.col("support")) / F.sum("support"), 5)
    return s.agg(avg("recall").alias("accuracy"), avg("fpr").alias("weighted_fpr"), avg("precision").alias("weighted_precision"),
                 avg("recall").alias("weighted_recall"), avg("f1").alias("weighted_f1"))


def regression_stats(df: DataFrame, label: str = "label", pred: str = "prediction", digits: int = 6) -> DataFrame:
    e, y = dbl(label) - dbl(pred), dbl(label)
    mse = F.avg(e * e)
    return df.agg(r(mse, digits).alias("mse"), r(F.sqrt(mse), digits).alias("rmse"), r(F.avg(F.abs(e)), digits).alias("mae"),
                  r(1 - mse / F.var_pop(y), digits).alias("r2"))


def advanced_regression_stats(df: DataFrame, label: str = "label", pred: str = "prediction", digits: int = 6) -> DataFrame:
    y, h = dbl(label), dbl(pred)
    d = h - y
    base = df.agg(r(F.sqrt(F.avg(d * d)), digits).alias("rmse"), r(F.avg(h), digits).alias("mean_prediction"), r(F.avg(y), digits).alias("mean_actual"),
                  r(F.avg(F.abs(d)), digits).alias("mae"), r(1 - F.var_pop(d) / F.var_pop(y), digits).alias("explained_variance"),
                  r(1 - F.avg(d * d) / F.var_pop(y), digits).alias("r2"),
                  F.count(F.when(d > 0, 1)).alias("n_positive"), F.count(F.when(d < 0, 1)).alias("n_negative"),
                  r(F.avg(F.when(d > 0, d)), digits).alias("mean_positive"), r(F.avg(F.when(d < 0, d)), digits).alias("mean_negative"))
    middles = df.select(h.alias("median_prediction"), y.alias("median_actual"), F.abs(d).alias("median_absolute_error"))
    q = quantiles(middles, middles.columns, {"m": 0.5})
    return with_row(base, q.agg(*[r(F.max(F.when(F.col("column") == c, F.col("m"))), digits).alias(c) for c in middles.columns]))


def per_row_stats(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    e = dbl(label) - dbl(pred)
    return df.withColumns({"l1_loss": r(F.abs(e)), "l2_loss": r(e * e)})


def per_row_log_loss(df: DataFrame, label: str = "label", proba: str = "probability") -> DataFrame:
    p = F.try_element_at(F.col(proba), F.col(label).cast("int") + 1)
    return df.withColumn("log_loss", r(-F.ln(F.greatest(p, F.lit(CLIP)))))


def log_loss(df: DataFrame, label: str = "label", proba: str = "probability") -> DataFrame:
    """Multi-class log loss; `proba` is an array of class probabilities, label its 0-based index."""
    if df.schema[proba].dataType.typeName() == "vectorudt":
        df = df.withColumn(proba, vector_to_array(proba))
    p = F.try_element_at(F.col(proba), F.col(label).cast("int") + 1)
    return df.agg(r(-F.avg(F.ln(F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))))).alias("log_loss"))


def mean_per_class_error(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    per = df.groupBy(label).agg(F.avg((F.col(label) != F.col(pred)).cast("double")).alias("e"))
    return per.agg(r(F.avg("e")).alias("mean_per_class_error"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(r(F.avg((F.col(label) == F.col(pred)).cast("double"))).alias("accuracy"))


def compare_models(scored: DataFrame, models: dict[str, str], label: str = "label") -> DataFrame:
    """One metric row per model; the predictions are columns of one table, so it is scanned once."""
    y = dbl(label)
    aggs = []
    for m, c in models.items():
        e = y - dbl(c)
        aggs += [F.avg(e * e).alias(f"{m}_mse"), F.avg(F.abs(e)).alias(f"{m}_mae")]
    row = scored.agg(F.var_pop(y).alias("__v"), *aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), r(F.col(f"{m}_mse"), 4).alias("mse"), r(F.sqrt(f"{m}_mse"), 4).alias("rmse"),
                 r(F.col(f"{m}_mae"), 4).alias("mae"), r(1 - F.col(f"{m}_mse") / F.col("__v")).alias("r2")) for m in models])))
