"""Pipeline stages that Spark ML lacks: encoders with learned tables, and evaluators on exact metrics. All can be saved and loaded.

An encoder's model holds a table in Parquet, written once to the run's shared folder when it is fitted and copied when the model is saved, so
a fitted stage survives lost executors and costs no second pass over the training rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol, HasOutputCols, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cols import NUMERIC, dbl, div, same_keys
from ..functions.ordered import number_rows
from ..functions.store import cut, work_dir
from . import evaluate

LOOKUP_BYTES = 64 << 20
TARGETS, CODES = ("target", "m_estimate", "james_stein", "woe"), ("index", "label")


# ---------------------------------------------------------------- models with a table

class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls()
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        out.table = self.sparkSession.read.parquet(f"{path}/table")
        return out


class TableModel(Model, MLWritable, MLReadable):
    """A model whose learned part is the DataFrame `table`."""

    table: DataFrame

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.table = self.table
        return out


def _kept(table: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read back."""
    path = work_dir(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- category encoders

class _EncoderParams(HasInputCols, HasOutputCols, HasLabelCol):
    method = Param(Params._dummy(), "method", f"one of {TARGETS + CODES}", typeConverter=TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "target: rows over which a level's mean takes over from the prior", typeConverter=TypeConverters.toFloat)
    minLeaf = Param(Params._dummy(), "minLeaf", "target: rows at which mean and prior weigh the same", typeConverter=TypeConverters.toInt)
    m = Param(Params._dummy(), "m", "m_estimate: rows of prior", typeConverter=TypeConverters.toFloat)
    reg = Param(Params._dummy(), "reg", "woe: rows added to each cell", typeConverter=TypeConverters.toFloat)
    unknown = Param(Params._dummy(), "unknown", "index, label: code of values that were not seen", typeConverter=TypeConverters.toFloat)


class CategoryEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a code for each value of some columns, all of them in one pass over the training rows.

    target, m_estimate, james_stein, woe: shrunk means (or weight of evidence) of a numeric label; null is a value of its own, unseen values get the
    prior. index: rank by falling frequency; label: rank in the sorted values; both from 0, null and unseen values get `unknown`.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, labelCol="label", method="target", smoothing=1.0, minLeaf=1, m=1.0, reg=1.0, unknown=-1.0):
        super().__init__()
        self._setDefault(method="target", smoothing=1.0, minLeaf=1, m=1.0, reg=1.0, unknown=-1.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _long(self, df: DataFrame, y: Column | None) -> DataFrame:
        """(name, level, number) of each row and column: the value as text, and as a number where it is one."""
        cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level"),
                          (F.col(c).cast("double") if isinstance(df.schema[c].dataType, NUMERIC) else F.lit(None).cast("double")).alias("number")) for c in self.getInputCols()]
        return df.select(*([y.alias("y")] if y is not None else []), F.inline(F.array(*cells)))

    def _fit(self, df: DataFrame) -> "CategoryEncoderModel":
        method = self.getOrDefault("method")
        if method not in TARGETS + CODES or len(self.getInputCols()) != len(self.getOutputCols()):
            raise ValueError(f"method is one of {TARGETS + CODES}, with an output for each input")
        if method in CODES:
            counts = self._long(df, None).where("level IS NOT NULL").groupBy("name", "level", "number").agg(F.count(F.lit(1)).alias("n"))
            order = ["-n", "number", "level"] if method == "index" else ["number", "level"]
            table = number_rows(_kept(counts, "levels"), order, "name", out="code").select("name", "level", F.col("code").cast("double").alias("code"), F.lit(self.getOrDefault("unknown")).alias("prior"))
        else:
            y = dbl(self.getLabelCol())
            sums = self._long(df, y).groupBy("name", "level").agg(
                F.count("y").alias("n"), F.sum("y").alias("s"), F.avg("y").alias("m"), F.var_samp("y").alias("v"))
            table = self._codes(sums, method, df.agg(F.avg(y).alias("prior"), F.var_samp(y).alias("var"), F.sum(y).alias("p"), F.count(y).alias("n")).first())
        out = CategoryEncoderModel()
        out._resetUid(self.uid)
        self._copyValues(out)
        out.table = _kept(table, "encoder")
        return out

    def _codes(self, sums: DataFrame, method: str, whole) -> DataFrame:
        n, s, mean = F.col("n"), F.col("s"), F.col("m")
        prior = F.lit(whole["prior"]).cast("double")
        if method == "target":
            weight = 1 / (1 + F.exp(-(n - self.getOrDefault("minLeaf")) / F.lit(self.getOrDefault("smoothing"))))
            code = prior * (1 - weight) + mean * weight
        elif method == "m_estimate":
            code = (s + prior * self.getOrDefault("m")) / (n + self.getOrDefault("m"))
        elif method == "james_stein":
            noise = F.coalesce("v", F.lit(whole["var"])) / n
            b = F.coalesce(div(noise, noise + F.lit(whole["var"])), F.lit(0.0))
            code = (1 - b) * mean + b * prior
        else:
            reg, p, q = self.getOrDefault("reg"), whole["p"], (whole["n"] or 0) - (whole["p"] or 0)
            code, prior = F.ln(((s + reg) / F.lit(float(p or 0) + 2 * reg)) / ((n - s + reg) / F.lit(float(q) + 2 * reg))), F.lit(0.0)
        return sums.select("name", "level", F.when(n > 0, code).otherwise(prior).alias("code"), prior.alias("prior"))


class CategoryEncoderModel(TableModel, _EncoderParams):
    """`table`: (name, level, code, prior)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        default = {r["name"]: r["prior"] for r in self.table.groupBy("name").agg(F.first("prior").alias("prior")).collect()}  # one row per column
        missing = self.getOrDefault("unknown") if self.getOrDefault("method") in CODES else None
        for c, out in zip(self.getInputCols(), self.getOutputCols()):
            codes = self.table.where(F.col("name") == c).select(F.col("level").alias("__level"), F.col("code").alias("__code"))
            df = df.join(codes, F.col(c).cast("string").eqNullSafe(F.col("__level")), "left")
            df = df.withColumn(out, F.coalesce("__code", F.lit(default.get(c, missing)).cast("double"))).drop("__level", "__code")
        return df


# ---------------------------------------------------------------- mean embeddings

class _EmbeddingParams(HasInputCol, HasOutputCol, HasSeed):
    vectorSize = Param(Params._dummy(), "vectorSize", "dimensions", typeConverter=TypeConverters.toInt)
    minCount = Param(Params._dummy(), "minCount", "least number of occurrences of a word", typeConverter=TypeConverters.toInt)
    weighting = Param(Params._dummy(), "weighting", "mean, or idf: vectors times ln((1 + texts) / (1 + texts with the word)) + 1", typeConverter=TypeConverters.toString)


class MeanEmbedding(Estimator, _EmbeddingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Word vectors learned on the training texts (an array of words each); a text becomes the mean of its known words' vectors, zeros without any."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, vectorSize=16, minCount=5, weighting="mean", seed=7):
        super().__init__()
        self._setDefault(vectorSize=16, minCount=5, weighting="mean", seed=7)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "MeanEmbeddingModel":
        words, weighting = self.getInputCol(), self.getOrDefault("weighting")
        if weighting not in ("mean", "idf"):
            raise ValueError("weighting is mean or idf")
        texts = df.select(F.coalesce(words, F.array().cast("array<string>")).alias("words"))
        fitted = Word2Vec(vectorSize=self.getOrDefault("vectorSize"), minCount=self.getOrDefault("minCount"), seed=self.getOrDefault("seed"), inputCol="words", outputCol="__v").fit(texts)
        table = fitted.getVectors().select(F.col("word").alias("term"), vector_to_array("vector").alias("vector"))
        if weighting == "idf":
            held = texts.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            total = F.lit(float(texts.count()))
            table = table.join(held, "term").select("term", F.transform("vector", lambda x: x * (F.ln((total + 1) / (F.col("n") + 1)) + 1)).alias("vector"))
        out = MeanEmbeddingModel()
        out._resetUid(self.uid)
        self._copyValues(out)
        out.table = _kept(table, "vectors")
        return out


class MeanEmbeddingModel(TableModel, _EmbeddingParams):
    """`table`: (term, vector)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return mean_of_vectors(df, self.table, self.getInputCol(), self.getOutputCol(), self.getOrDefault("vectorSize"))


def mean_of_vectors(df: DataFrame, vectors: DataFrame, words: str, out: str, dims: int, most_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Mean vector of the known words of each row.

    A dictionary of checked size is sent to the executors and applied to the array in the row; a larger one is joined to the exploded words of a
    checkpointed table of numbered rows.
    """
    if vectors.count() * (8 * dims + 100) <= most_bytes:
        rows = vectors.select("term", "vector").toPandas()
        place = dict(zip(rows["term"], range(len(rows))))
        table = np.array(rows["vector"].tolist(), float).reshape(len(rows), dims)
        sent = df.sparkSession.sparkContext.broadcast((place, table))

        @F.pandas_udf("array<double>")
        def mean(texts: pd.Series) -> pd.Series:
            place, table = sent.value
            found = ([place[w] for w in (t if t is not None else ()) if w in place] for t in texts)
            return pd.Series([table[i].mean(axis=0).tolist() if i else [0.0] * dims for i in found])

        return df.withColumn(out, mean(F.col(words)))
    numbered = cut(df.withColumn("__row", F.monotonically_increasing_id()))
    counts = numbered.select("__row", F.explode(words).alias("term")).groupBy("__row", "term").agg(F.count(F.lit(1)).alias("__tf"))
    sums = counts.join(vectors, "term").groupBy("__row").agg(F.sum("__tf").alias("__n"), *[F.sum(F.col("vector")[i] * F.col("__tf")).alias(f"__{i}") for i in range(dims)])
    mean = F.when(F.col("__n").isNull(), F.array_repeat(F.lit(0.0), dims)).otherwise(F.array(*[F.col(f"__{i}") / F.col("__n") for i in range(dims)]))
    return numbered.join(sums, "__row", "left").withColumn(out, mean).drop("__row", "__n", *[f"__{i}" for i in range(dims)])


# ---------------------------------------------------------------- evaluators

CURVES = {"auc": evaluate.auc_roc, "auc_pr": evaluate.auc_pr, "ks": evaluate.ks_statistic}


class CurveEvaluator(Evaluator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """auc, auc_pr, ks and log_loss of a scored table, exact with ties and without bins.

    `scoreCol` is a number or a vector or array of class probabilities, of which curves take that of class 1 and log_loss that of the label.
    A table without both classes has no curve: the value is NaN, which no search prefers.
    """

    metricName = Param(Params._dummy(), "metricName", "auc, auc_pr, ks or log_loss", typeConverter=TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "score, or class probabilities", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, metricName="auc", labelCol="label", scoreCol="probability"):
        super().__init__()
        self._setDefault(metricName="auc", scoreCol="probability")
        self._set(**self._input_kwargs)

    def isLargerBetter(self) -> bool:
        return self.getOrDefault("metricName") != "log_loss"

    def _evaluate(self, df: DataFrame) -> float:
        name, label, score = self.getOrDefault("metricName"), self.getLabelCol(), self.getOrDefault("scoreCol")
        kind = df.schema[score].dataType.typeName()
        value = vector_to_array(score) if kind == "vectorudt" else F.col(score)
        rows = df.select(dbl(label).alias("label"), value.alias("score")).where("label IS NOT NULL AND score IS NOT NULL")
        if name == "log_loss":
            if kind not in ("vectorudt", "array"):
                rows = rows.withColumn("score", F.array(1 - F.col("score"), F.col("score")))
            found = evaluate.log_loss(rows, "label", "score")
        elif name in CURVES:
            found = CURVES[name](rows.withColumn("score", F.col("score")[1]) if kind in ("vectorudt", "array") else rows)
        else:
            raise ValueError(f"unknown metric {name!r}")
        value = found.first()[0]
        return math.nan if value is None else float(value)
