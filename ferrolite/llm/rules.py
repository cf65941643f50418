"""Quality classifier: a sparse ensemble of rules over text statistics.

A few shallow random trees are grown on the statistics of labelled texts. Each path from a root is a rule, the
conjunction of its tests. A logistic model with a lasso penalty picks a few of the rules and weighs them; what is
left is compiled into one Spark column expression over the statistics.

The statistics come from whole texts, by one pass over the words in a task. The fit uses at most `per_class` labelled
rows of each class, those with the smallest hash of the id, a documented bound; scoring is a map over all rows.

Null texts count as empty and have statistics of zero. Null labels are left out; a document with several labels takes
the largest. Without labels of both classes every score is the share of the class that is there, or 0.5 without labels. Extra columns are carried.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, whole_row
from .toxicity import labelled_sample
from .trees import Test, holds, paths

PER_CLASS = 2000
TREES, DEPTH = 24, 3
LASSO = 0.002
STATS = ["log_words", "word_len", "distinct", "top_word", "repeat_run", "distinct_pairs", "upper", "digits", "symbols",
         "symbol_words", "long_words", "lines", "same_lines", "end_marks", "bars", "letters", "spaces", "caps_words"]


def statistics(text: str | None) -> tuple[float, ...]:
    """Numbers on a whole text, each independent of its language; shares lie in [0, 1]."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(STATS)
    n = len(words)
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    letters = int(b[65:91].sum() + b[97:123].sum() + b[128:].sum())
    digits, upper = int(b[48:58].sum()), int(b[65:91].sum())
    plain = {9, 10, 11, 12, 13, 32, 33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63}
    symbols = int(sum(b[c] for c in range(33, 127) if not chr(c).isalnum() and c not in plain))
    count = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    run = sum(a == c for a, c in zip(words, words[1:]))
    odd = sum(k for w, k in count.items() if w[-1:] in b"#%&*$!|=~^<>@_+\\" or w[:1] in b"#%&*$|=~^<>@_+\\")
    caps = sum(k for w, k in count.items() if len(w) > 1 and w.isupper())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (float(np.log1p(n)), sum(len(w) * k for w, k in count.items()) / n, len(count) / n, max(count.values()) / n, run / n,
            pairs / max(1, n - 1), upper / max(1, letters), digits / size, symbols / size, odd / n,
            sum(k for w, k in count.items() if len(w) > 30) / n, len(lines) / n, 1 - len(set(lines)) / len(lines),
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), int(b[124]) / n, letters / size, int(b[32]) / size, caps / n)


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add one column for each statistic, under the prefix `stat_`."""
    small_batches(df.sparkSession)
    kind = ", ".join(f"{s} double" for s in STATS)

    @F.pandas_udf(kind)
    def made(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=STATS, dtype="float64")

    out = df.withColumn("stat_all", made(F.col(text_col).cast("string")))
    return out.select(*df.columns, *[F.col(f"stat_all.{s}").alias(f"stat_{s}") for s in STATS])


@dataclass(frozen=True)
class RuleModel:
    rules: list[tuple[list[Test], float]]
    intercept: float

    def expression(self) -> Column:
        """The score, 0 to 1, over the statistics' columns."""
        columns = [F.col(f"stat_{s}") for s in STATS]
        z = F.lit(self.intercept)
        for tests, weight in self.rules:
            z = z + F.when(holds(tests, columns), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))

    def describe(self) -> list[str]:
        say = lambda t: f"{STATS[t[0]]} {'<=' if t[1] else '>'} {t[2]:.4g}"
        return [f"{w:+.3f} if " + " and ".join(map(say, tests)) for tests, w in sorted(self.rules, key=lambda r: -abs(r[1]))]


def fit(df: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        allowed: Column | None = None, per_class: int = PER_CLASS) -> RuleModel:
    sample = with_statistics(labelled_sample(df, labels, label, id_col, text_col, allowed, per_class), "text").drop("text")
    rows = sorted(tuple(r) for r in sample.collect())  # at most per_class numbers of each class
    good = sum(r[1] for r in rows)
    if not rows or good in (0, len(rows)):
        p = 0.5 if not rows else float(bool(good))
        return RuleModel([], {0.5: 0.0, 1.0: 35.0, 0.0: -35.0}[p])
    spark = df.sparkSession
    even = [len(rows) / 2 / (len(rows) - good), len(rows) / 2 / good]
    kind = "id long, y double, w double, " + ", ".join(f"stat_{s} double" for s in STATS)
    data = spark.createDataFrame([(r[0], float(r[1]), even[r[1]], *r[2:]) for r in rows], kind).coalesce(1)
    data = VectorAssembler(inputCols=[f"stat_{s}" for s in STATS], outputCol="x").transform(data).cache()
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="w", numTrees=TREES, maxDepth=DEPTH, seed=7, minInstancesPerNode=3, subsamplingRate=0.7).fit(data)
    seen, rules = set(), []
    for tree in forest.trees:
        for tests, _ in paths(tree):
            key = tuple(sorted(set(tests)))
            if tests and key not in seen:
                seen.add(key)
                rules.append(tests)
    columns = [F.col(f"stat_{s}") for s in STATS]
    marked = data.select("y", "w", *[holds(r, columns).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(marked).select("y", "w", "x").cache()
    lasso = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(marked)
    weights = lasso.coefficients.toArray()
    data.unpersist()
    marked.unpersist()
    return RuleModel([(r, float(w)) for r, w in zip(rules, weights) if w], float(lasso.intercept))


def score(df: DataFrame, model: RuleModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """The input rows with their score; a column of that name is replaced."""
    packed = df.drop(out).select(F.col(text_col).alias("text"), whole_row().alias("row"))
    return with_statistics(packed).select("row.*", model.expression().alias(out))
