"""Cases of the fourth findings file, on rows of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.operators import neighbors as K
from ferrolite.plans import load_all, search
from ferrolite.plans.registry import ENTRIES

load_all()


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    """A table with the columns of the embeddings; every fourth vector comes twice."""
    d = str(tmp_path_factory.mktemp("vectors"))
    df = spark.range(1, 260).withColumnRenamed("id", "vec_id").withColumn("embedding", F.array(
        *[(F.pmod(F.xxhash64(F.when(F.col("vec_id") % 4 == 0, F.floor(F.col("vec_id") / 8)).otherwise(-F.col("vec_id")), F.lit(i)), F.lit(97)) / 97.0).cast("float") for i in range(3)]))
    df.withColumn("label", F.pmod(F.xxhash64("vec_id"), F.lit(10)).cast("int")).write.parquet(f"{d}/embeddings.parquet")
    return d


def brute(spark, d, k, allowed):
    """{query: [(base, label)]}: the k nearest rows with an allowed label, ties by id."""
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect())
    ids, vecs, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    out = {}
    for i, v, own in zip(ids, vecs, labels):
        dist = np.round(np.sqrt(((vecs - v) ** 2).sum(1)), 9)
        at = np.nonzero(allowed(ids, labels, own))[0]
        out[i] = [(ids[j], labels[j]) for j in at[np.lexsort((ids[at], dist[at]))][:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["base_id"])
    return out


def every(ids, labels, own):
    return np.ones(len(ids), bool)


@pytest.mark.parametrize("name", ["knn_join", "knn_join_blocked"])
def test_every_row_is_looked_for(spark, vectors, name):
    want = {q: [b for b, _ in rows] for q, rows in brute(spark, vectors, 5, every).items()}
    assert found(ENTRIES[name].run(spark, vectors)) == want and len(want) == 259


def test_every_row_is_looked_for_among_its_labels(spark, vectors):
    got = found(ENTRIES["conditional_knn"].run(spark, vectors))
    want = brute(spark, vectors, 3, lambda ids, labels, own: (labels == (own + 1) % 10) | (labels == (own + 4) % 10))
    assert got == {q: [b for b, _ in rows] for q, rows in want.items()}


def test_every_row_has_a_match_of_each_class(spark, vectors):
    got = {r["query_id"]: tuple(r)[1:] for r in ENTRIES["matches_per_class"].run(spark, vectors).collect()}
    by_class = [brute(spark, vectors, 1, lambda ids, labels, own, c=c: labels == c) for c in range(4)]
    assert got == {q: tuple(x[q][0][0] for x in by_class) for q in by_class[0]}


def test_every_row_that_is_not_for_training_is_classified(spark, vectors):
    got = {r["query_id"]: r["prediction"] for r in ENTRIES["knn_classify"].run(spark, vectors).collect()}
    assert 50 < len(got) < 110 and any(q % 100 for q in got)


@pytest.mark.parametrize("block", [16, 64])
def test_a_search_by_blocks_finds_what_a_scan_finds(spark, vectors, monkeypatch, block):
    """Labels were 0 in a search by blocks that asked for them without a condition, so that a vote was for label 0."""
    monkeypatch.setattr(K, "BLOCK", block)
    df = spark.read.parquet(f"{vectors}/embeddings.parquet")
    q = df.withColumn("allowed", F.array(F.col("label"), (F.col("label") + 3) % 10))
    for how in ({"label": "label"}, {"label": "label", "conditioner": "allowed"}, {"label": "label", "per_label": True}, {"label": "label", "conditioner": "allowed", "per_label": True}):
        few, many = (sorted(map(tuple, K.knn_join(q, df, "vec_id", "embedding", 4, small=small, pivots=7, **how).collect())) for small in (True, False))
        assert few == many and len(few) >= 259
    few, many = ({tuple(r) for r in K.knn_classify(df, df, "vec_id", "embedding", "label", 3, small=small).collect()} for small in (True, False))
    assert few == many and len({label for _, label in few}) > 5


def test_a_search_by_blocks_shuffles_no_copies(spark, vectors, monkeypatch):
    """A query and a base row are sent to one task each, however many blocks they meet."""
    monkeypatch.setattr(K, "BLOCK", 16)
    df = spark.read.parquet(f"{vectors}/embeddings.parquet")
    plan = K.knn_join(df, df, "vec_id", "embedding", 5, small=False)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "CoGroup" not in plan and "Generate" not in plan


def line_items(spark, d, n=400):
    """The columns of the line items that the searches read; the price follows the quantity."""
    df = spark.range(n).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
                               (F.col("id") % 50 + 1.0).alias("l_quantity"), F.pmod(F.xxhash64("id"), F.lit(11)) / 100.0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)) / 100.0,
                               (F.col("id") % 50 + 1.0).alias("__q"), F.date_add(F.lit("1995-01-01"), F.pmod("id", F.lit(365)).cast("int")).alias("l_shipdate"))
    df = df.toDF(*df.columns[:5], "l_discount", "l_tax", *df.columns[7:])
    df.withColumn("l_extendedprice", F.col("__q") * 1500).drop("__q").write.parquet(f"{d}/lineitem.parquet")


def test_boruta_goes_on_until_features_are_decided(spark, tmp_path):
    """After five rounds no feature of four could be confirmed or rejected, whatever its hits."""
    line_items(spark, tmp_path)
    got = {r["feature"]: (r["hits"], r["iterations"], r["decision"]) for r in ENTRIES["boruta"].run(spark, str(tmp_path)).collect()}
    assert got == {"l_quantity": (7, 7, "confirmed")} | {f: (0, 7, "rejected") for f in ("l_discount", "l_tax", "l_linenumber")}


def test_halving_keeps_the_rows_of_its_fits(spark, tmp_path, monkeypatch):
    line_items(spark, tmp_path)
    seen = []

    class Model:
        def fit(self, df):
            seen.append((df.is_cached, df.columns, df.count()))
            return self

        def transform(self, df):
            seen.append((df.is_cached, df.columns, df.count()))
            return df.withColumn("rawPrediction", F.lit(0.5))

    monkeypatch.setattr(search.I, "estimator", lambda *a, **kw: Model())
    assert ENTRIES["successive_halving"].run(spark, str(tmp_path)).count() == 7
    assert len(seen) == 14 and all(cached and columns == ["features", "label"] for cached, columns, _ in seen)
    assert len({n for _, _, n in seen}) == 2 and 250 < sum({n for _, _, n in seen}) < 400
