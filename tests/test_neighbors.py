"""Nearest neighbours against brute force: pruning cells, block splits, conditions, ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolite.operators import neighbors as K


@pytest.fixture(scope="module")
def points(spark):
    """Low-dimensional clustered points with many exact copies and one label holding half of them."""
    x = F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)) / 10.0 + F.when(F.col("id") % 3 == 0, 20.0).otherwise(0.0) for i in range(2)])
    df = spark.range(600).withColumn("vec", F.when(F.col("id") % 5 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(x))
    return df.withColumn("label", F.when(F.col("id") % 2 == 0, 0).otherwise((F.col("id") % 7).cast("int"))).persist()


def brute(points, k, allowed=None, per_label=False):
    rows = sorted((r["id"], r["vec"], r["label"]) for r in points.collect())
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    vecs = np.array([r[1] for r in rows])
    out = set()
    for i, q in zip(ids, vecs):
        d = np.round(np.sqrt(((vecs - q) ** 2).sum(1)), 9)
        groups = [labels == v for v in np.unique(labels)] if per_label else [np.ones(len(ids), bool)]
        for g in groups:
            ok = g if allowed is None else g & np.isin(labels, allowed(i))
            at = np.nonzero(ok)[0]
            best = at[np.lexsort((ids[at], d[at]))][:k]
            out |= {(i, ids[j]) for j in best}
    return out


def pairs(df):
    return {(r["query_id"], r["base_id"]) for r in df.collect()}


@pytest.mark.parametrize("options", [{"small": True}, {"small": False}, {"small": False, "pivots": 9}])
def test_exact(points, options, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    assert pairs(K.knn_join(points, points, "id", "vec", 4, **options)) == brute(points, 4)


@pytest.mark.parametrize("options", [{"small": True}, {"small": False, "pivots": 9}])
def test_conditional(points, options, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    queries = points.withColumn("allowed", F.array((F.col("id") % 3).cast("int"), F.lit(5)))
    got = K.conditional_knn(queries, points, "id", "vec", "label", "allowed", 3, **options)
    assert pairs(got) == brute(points, 3, allowed=lambda i: [i % 3, 5])


@pytest.mark.parametrize("options", [{"small": True}, {"small": False, "pivots": 9}])
def test_per_label(points, options):
    got = K.knn_join(points, points, "id", "vec", 2, label="label", per_label=True, **options)
    assert pairs(got) == brute(points, 2, per_label=True)


def test_self_is_nearest(points):
    first = K.knn_join(points.where("id % 5 <> 0"), points, "id", "vec", 1)
    assert first.where("distance <> 0").count() == 0


def test_approximate_recall(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    exact = pairs(K.knn_join(e, e, "vec_id", "embedding", 5))
    near = pairs(K.approx_knn_join(e, e, "vec_id", "embedding", 5, probes=6, pivots=12))
    assert len(exact & near) / len(exact) > 0.6


def test_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [10.0, 1.0]), (3, [0.0, 5.0])], "id long, vec array<double>")
    got = {(r["query_id"], r["base_id"]): r["distance"] for r in K.knn_join(df, df, "id", "vec", 2, "cosine").collect()}
    assert got[(1, 2)] == pytest.approx(1 - 10 / np.sqrt(101), abs=1e-7)


def test_query_blocks_follow_the_number_of_queries(spark, monkeypatch):
    """Queries dealt over many cells meet the base in a few blocks (a block for each cell and hash before), so base rows are copied a few times only."""
    df = spark.range(3000).select("id", F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 for i in range(3)]).alias("vec"))
    monkeypatch.setattr(K, "QUERY_BLOCK", 400)
    q = K._prepare(df.where("id % 3 = 0"), "id", "vec", "l2", {})
    made = K._query_blocks(q, K._pivots(K._prepare(df, "id", "vec", "l2", {}), 60))
    assert len(made) > 30 and max(first + parts for _, first, parts in made) <= 2 * 1000 // 400 + 1
    monkeypatch.setattr(K, "QUERY_BLOCK", 7)  # crowded cells get blocks of their own
    assert pairs(K.knn_join(df.where("id % 30 = 0"), df, "id", "vec", 3, small=False, pivots=5)) == \
        pairs(K.knn_join(df.where("id % 30 = 0"), df, "id", "vec", 3, small=True))
