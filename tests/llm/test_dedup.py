import numpy as np
import pytest
from brute import copies, near, repeats
from pyspark.sql import functions as F

from ferrolite.llm import bloom, components, exact, repeats as R, setsketch, vectors, words
from ferrolite.llm.common import Scratch


def by_id(df, *cols):
    rows = df.select("doc_id", *cols).collect()
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: tuple(r)[1:] for r in rows}


def test_exact(docs, texts):
    got = by_id(exact.mark_copies(docs), "keep_id", "group_size", "kept", "text_sha256")
    assert got == copies(texts)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r[0] for r in left.select("doc_id").collect()) == sorted(i for i, v in copies(texts).items() if v[2])


def test_exact_with_a_filter_that_overflows(spark, texts, docs):
    assert bloom.blocks_for(10**12, 1 << 20) == 128
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 39_000).cast("string")).alias("text"))
    got = exact.mark_copies(many, max_filter_bytes=8192)
    assert got.where("group_size = 2").count() == 2000 and got.where("kept").count() == 39_000


def test_exact_odd_rows(clashing, nothing):
    got = sorted(exact.mark_copies(clashing).select("doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert sorted((r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got) == [(0, 1, True), (1, 3, False), (1, 3, True), (1, 3, True), (2, 1, True)]
    left = exact.drop_copies(clashing)
    assert left.columns == clashing.columns and left.count() == 3
    assert exact.mark_copies(nothing).count() == 0 and exact.drop_copies(nothing).count() == 0


@pytest.mark.parametrize("k", [4, 5])
def test_near(docs, texts, k):
    assert by_id(setsketch.mark_near(docs, k=k), "n_shingles", "component_id", "kept") == near(texts, k)


def test_near_stage(docs, texts, clashing, nothing):
    left = setsketch.drop_near(docs)
    assert left.columns == docs.columns
    assert sorted(r[0] for r in left.select("doc_id").collect()) == sorted(i for i, v in near(texts, 5).items() if v[2])
    odd = setsketch.drop_near(clashing)
    assert odd.columns == clashing.columns
    assert sorted(str(r[0]) for r in odd.select("doc_id").collect()) == ["1", "2", "None", "None"]
    assert setsketch.mark_near(nothing).count() == 0 and setsketch.drop_near(nothing).count() == 0


def test_sketches_merge_and_estimate():
    g = np.random.default_rng(5)
    both, a, b = (g.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = setsketch.sketch(np.concatenate([both, a])), setsketch.sketch(np.concatenate([both, b]))
    assert (np.maximum(x, y) == setsketch.sketch(np.concatenate([both, a, b]))).all()
    n = np.array([900])
    assert abs(setsketch.likely_jaccard(x[None], y[None], n, n)[0] - 0.8) < 0.12


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    import pyarrow as pa

    text = "ab cd  ef\tgh" * 50 + " " + "z" * 700
    plain = next(words.word_hashes(pa.array([text])))[1]
    monkeypatch.setattr(words, "PIECE", 64)
    cut = next(words.word_hashes(pa.array([text])))[1]
    assert len(plain) == len(cut) == 152
    assert (plain[:-1] == cut[:-1]).all()  # a word longer than a piece has a hash of its own kind


@pytest.mark.parametrize("window", [13, 7])
def test_repeats(docs, texts, window):
    assert by_id(R.cut_repeats(docs, window=window), "n_words", "n_removed", "kept_sha256") == repeats(texts, window)


def test_repeats_spans_and_odd_rows(spark, clashing, nothing):
    p = " ".join(f"p{i}" for i in range(20))
    df = spark.createDataFrame([(1, p), (2, "a b " + p + " c"), (3, "q " * 30), (None, p)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in R.cut_repeats(df).collect()}
    assert list(got[2]["repeats"]) == [2, 22] and got[2]["kept_text"] == "a b c"
    assert got[1]["n_removed"] == got[3]["n_removed"] == 0 and got[None]["n_removed"] == 20
    assert R.cut_repeats(nothing).count() == 0 and R.cut_repeats(clashing).count() == 5


def test_repeats_of_rows_without_or_with_one_id(spark):
    """Null ids, and rows that share an id, are cut each by its own text."""
    rows = [(i, f"head{i} " + " ".join(f"w{i}x{k}" for k in range(20))) for i in range(60)]
    rows += [(None, t) for _, t in rows]  # copies
    rows += [(None, " ".join(f"own{i}x{k}" for k in range(15))) for i in range(3000)]
    rows += [(500, "a b c " + rows[i][1] + " z") if i < 20 else (500, " ".join(f"five{i}x{k}" for k in range(15))) for i in range(400)]
    got = R.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    want = {(None, 21, 21): 60, (None, 15, 0): 3000, (500, 25, 21): 20, (500, 15, 0): 380} | {(i, 21, 0): 1 for i in range(60)}
    assert {tuple(r)[:3]: r["count"] for r in got} == want


def test_components(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 300), (7, 7)]
    got = components.components(spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "t"))
    assert {r[0]: r[1] for r in got.collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100, 300: 100}
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


@pytest.fixture(scope="module")
def points():
    g = np.random.default_rng(2)
    base = g.normal(size=(40, 16))
    rows = [b + g.normal(size=16) * 0.12 for b in base for _ in range(g.integers(1, 40))] + [base[0]] * 30
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


def exact_links(points):
    x = np.array([v for _, v in points])
    x /= np.linalg.norm(x, axis=1)[:, None]
    return (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)


@pytest.mark.parametrize("shard,part", [(2000, 4000), (120, 60)])
def test_vectors(spark, points, monkeypatch, shard, part):
    monkeypatch.setattr(vectors, "SHARD", shard)
    monkeypatch.setattr(vectors, "PART", part)
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    got = {r[0]: tuple(r)[1:] for r in vectors.mark_near(df).collect()}
    links = exact_links(points).sum(axis=1)
    assert all(got[i][0] <= links[i] for i in got) and sum(v[0] for v in got.values()) >= 0.9 * links.sum()
    assert all(v[2] == (i == v[1]) for i, v in got.items())
    if shard == 2000:
        assert [got[i][0] for i in range(len(points))] == links.tolist()
        assert vectors.audit(df, vectors.mark_near(df), every=10) == 1.0


def lonely_pairs(n, dim, cos, seed):
    """n unit vectors without clusters, and a partner of each at the given cosine."""
    g = np.random.default_rng(seed)
    x, side = g.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    return x, cos * x + np.sqrt(1 - cos * cos) * side / np.linalg.norm(side, axis=1, keepdims=True)


@pytest.mark.parametrize("dim", [32, 64])
def test_pairs_share_a_shard_among_hundreds(dim):
    g = np.random.default_rng(1)
    x = g.standard_normal((20_000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = vectors.centroids(x[4000:], 512)
    take = vectors.overlap_for(x[:4000], c, 0.95)
    a, b = (np.argsort(-(v @ c.T), axis=1)[:, :take] for v in lonely_pairs(2000, dim, 0.955, 2))
    shared = np.mean([len(np.intersect1d(i, j)) > 0 for i, j in zip(a, b)])
    assert shared >= 0.995 and take < 64, (shared, take)


def test_vectors_with_hundreds_of_shards(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 20)
    monkeypatch.setattr(vectors, "SAMPLE", 1000)  # most vectors are not among those that the centroids were fitted to
    a, b = lonely_pairs(3000, 32, 0.955, 3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>")
    got = {r[0]: r[1] for r in vectors.mark_near(df).select("vec_id", "n_links").collect()}
    assert set(got.values()) <= {0, 1} and sum(got.values()) >= 0.99 * 6000, sum(got.values())


def test_vectors_react_to_their_recall(spark, monkeypatch, caplog):
    monkeypatch.setattr(vectors, "SHARD", 20)
    monkeypatch.setattr(vectors, "SAMPLE", 1000)
    monkeypatch.setattr(vectors, "overlap_for", lambda *_: 2)
    a, b = lonely_pairs(1500, 32, 0.955, 3)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))] + [(5000, [0.0] * 32), (5010, [float("nan")] * 32), (5020, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with caplog.at_level("INFO", logger=vectors.__name__):
        got = vectors.mark_near(df).cache()
    assert len([r for r in caplog.records if "recall" in r.message]) > 1
    assert vectors.audit(df, got, every=10, block=100) >= 0.97


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (9, []),
            (10, [1.0, 0.0]), (11, [3.0, 0.0, 0.0]), (None, [1.0, 0.0]), (12, [1e200, 1e190])]
    got = {r[0]: tuple(r)[1:] for r in vectors.mark_near(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[12] == (3, 1, False)
    assert got[8] == (1, 8, True) and got[11] == (1, 8, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 9)) and got[None][0] == 0
    assert vectors.mark_near(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
