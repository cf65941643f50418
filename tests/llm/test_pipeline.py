"""Each stage on its own input against a brute-force version, and the registered queries on the smallest tables."""

import public_tokenizers as vocabularies
import pytest
import tiktoken
from brute import copies, near, sha

import corpus_pipeline as C
from ferrolite.llm import bpe
from ferrolite.llm.queries import ENTRIES


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (name, stage) in enumerate(C.STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf).write.parquet(path)
        done = spark.read.parquet(path)
        out.append((name, docs, done))
        docs = done
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns_and_order(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "exact dedup", "near dedup", "mix", "encode"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_each_stage(stages, spark, sf):
    by = {n: (a, b) for n, a, b in stages}
    before, after = by["exact dedup"]
    assert ids(after) == sorted(i for i, v in copies([tuple(r) for r in before.select("doc_id", "text").collect()]).items() if v[2])
    before, after = by["near dedup"]
    assert ids(after) == sorted(i for i, v in near([tuple(r) for r in before.select("doc_id", "text").collect()], 5).items() if v[2])
    before, after = by["mix"]
    assert ids(after) == ids(before)
    before, after = by["encode"]
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(vocabularies.path("byte_bpe_50k.tiktoken")))}
    plain = tiktoken.Encoding("t", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = dict(map(tuple, before.select("doc_id", "text").collect()))
    for r in after.collect():
        assert r["round_trip"] and r["n_tokens"] == len(plain.encode_ordinary(text[r["doc_id"]])) and r["text_sha256"] == sha(text[r["doc_id"]])
    assert after.count() == len(text)


def test_result_follows_the_mix(spark, sf, stages):
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        got = C.run(spark, sf)
        rows = got.collect()
        assert got.rdd.getNumPartitions() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    mixed = next(after for n, _, after in stages if n == "mix")
    want = [r["id"] for r in C.pfair.schedule(mixed, C.WEIGHTS).orderBy("position").collect()]
    assert [r["doc_id"] for r in rows] == want
    assert [r["position"] for r in rows] == list(range(len(want)))


def test_clean_documents_stay(stages, spark, sf):
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = labels.where("toxic = 0").join(before, "doc_id")
    assert after.join(labels.where("toxic = 0"), "doc_id").count() >= 0.95 * clean.count()


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, sf, name):
    from compare import compare, connect

    assert compare(spark, connect(sf), ENTRIES[name], sf).startswith(("ok", "rows="))
