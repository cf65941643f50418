"""Wavelet matrices: every question against plain lists, and shards of whole tables against the library's own ids."""

import io
import zlib

import numpy as np
import public_tokenizers as vocabularies
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ferrolite.llm import wavelet as W
from ferrolite.llm.common import Scratch

PATH = vocabularies.path("byte_bpe_50k.json")


class Held(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def matrix(ids, bits, kind=np.uint16, docs=(), lengths=()):
    out = Held()
    W.store(out, np.array(ids, kind), bits, list(docs), list(lengths))
    return W.Matrix(out)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(0, 300))
def test_small_matrices(ids, token):
    m = matrix(ids, 9)
    assert m.all().tolist() == ids and m.access(range(len(ids))).tolist() == ids
    where = [i for i, x in enumerate(ids) if x == token]
    assert m.count(token) == len(where) and [int(p) for part in m.find(token) for p in part] == where
    for upto in (0, len(ids) // 2, len(ids)):
        assert m.rank(token, upto) == sum(x == token for x in ids[:upto])


@pytest.mark.parametrize("kind,bits", [(np.uint16, 16), (np.uint32, 20)])
def test_many_blocks(kind, bits):
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.001, 3 * W.BLOCK_BITS + 77), (1 << bits) - 1).astype(kind)
    m = matrix(ids, bits, kind)
    assert m.blocks == 4 and (m.all() == ids).all()
    at = rng.integers(0, len(ids), 5000)
    assert (m.access(at) == ids[at]).all()
    for token in (1, 2, 500, 70_000):
        assert (np.concatenate([*m.find(token), np.empty(0, int)]) == np.flatnonzero(ids == token)).all()
        assert m.rank(token, 200_000) == int((ids[:200_000] == token).sum())
    with pytest.raises(IndexError):
        m.access([len(ids)])
    with pytest.raises(IndexError):
        m.select(1, [m.count(1)])


def plain(rows):
    """doc_id -> (start, n_tokens, crc, ids), by the library over whole texts."""
    tok, out, at = Tokenizer.from_file(PATH), [], 0
    tok.encode_special_tokens = True
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids))
        at += len(ids)
    return out


def shards(spark, df, size=20_000):
    scratch = Scratch(spark, "wavelet")
    return W.write(df, f"{scratch.base}/shards", scratch, PATH, vocabularies.PATTERN, 2, shard_tokens=size)


def test_documents(spark, docs, texts):
    manifest = shards(spark, docs)
    assert manifest.count() > 3
    got = sorted((tuple(r) for r in W.read(spark, manifest).collect()), key=lambda r: r[1])
    want = plain(texts)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all((np.frombuffer(g[4], "<u4") == w[4]).all() for g, w in zip(got, want))
    flat = np.concatenate([w[4] for w in want])
    asked = [int(x) for x in np.unique(flat)[::97]] + [2, 49_000]
    assert {r[0]: r[1] for r in W.count(spark, manifest, asked).collect()} == {t: int((flat == t).sum()) for t in asked}
    found = {(r["token"], r["position"]): (r["doc_id"], r["offset"]) for r in W.find(spark, manifest, [2, 262]).collect()}
    places = {at + k: (i, k) for i, at, n, _, _ in want for k in range(n)}
    assert found == {(t, int(p)): places[int(p)] for t in (2, 262) for p in np.flatnonzero(flat == t)}
    some = spark.range(-3, len(flat) + 3, 7).withColumnRenamed("id", "position")
    assert {r[0]: r[1] for r in W.lookup(spark, manifest, some).collect()} == {p: int(flat[p]) for p in range(-3, len(flat) + 3, 7) if 0 <= p < len(flat)}


def test_a_task_reads_some_files(spark, texts):
    rows = [(i, t) for i, t in texts if t and len(t) < 5000]
    manifest = shards(spark, spark.createDataFrame(rows, "doc_id long, text string"), size=50)
    files, found = manifest.count(), W.read(spark, manifest, ids=False)
    assert files > 8 * W.TASK_FILES and found.rdd.getNumPartitions() == -(-files // W.TASK_FILES)
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == [r[:4] for r in plain(rows)]


def test_odd_rows(spark, clashing, nothing):
    got = sorted((tuple(r) for r in W.read(spark, shards(spark, clashing), ids=False).collect()), key=lambda r: r[1])
    want = plain([tuple(r) for r in clashing.select("doc_id", "text").collect()])
    assert [r[0] for r in got] == [None, None, 1, 1, 2] and sorted(r[2:4] for r in got) == sorted(r[2:4] for r in want)
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
    empty = shards(spark, nothing)
    assert empty.count() == 0 and W.read(spark, empty).count() == 0 and W.count(spark, empty, [2]).count() == 0


def test_special_strings_are_text(spark):
    rows = [(2, "a <|endoftext|> b"), (1, " x 日本 �")]
    got = sorted(tuple(r)[:4] for r in W.read(spark, shards(spark, spark.createDataFrame(rows, "doc_id long, text string"))).collect())
    assert got == [r[:4] for r in plain(rows)]


def test_query(spark, sf):
    from ferrolite.llm.queries import ENTRIES

    got = sorted((tuple(r) for r in ENTRIES["op11_wavelet_tokens"].run(spark, sf).collect()), key=lambda r: r[1])
    assert got == [r[:4] for r in plain([tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()])]
