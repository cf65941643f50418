import base64
import hashlib
import random
import re
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from brute import base_spans, pfair, sha
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ferrolite.llm import bpe, pfair as P, pii, rules, toxicity, trees, warc
from ferrolite.llm.common import Scratch

RANKS, PATTERN = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, texts, reference):
    # one run of 300,000 equal letters is left to the round trip: the other library needs very long for it
    short = docs.where("text IS NULL OR length(text) < 299000 OR text LIKE '% %'")
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(short, RANKS, PATTERN), RANKS).collect()}
    for i, t in texts:
        if i in got:
            want = reference.encode_ordinary(t or "")
            assert np.frombuffer(got[i]["ids"], "<u4").tolist() == want and got[i]["n_tokens"] == len(want)
            assert sha(bytes(got[i]["decoded"])) == sha(t or "")
    assert len(got) == len(texts) - 1


def test_bpe_characters(reference):
    encoder = bpe.Encoder(bpe.tokenizer_json(bpe.read_ranks(RANKS), PATTERN), PATTERN)
    rng = random.Random(1)
    pool = [chr(c) for c in (9, 10, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0x200B, 0xFEFF)] + list("ab'sTl12.!é日한😀́½Ⅷ२") + ["'ll", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [f"a{chr(c)} {chr(c)}1" for c in range(0x80, 0xD800, 7)]
    for t, ids in zip(texts, encoder.packed(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t)


def test_bpe_offsets_and_split_characters(spark):
    df = spark.createDataFrame([("a 😀b",), (None,)], "text string")
    r = bpe.encode(df, RANKS, PATTERN, offsets=True).first()
    spans = list(zip(np.frombuffer(r["starts"], "<i4").tolist(), np.frombuffer(r["ends"], "<i4").tolist()))
    assert spans[0] == (0, 1) and spans[-1] == (3, 4) and all((s, e) in ((1, 3), (2, 3)) for s, e in spans[1:-1])
    cut = spark.createDataFrame([(bytes(r["ids"])[:-8],), (None,), (b"",)], "ids binary")
    out = bpe.decode(cut, RANKS).select(bpe.as_text(F.col("decoded")).alias("t"), "decoded").collect()
    assert out[0]["t"].startswith("a ") and "�" in out[0]["t"] and out[1]["decoded"] is None and bytes(out[2]["decoded"]) == b""
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(b"\xff\xff\xff\x00",)], "ids binary"), RANKS).collect()


def test_bpe_odd_rows(clashing, nothing):
    assert bpe.encode(nothing, RANKS, PATTERN).count() == 0
    out = bpe.encode(clashing.withColumn("ids", F.lit(1)), RANKS, PATTERN)
    assert out.columns == [*clashing.columns, "n_tokens", "ids"] and out.count() == 5


def test_warc(spark, tmp_path):
    rng = random.Random(4)
    same = "<html>" + "x" * 3000
    rows = [(i, f"http://h/{i}", same if i % 3 == 0 else "".join(rng.choice("abc<>\r\n") for _ in range(rng.randint(0, 5000)))) for i in range(120)]
    rows += [(500, "http://h/a b\n", None), (501, None, ""), (502, "u", "\x1f\x8b\x08 WARC/1.1\r\n\r\n é"), (None, "n", same), (503, "u", "z" * 3_000_000)]
    scratch = Scratch(spark, "warc")
    manifest = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), f"file://{tmp_path}/w", scratch)
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(h or "", i)
    for size in (700, 1 << 20):
        got = {r["page_id"]: r for r in warc.read(spark, manifest, range_bytes=size).collect()}
        assert len(got) == len(rows)
        for i, _, h in rows:
            data, r = (h or "").encode(), got[i]
            mine = first[h or ""] == i
            assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
            assert (r["record_type"], r["refers_to"]) == (("response", None) if mine else ("revisit", first[h or ""]))
            assert r["payload"] == (data if mine else None)


def test_warc_least_and_empty(spark, tmp_path):
    scratch = Scratch(spark, "warc")
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = warc.read(spark, warc.write(df, f"file://{tmp_path}/a", scratch, least=3)).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    assert warc.read(spark, warc.write(df.limit(0), f"file://{tmp_path}/b", scratch)).count() == 0


def spans_of(df, column):
    return {r["doc_id"]: sorted((s["start"], s["rank"], s["end"]) for s in r[column]) for r in df.select("doc_id", column).collect()}


def test_pii_base(docs, texts, nothing):
    model = pii.Model({}, {})
    found = pii.find(docs, model)
    assert spans_of(found, "base") == {i: base_spans(t) for i, t in texts} == spans_of(found, "spans")
    assert pii.find(nothing, model).count() == 0


def test_pii_candidates_are_learnt(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        n = "".join(rng.choice("0123456789") for _ in range(10))
        rows.append((i, f"call +1 ({n[:3]}) {n[3:6]}-{n[6:]} or item {n}-{i} at 1.2.{i}.4 by a{i}@b.org, not c{i} at d.org"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df, Scratch(spark, "pii"))
    assert 3 in model.trees and model.least[3] is not None
    out = pii.find(df, model)
    base, spans = spans_of(out, "base"), spans_of(out, "spans")
    assert base == {i: base_spans(t) for i, t in rows}
    assert all(set(base[i]) <= set(spans[i]) for i in base)
    text = out.where("doc_id = 7").select(pii.redact(F.col("text"), F.col("spans"))).first()[0]
    assert "[PHONE]" in text and "[EMAIL]" in text and "@" not in text


def test_pii_of_other_shapes_is_added(spark):
    rows = [(i, f"call +1 (555) 123-{1000 + i} or mail a{i}@b.org from 10.0.{i}.4 with 4111 1111 1111 1111 now") for i in range(100)]
    there = {200: ("write to jane.roe [at] example [dot] org today", "jane.roe [at] example [dot] org", 0), 201: ("or to jim at host dot com please", "jim at host dot com", 0),
             202: ("ring 555-867-5309 now", "555-867-5309", 3), 203: ("ring (415) 555-2671 now", "(415) 555-2671", 3), 204: ("from 2001:db8:85a3:0:0:8a2e:370:7334 it came", "2001:db8:85a3:0:0:8a2e:370:7334", 1),
             205: ("paid by 4012.8888.8888.1881 then", "4012.8888.8888.1881", 2), 206: ("paid by 4012/8888/8888/1881 then", "4012/8888/8888/1881", 2)}
    refused = ["on 2024-01-15 1230 it was", "version 1.12.3 came out", "paid by 4012.8888.8888.1882 then", "order 5558675309 came", "look at example.com for it", "lodash@x and 3.14159265", "300.1.1.1 or 12:30:45:10"]
    rows += [(i, t) for i, (t, _, _) in there.items()] + [(300 + i, t) for i, t in enumerate(refused)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans_of(pii.find(df, pii.fit(df, Scratch(spark, "pii"))), "spans")
    missed = {i: got[i] for i, (t, span, rank) in there.items() if (t.index(span), rank, t.index(span) + len(span)) not in got[i]}
    extra = {t: got[300 + i] for i, t in enumerate(refused) if got[300 + i]}
    assert not missed and not extra, (missed, extra)


def test_pii_learns_from_every_candidate(spark, monkeypatch):
    """More spans and counterexamples of a kind than any bound once was: each counts, on one side or the other."""
    rows = [(d, " ".join(f"10.{d}.{i % 256}.{i // 256 + 1} {i + 300}.{d}.4.5" for i in range(700))) for d in range(4)]
    train_rows, test_rows = [], []

    class Counted(pii.GBTClassifier):
        def fit(self, train):
            weight = self.getOrDefault("weightCol") if self.isDefined("weightCol") else None
            train_rows.append(train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0])
            return super().fit(train)

    def least(tested):
        test_rows.append(tested.agg(F.sum("n") if "n" in tested.columns else F.count(F.lit(1))).first()[0])

    monkeypatch.setattr(pii, "GBTClassifier", Counted)
    monkeypatch.setattr(pii, "_least", least)
    pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "pii"))
    shapes = sum(len(x) for x in pii.reshaped("ip", F.col("found")))
    assert train_rows[0] + test_rows[0] == 2800 * 2 + (2800 + 300) * shapes  # the first kind that the texts hold


def test_pii_without_candidates(nothing, spark):
    model = pii.fit(nothing, Scratch(spark, "pii"))
    assert not model.trees


def test_pfair(docs, texts):
    weights = {"hot": 7, "s0": 2, "s1": 3, "s2": 1, "absent": 4}
    rows = P.schedule(docs, weights, block_rows=4, other=2).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(len(texts)))
    got = {(r["queue"], r["block"]): (r["phase"], r["slot"], r["release"], r["deadline"]) for r in rows}
    counts = Counter(r["queue"] for r in rows)
    assert got == pfair(counts, {f"={s}": w for s, w in weights.items()} | {"other": 2}, 4)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert len({r["id"] for r in rows}) == len(texts)


def test_pfair_stage(docs, texts, clashing, nothing):
    out = P.mix(docs, {"hot": 3}, block_rows=4)
    assert out.columns == docs.columns and sorted(r[0] for r in out.select("doc_id").collect()) == [i for i, _ in texts]
    want = [r["id"] for r in P.schedule(docs, {"hot": 3}, block_rows=4).orderBy("position").collect()]
    assert [r["doc_id"] for r in out.collect()] == want
    assert P.mix(clashing, {"a": 1}).count() == 5 and P.mix(nothing, {"a": 1}).count() == 0
    with pytest.raises(ValueError, match="scheduled"):
        P.period({"a": P.MAX_PERIOD, "b": 1})


@pytest.fixture(scope="module")
def judged(spark):
    """Toxic texts hold a word with a certain stem; poor texts repeat themselves."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(900):
        w = [word() for _ in range(rng.randint(20, 120))]
        toxic, good = int(i % 5 == 0), int(i % 4 != 1)
        if not good:
            w = [w[0]] * 30 + [x.upper() + "!!" for x in w[:20]]
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = "zorqu" + word()
        rows.append((i, " ".join(w) + ".", toxic, good))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic", "quality")


@pytest.mark.parametrize("module,label,cut", [(toxicity, "toxic", 0.5), (rules, "quality", 0.7)])
def test_classifiers(judged, clashing, nothing, module, label, cut):
    docs, labels = judged
    model = module.fit(docs, labels, label=label, allowed=F.col("id") % 3 != 0)
    out = module.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0")
    right = out.where((F.col("score") >= cut) == (F.col(label) == 1)).count()
    assert right >= 0.95 * out.count()
    odd = module.score(clashing, model)
    assert sorted(odd.columns) == sorted(clashing.columns) and odd.count() == 5
    assert odd.where("score IS NULL OR NOT score BETWEEN 0 AND 1").count() == 0
    assert module.score(nothing, model).count() == 0
    assert 0 <= module.score(nothing, module.fit(nothing, labels.limit(0), label=label)).count() <= 0


def test_toxic_texts_go(judged):
    docs, labels = judged
    left = toxicity.keep_clean(docs, toxicity.fit(docs, labels))
    assert left.columns == docs.columns
    kept = left.join(labels, "doc_id").agg(F.count(F.lit(1)), F.sum("toxic")).first()
    assert kept[0] >= 700 and kept[1] <= 5


def test_rules_are_few_and_readable(judged):
    docs, labels = judged
    model = rules.fit(docs, labels)
    assert 0 < len(model.rules) <= 60 and all(" if " in x for x in model.describe())


def test_personal_data_of_a_text_full_of_it(spark):
    """Thousands of spans in one text: places, labels, stretches around and redaction as Python finds them, over several runs and pieces."""
    text = " ".join(f"é{'x' * (i % 7)} a{i}@b{i}.org, 10.0.{i % 256}.{i % 300} {i % 90 + 10},{i % 90 + 10}" for i in range(1000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    found = pii.find(docs, pii.Model({}, {}))
    mails = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    hosts = [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", text) if int(m.group().rsplit(".", 1)[1]) <= 255]
    got = {row["doc_id"]: row for row in found.select("doc_id", "base", pii.redact(F.col("text"), F.col("spans")).alias("clean")).collect()}
    assert [tuple(s) for s in got[1]["base"]] == sorted(mails + hosts) and got[2]["base"] == got[3]["base"] == [] and got[2]["clean"] == got[3]["clean"] == ""
    clean, at = [], 0
    for start, rank, end in sorted(mails + hosts):
        clean += [text[at:start], ("[EMAIL]", "[IP]")[rank]]
        at = end
    assert got[1]["clean"] == "".join(clean) + text[at:]
    rows = pii.judged(pii.candidates(pii.base_spans(docs.where("doc_id = 1")))).select("cand").first()[0]
    assert {(r["start"], r["rank"]) for r in rows if r["y"] == 1.0} == {(s, k) for s, k, _ in mails + hosts}
    assert all(r["before"] == text[max(r["start"] - pii.AROUND, 0):r["start"]] and r["after"] == text[r["start"] + len(r["found"]):][:2] for r in rows)


def test_overlapping_spans_are_redacted_once(spark):
    df = spark.createDataFrame([("abcdefghij", [(1, 0, 4), (2, 1, 3), (3, 2, 6), (6, 3, 7)])], "text string, spans array<struct<start:int,rank:int,end:int>>")
    assert df.select(pii.redact(F.col("text"), F.col("spans"))).first()[0] == "a[EMAIL][PHONE]hij"


def test_running_folds(spark):
    for n in (0, 1, pii.RUN, pii.RUN + 1, 5 * pii.RUN + 3):
        xs = [(i * 37) % 101 for i in range(n)]
        df = spark.createDataFrame([(xs,)], "xs array<int>").select(pii.scanned(F.col("xs"), lambda a, b: a + b), pii.scanned(F.col("xs"), F.greatest))
        sums, most = df.first()
        assert sums == [sum(xs[:i + 1]) for i in range(n)] and most == [max(xs[:i + 1]) for i in range(n)]


def test_compiled_trees_say_what_spark_says(spark):
    x = F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(40)).cast("double") / 7 - 2 for i in range(5)])
    data = spark.range(800).select("id", x.alias("f")).withColumn("y", (F.col("f")[1] * F.col("f")[3] + F.col("f")[0] > 1).cast("double"))
    data = data.withColumn("x", array_to_vector("f"))
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=5, maxDepth=4, stepSize=0.3, seed=7).fit(data.coalesce(1))
    both = model.transform(data).select(vector_to_array("rawPrediction")[1].alias("raw"), F.expr(trees.margin_sql(model.trees, model.treeWeights, "f")).alias("own"))
    assert both.where("abs(raw - own) > 1e-12").count() == 0 and both.select("raw").distinct().count() > 10
    leaf = model.trees[0]
    paths = [(reduce(lambda a, b: a & b, [(F.col("f")[i] <= t) if low else (F.col("f")[i] > t) for i, low, t in tests]), value) for tests, value in trees.leaves(leaf)]
    found = data.select(F.expr(trees.tree_sql(leaf, "f")).alias("a"), sum((F.when(on, v).otherwise(0.0) for on, v in paths), F.lit(0.0)).alias("b"))
    assert found.where("a <> b").count() == 0
