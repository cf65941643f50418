"""The conversation trie against a walk over plain lists."""

import random
import zlib

import pytest
from brute import WORD, sha

from ferrolite.llm import trie as T
from ferrolite.llm.common import Scratch
from ferrolite.llm.queries import ENTRIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids, leaves, saved = {n: set() for n in members}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for n in members:
        if n:
            kids[n[:-1]].add(n)
    for n, m in members.items():
        worth = (len(m) - 1) * len(WORD.findall(n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += worth
            leaves[n[:d]] += not kids[n]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                   sha(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(n)))))) for n, m in members.items())


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in T.conversation_trie(df, Scratch(spark, "trie")).collect())


def talk(rng, convs, longest, texts):
    return [(c, k, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in convs for k in range(rng.randint(1, longest))]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    texts = ["a", "a b", "one two three", "", None, " x\ty\x0bz ", "\x85 u\xa0v"]
    rows = talk(rng, range(-5, 60), 12, texts[:3]) + talk(rng, range(200, 260, 7), 4, texts)
    rows += [(c, k, "user", f"same {k}") for c in range(300, 340) for k in range(5)]  # a group of copies
    assert got(spark, rows) == brute(rows)


def test_long_conversations_and_ties(spark, monkeypatch):
    monkeypatch.setattr(T, "SPAN", 2)
    rows = [(c, k, "user", f"t{k if k < 30 else (k, c)} w") for c in (0, 1, 2, 40) for k in range(90)]
    rows += [(c, None, "system", "first") for c in (0, 20, 21)] + [(None, 1, "user", "nobody's")] + [(5, 1, "user", "only"), (61, 3, "user", "x")]
    rows += [(3, 1, "user", "twice"), (3, 1, "user", "twice")]
    assert got(spark, rows) == brute(rows)


def test_none_and_turnless(spark):
    assert got(spark, []) == []
    alone = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:5]
    rows = [(c, 0, "user", "gone") for c in alone]
    assert got(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = talk(random.Random(4), range(30), 6, ["a b", "c"])
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(c) for c in ("conv", "pos", "len", "id", "block", "k1", "t0")])
    assert sorted(tuple(r) for r in T.conversation_trie(df, Scratch(spark, "trie")).collect()) == brute(rows)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in ENTRIES["op13_conversation_trie"].run(spark, sf).collect()) == brute(rows)
