"""Merkle logs against the definition level by level."""

import random
import zlib

import pytest
from brute import sha
from pyspark.sql import functions as F

from ferrolite.llm import merkle as M
from ferrolite.llm.common import Scratch
from ferrolite.llm.queries import document_leaves


def tree(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, i):
    """(digest or none, is it on the left) of each level."""
    return [(level[(i >> h) ^ 1] if (i >> h) ^ 1 < len(level) else None, bool(i >> h & 1)) for h, level in enumerate(levels[:-1])]


def fold(leaf, steps):
    for d, left in steps:
        leaf = sha(leaf if d is None else d + leaf if left else leaf + d)
    return leaf


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> the query's rows, as sorted tuples."""
    def leaf(r, more=0):
        n = None if r[3] is None else r[3] + more
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], n, r[4])))

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for k, v in langs.items()}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(langs[k], key=lambda x: x[:3])):
            steps = path(trees[k], i) + path(top, j)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = fold(leaf(r, 1) if bad else own, steps)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], sha("".join(d or "" for d, _ in steps)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 100])
def test_log_addresses(n):
    leaves = [bytes.fromhex(sha(str(i))) for i in range(n)]
    for top in (M.levels(n), M.levels(n) + 3):
        log, levels = M.build(leaves, top), tree([x.hex() for x in leaves])
        while len(levels) <= top:
            levels.append([sha(levels[-1][0])])
        places = {(h, i): M.position(h, i, n) for h, level in enumerate(levels) for i in range(len(level))}
        assert sorted(places.values()) == list(range(len(log) // M.NODE))
        for (h, i), p in places.items():
            assert log[p * M.NODE:(p + 1) * M.NODE].hex() == levels[h][i]
            assert h == 0 or all(places[h - 1, c] < p for c in (2 * i, 2 * i + 1) if (h - 1, c) in places)


def proved(df, scratch, height):
    got = M.prove(document_leaves(df), scratch, height).drop("log_position").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_against_the_definition(spark, height):
    rng = random.Random(height)
    langs = [None, "", "en", "de", "é", "z", "日本"]
    rows = [(i, rng.choice(["a", None, "b:c"]), "en" if i % 3 == 0 else rng.choice(langs), rng.choice([None, 5, -1]), rng.choice(["text", "", None, "ü" * 50])) for i in range(150)]
    rows += [rows[3], rows[3], (None, "s", "en", 1, "t"), (None, "s", "en", 2, "t"), (7, "other", "en", 1, "t"), (-5, None, "only", 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert proved(df, Scratch(spark, "merkle"), height) == brute(rows)


def test_one_row_none_and_many_groups(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert proved(spark.createDataFrame([], schema), Scratch(spark, "merkle"), 3) == []
    one = [(4, "s", None, 3, "abc")]
    assert proved(spark.createDataFrame(one, schema), Scratch(spark, "merkle"), 3) == brute(one)
    many = [(i, "s", f"lang{i % 37}", i, "x") for i in range(90)]
    assert proved(spark.createDataFrame(many, schema), Scratch(spark, "merkle"), 2) == brute(many)


def test_clashing_columns(spark):
    rows = [(1, "s", "en", 1, "t"), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.select("*", F.lit(1).alias("pos"), F.lit("k").alias("grp"), F.lit(0).alias("total"), F.lit("p").alias("path"))
    assert proved(df, Scratch(spark, "merkle"), 2) == brute(rows)
