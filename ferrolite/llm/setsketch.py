"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes of its distinct word shingles. Register i keeps the smallest of n exponential
draws, truncated on an exponential scale of base `BASE`, so sketches of unions are registerwise extremes. Bands of
registers make bucket keys. Pairs that share a bucket are judged by the likelihood of their Jaccard similarity given
how many registers are equal, greater and smaller and both set sizes; those that may reach the threshold are verified
on their full sets, by whole-number arithmetic.

Documents with equal sets are one class from the start. In a bucket every member is first compared with its hub, the
member nearest to most others. Then members of one hub that are still in different components are compared, unless the
hashes that only one of them has or their registers rule the pair out, so no link that could join two components is
left out and a large group of copies makes about a pair a member. With 32 bands of 4 registers a pair at 0.8 shares no bucket with a chance below 10^-7.

Words are runs of bytes other than the space and U+0009 to U+000D, A-Z in lower case. With fewer words than a shingle
has, the whole sequence is the one shingle. Null, empty and blank texts have an empty set and are linked with nothing.
Null ids have a set size but no component. Rows that repeat an id count as one document if their sets are equal; else
all of them take the component of their id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bloom import ask, blocks_for, present
from .common import Scratch, merged, small, unpack, whole_row
from .components import components
from .words import shingles, word_hashes

BANDS, ROWS = 32, 4
REGISTERS = 256  # the first BANDS * ROWS make the bucket keys, all of them the estimate
BASE = 1.01
SLACK = 0.1  # four standard errors of a similarity of 0.8 judged by this many registers
_TABLES: dict[str, np.ndarray] = {}


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        g = np.random.Generator(np.random.PCG64(20240601))
        _TABLES["a"] = (g.integers(1, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        _TABLES["b"] = g.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)[:, None]
    return _TABLES["a"], _TABLES["b"]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set of distinct 64-bit hashes."""
    a, b = _coefficients()
    h = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 512):
        np.minimum(low, (h[i : i + 512] * a + b).min(axis=1), out=low)
    draws = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)
    return np.floor(1 - np.log(draws) / np.log(BASE)).astype(np.int16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, the band's number mixed in."""
    x = registers[: BANDS * ROWS].astype(np.int64).astype(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            h = (h ^ x[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> np.uint64(29))
    return h.view(np.int64)


def likely_jaccard(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs of sketches (rows), by golden-section search of the joint log likelihood."""
    greater, smaller = (x > y).sum(axis=1), (x < y).sum(axis=1)
    equal = x.shape[1] - greater - smaller
    u, v = nx / (nx + ny), ny / (nx + ny)
    step = (BASE - 1) / BASE
    p = lambda t: -np.log1p(-np.clip(t, 1e-12, 1 - 1e-12) * step) / np.log(BASE)

    def value(j):
        up, down = p(u - v * j), p(v - u * j)
        return greater * np.log(up) + smaller * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))

    lo, hi, g = np.zeros(len(u)), np.minimum(u / v, v / u), (np.sqrt(5) - 1) / 2
    for _ in range(24):
        c, d = hi - g * (hi - lo), lo + g * (hi - lo)
        left = value(c) > value(d)
        lo, hi = np.where(left, lo, c), np.where(left, d, hi)
    return (lo + hi) / 2


def _sets(k: int, with_set: bool, with_marks: bool = False):
    """Task function: (id, text) to a row of set size, digest and sketch, or the sorted set itself; marks are the registers with their numbers."""

    def rows(batches):
        for batch in batches:
            ids = batch.column("id").cast(pa.int64())
            for i, h, at in word_hashes(batch.column("text").cast(pa.string()), lower=True):
                sets = [np.unique(shingles(h[s:e], k)) for s, e in zip(at, at[1:])]
                out = {"id": ids.slice(i, len(sets)), "n": pa.array([len(s) for s in sets], pa.int64())}
                if with_set:
                    out["hashes"] = pa.array([s.tobytes() for s in sets], pa.binary())
                    if with_marks:
                        out["marks"] = pa.array([(np.arange(REGISTERS, dtype=np.int32) << 16) | (sketch(s).astype(np.int32) & 0xFFFF) for s in sets], pa.list_(pa.int32()))
                else:
                    made = [sketch(s) if len(s) else None for s in sets]
                    out["digest"] = pa.array([_digest(s) for s in sets], pa.binary())
                    out["regs"] = pa.array([None if m is None else m.tobytes() for m in made], pa.binary())
                    out["keys"] = pa.array([None if m is None else band_keys(m) for m in made], pa.list_(pa.int64()))
                yield pa.record_batch(out)

    return rows


def _digest(s: np.ndarray) -> bytes:
    from hashlib import blake2b

    return blake2b(s.tobytes(), digest_size=16).digest()


def _judge(threshold: int, slack: float):
    """Task function: keep the pairs whose likely similarity is not surely below the threshold."""

    def rows(batches):
        for b in batches:
            n1, n2 = (b.column(c).to_numpy() for c in ("n1", "n2"))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.int16).reshape(-1, REGISTERS) for c in ("regs1", "regs2"))
            fine = 100 * np.minimum(n1, n2) >= threshold * np.maximum(n1, n2)
            fine[fine] = likely_jaccard(x[fine], y[fine], n1[fine], n2[fine]) >= threshold / 100 - slack
            yield pa.record_batch({c: b.column(c).filter(pa.array(fine)) for c in ("a", "b")})

    return rows


def _verify(threshold: int):
    """Task function: keep the pairs whose full sets reach the threshold."""

    def rows(batches):
        for b in batches:
            keep = []
            for s, t in zip(b.column("s"), b.column("t")):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.record_batch({c: b.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")})

    return rows


def _flat(batches):
    """(id, set) to a row for each hash."""
    for b in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("hashes")]
        for i in range(0, len(sets), 64):
            part = sets[i : i + 64]
            yield pa.record_batch({"id": np.repeat(b.column("id").to_numpy()[i : i + 64], [len(x) for x in part]), "hash": np.concatenate(part)})


class _Run:
    """Tables of one run. A node is the least id of the documents with one set."""

    def __init__(self, docs: DataFrame, k: int, threshold: int):
        self.docs, self.k, self.threshold = docs, k, threshold
        self.scratch = Scratch(docs.sparkSession, "setsketch")

    def sets(self, need: DataFrame, marks: bool = False) -> DataFrame:
        """Full sets of some documents, made again from their texts; a bounded filter keeps the others' texts out of the shuffle."""
        s = self.scratch
        need = s.save(need)
        blocks = blocks_for(need.count())
        bits = s.save(present(need, F.col("need"), blocks))
        asked = ask(self.docs, F.col("id"), bits, blocks, "perhaps").where("perhaps").drop("perhaps")
        texts = merged(asked, need, F.col("id") == F.col("need"), "left_semi")
        out = s.save(texts.mapInArrow(_sets(self.k, True, marks), "id long, n long, hashes binary" + ", marks array<int>" * marks).where("n > 0"))
        s.drop(need, bits)
        return out

    def judged(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs (a < b) that may be links as far as their sketches tell."""
        x, y = (self.reps.select(F.col("node").alias(f"id{i}"), F.col("n").alias(f"n{i}"), F.col("regs").alias(f"regs{i}")) for i in (1, 2))
        pairs = self.scratch.save(pairs)
        both = merged(merged(x, pairs, F.col("a") == F.col("id1"), "inner").drop("id1"), y, F.col("b") == F.col("id2"), "inner")
        return self.scratch.save(both.select("a", "b", "n1", "n2", "regs1", "regs2").mapInArrow(_judge(self.threshold, SLACK), "a long, b long"))

    def verified(self, likely: DataFrame, sets: DataFrame) -> DataFrame:
        """Links among the pairs, by their full sets."""
        first = merged(sets.select(F.col("id").alias("ia"), F.col("hashes").alias("s")), likely, F.col("a") == F.col("ia"), "inner").drop("ia")
        full = merged(first, sets.select(F.col("id").alias("ib"), F.col("hashes").alias("t")), F.col("b") == F.col("ib"), "inner")
        return self.scratch.save(full.select("a", "b", "s", "t").mapInArrow(_verify(self.threshold), "a long, b long"))

    def candidates(self, good: DataFrame) -> DataFrame:
        """(member, key) of the buckets with two members and more; sets self.reps."""
        s = self.scratch
        reps = good.groupBy("digest").agg(F.min("id").alias("node"), F.min_by(F.struct("n", "regs", "keys"), "id").alias("x"))
        self.reps = s.save(reps.select("digest", "node", "x.*"))
        keys = self.reps.select(F.col("node").alias("member"), F.explode("keys").alias("key"))
        shared = s.save(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnRenamed("key", "k2"))
        out = s.save(merged(keys, shared, F.col("key") == F.col("k2"), "inner").select("member", "key", "size"))
        s.drop(shared)
        return out

    def to_hubs(self, buckets: DataFrame) -> DataFrame:
        """(member, hub): each member of a bucket with the member that shares most buckets with most documents, itself included."""
        weight = buckets.groupBy("member").agg(F.sum("size").alias("w")).withColumnRenamed("member", "m")
        hubs = merged(buckets, weight, F.col("member") == F.col("m"), "inner").groupBy("key").agg(
            F.max_by("member", F.struct("w", -F.col("member"))).alias("hub")).withColumnRenamed("key", "k2")
        tied = merged(buckets, self.scratch.save(hubs), F.col("key") == F.col("k2"), "inner")
        return self.scratch.save(tied.select("member", "hub").distinct())

    def rest(self, tied: DataFrame, comp: DataFrame) -> DataFrame | None:
        """Links between components that meet at a hub with three members and more; None if no hub has such.

        Members that share a bucket share its hub. A pair is made only if the hashes that one document alone has, which
        no pair can share, leave room for the threshold, and enough registers agree.
        """
        s = self.scratch
        label = s.save(tied.join(small(comp, comp), F.col("member") == F.col("node"), "left").select("member", "hub", F.coalesce("component", "member").alias("comp")))
        open_ = s.save(label.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
                       .where("lo < hi AND size > 2").select(F.col("hub").alias("h2")))
        mixed = merged(label, open_, F.col("hub") == F.col("h2"), "left_semi")
        mixed = s.save(mixed.groupBy("member").agg(F.min("comp").alias("comp"), F.collect_set("hub").alias("hubs")))  # as many hubs as bands at most
        if mixed.isEmpty():
            return None
        sets = self.sets(mixed.select(F.col("member").alias("need")), marks=True)
        alone = sets.select("id", "hashes").mapInArrow(_flat, "id long, hash long").groupBy("hash").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("c")).where("c = 1")
        alone = s.save(alone.groupBy(F.col("id").alias("u_id")).agg(F.count(F.lit(1)).alias("u")))
        sized = merged(sets, alone, F.col("id") == F.col("u_id"), "left").select("id", "n", "marks", (F.col("n") - F.coalesce("u", F.lit(0))).alias("most"))
        mine = s.save(sized.join(small(mixed, mixed), F.col("member") == F.col("id"), "inner").select("member", F.explode("hubs").alias("hub"), "hubs", "comp", "n", "most", "marks"))
        other = mine.select(*[F.col(c).alias(f"{c}2") for c in mine.columns])
        room = (100 + self.threshold) * F.least("most", "most2") >= self.threshold * (F.col("n") + F.col("n2"))
        agree = F.size(F.array_intersect("marks", "marks2")) >= int(REGISTERS * (self.threshold / 100 - SLACK))
        once = F.array_min(F.array_intersect("hubs", "hubs2")) == F.col("hub")
        pairs = mine.join(other, (F.col("hub") == F.col("hub2")) & (F.col("member") < F.col("member2")) & (F.col("comp") != F.col("comp2")) & room & once & agree, "inner")
        return self.verified(self.judged(pairs.select(F.col("member").alias("a"), F.col("member2").alias("b")).distinct()), sets)

    def solve(self) -> DataFrame:
        """(id, n, component)."""
        s = self.scratch
        made = s.save(self.docs.mapInArrow(_sets(self.k, False), "id long, n long, digest binary, regs binary, keys array<long>"))
        buckets = self.candidates(made.where("n > 0 AND id IS NOT NULL"))
        tied = self.to_hubs(buckets)
        likely = self.judged(tied.where("member <> hub").select(F.least("member", "hub").alias("a"), F.greatest("member", "hub").alias("b")).distinct())
        links = self.verified(likely, self.sets(likely.select(F.explode(F.array("a", "b")).alias("need")).distinct()))
        comp = s.save(components(links, s))
        more = self.rest(tied, comp)
        if more is not None and not more.isEmpty():
            comp = s.save(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), s))
        nodes = self.reps.select(F.col("digest").alias("d2"), "node")
        nodes = s.save(nodes.join(small(comp.select(F.col("node").alias("c"), "component"), comp), F.col("node") == F.col("c"), "left")
                       .select("d2", F.coalesce("component", "node").alias("component")))
        out = merged(made.select("id", "n", "digest"), nodes, F.col("digest") == F.col("d2"), "left")
        component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
        return out.select("id", "n", component.alias("component"))


def mark_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, threshold: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept. threshold is in hundredths of Jaccard similarity."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = _Run(docs, k, threshold).solve()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows that stay, one of each component, with all their columns. Only texts that may go shuffle."""
    scratch = Scratch(df.sparkSession, "setsketch")
    marks = mark_near(df, id_col, text_col, k, threshold)
    several = scratch.save(marks.where(F.col("component_id").isNotNull()).groupBy("component_id", id_col).count()
                           .where((F.col(id_col) != F.col("component_id")) | (F.col("count") > 1)).select(F.col(id_col).alias("gone"), (F.col(id_col) == F.col("component_id")).alias("stays")))
    blocks = blocks_for(several.count())
    bits = scratch.save(present(several, F.col("gone"), blocks))
    rows = ask(df.select(F.col(id_col).cast("long").alias("id"), whole_row().alias("row")), F.col("id"), bits, blocks, "perhaps")
    alone = rows.where("NOT perhaps").select("row")
    some = merged(rows.where("perhaps"), several, F.col("id") == F.col("gone"), "left")
    once = some.where("stays").groupBy("id").agg(F.first("row").alias("row")).select("row")
    return unpack(alone.unionByName(some.where("stays IS NULL").select("row")).unionByName(once))
