"""Trie of conversation prefixes by ROLLUP over positional turn ids.

A turn's id is a digest of its role and text, with the number of words of the text behind it. A conversation is laid out in blocks of
`BLOCK` turn-id columns; `GROUP BY block, node before it, ROLLUP (t0, t1, ...)` aggregates all prefixes together, and grouping_id tells how
many turns of the block a group has. Longer conversations go on in further blocks, which are rows of the same job, keyed by the node that
the earlier blocks reach. That key is an exclusive-or of hashes of (place, turn id) in two seeds, so it is carried over any number of blocks by windows
of bounded length, and no conversation is gathered whole.

Values of subtrees need no walk over the trie. A node is charged to its smallest member; the nodes charged to a conversation are those from
some depth of its path on. So each subtree sum is a sum over the node's members: of their words from there on, less the words of the nodes
that are charged to members (`own`), and so are its leaves and children. Two rollups over the same rows give everything.

`rebuild` makes conversations share turns: conversation c starts with the first h turns of c - c % `GROUP`, h being crc32(decimal c) % 4, and
goes on with its own turns after its first h. Turns are ordered by number, null first, repeated numbers by their ids. Null roles and texts count as empty. Rows
without a conversation id belong to no conversation and are left out; an empty table has no nodes. Other columns are not read. Word: a run of characters
other than the space and U+0009 to U+000D.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.cols import skew_safe_lookup
from ..functions.ordered import number_rows
from .common import Scratch, merged, text_of

BLOCK = 8
GROUP, HEADS = 20, 4
SPAN = 1 << 12  # blocks of one window
SLICE = 1 << 14
RUN = 1 << 16  # ids of one piece of a list of members
T_COLS = [f"t{i}" for i in range(BLOCK)]


def turn_id(role: Column, text: Column) -> Column:
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return F.concat(digest, F.unhex(F.lpad(F.hex(words), 16, "0")))


def words_of(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 8)), 16, 10).cast("long")


def marks(place: Column, turn: Column) -> list[Column]:
    """Two hashes of a turn at its place; those of a prefix are their exclusive-ors."""
    return [F.xxhash64(F.lit(seed), place.cast("long"), turn) for seed in (11, 23)]


def ordered_turns(df: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos from 0, len, id) of all turns."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), turn_id(text_of(role_col), text_of(text_col)).alias("id")).where("conv IS NOT NULL")
    return scratch.save(number_rows(scratch.save(rows), ["turn", "id"], "conv", total="len").select("conv", "pos", "len", "id"))


def rebuild(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, pos, len, id) and the conversations left without any (conv)."""
    shared = lambda c: F.crc32(c.cast("string").cast("binary")) % HEADS
    heads = turns.where((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("head"))
    plan = turns.where("pos = 0").select("conv", F.col("len").alias("had"), shared(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    plan = merged(plan, scratch.save(heads), "base", "left")
    plan = plan.withColumn("head", F.slice(F.coalesce("head.id", F.array().cast("array<binary>")), F.lit(1), F.col("h").cast("int")))
    plan = scratch.save(plan.select("conv", "h", "head", (F.size("head") + F.greatest(F.col("had") - F.col("h"), F.lit(0))).cast("long").alias("len")))
    shift = plan.select("conv", "h", F.size("head").alias("k"), F.col("len").alias("total"))
    own = turns.where(F.col("pos") >= shared(F.col("conv"))).select("conv", "pos", "id")
    own = skew_safe_lookup(own, shift, "conv", "pos", slice_rows=SLICE).select("conv", (F.col("pos") - F.col("h") + F.col("k")).cast("long").alias("pos"), F.col("total").alias("len"), "id")
    first = plan.select("conv", "len", F.posexplode("head").alias("pos", "id")).select("conv", F.col("pos").cast("long").alias("pos"), "len", "id")
    return own.unionByName(first), plan.where("len = 0").select("conv")


def _blocks(turns: DataFrame, empty: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, block, len, k1, k2, e1, e2, left, t0..): the node before a block, the node after it, and the words from the block on."""
    m1, m2 = marks(F.col("pos"), F.col("id"))
    one = turns.groupBy("conv", F.floor(F.col("pos") / BLOCK).cast("long").alias("block")).agg(
        F.max("len").alias("len"), F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("held"), F.bit_xor(m1).alias("x1"), F.bit_xor(m2).alias("x2"), F.sum(words_of(F.col("id"))).alias("words"))
    one = one.select("conv", "block", "len", "x1", "x2", "words", F.floor(F.col("block") / SPAN).cast("long").alias("span"), *[F.get("held.id", F.lit(i)).alias(t) for i, t in enumerate(T_COLS)])
    one = scratch.save(one)
    inside = Window.partitionBy("conv", "span").orderBy("block")
    before, rest = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(0, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    one = one.withColumns({"k1": F.coalesce(F.bit_xor("x1").over(before), zero), "k2": F.coalesce(F.bit_xor("x2").over(before), zero), "left": F.sum("words").over(rest)})
    spans = one.where(F.col("len") > SPAN * BLOCK).groupBy("conv", "span").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"), F.sum("words").alias("y"))
    over = Window.partitionBy("conv").orderBy("span")
    earlier, later = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing)
    spans = scratch.save(spans.select("conv", "span", F.coalesce(F.bit_xor("y1").over(earlier), zero).alias("s1"), F.coalesce(F.bit_xor("y2").over(earlier), zero).alias("s2"),
                                      F.coalesce(F.sum("y").over(later), zero).alias("s")))
    one = merged(one, spans, ["conv", "span"], "left").withColumns(
        {"k1": F.col("k1").bitwiseXOR(F.coalesce("s1", zero)), "k2": F.col("k2").bitwiseXOR(F.coalesce("s2", zero)), "left": F.col("left") + F.coalesce("s", zero)})
    one = one.select("conv", "block", "len", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("e1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("e2"), "left", *T_COLS)
    none = empty.select("conv", *[zero.alias(c) for c in ("block", "len", "k1", "k2", "e1", "e2", "left")], *[F.lit(None).cast("binary").alias(t) for t in T_COLS])
    return scratch.save(one.unionByName(none))


def _rollup(blocks: DataFrame, more: str = "") -> DataFrame:
    """All prefixes: conv (smallest member), depth, n, last (the turn's words), h1, h2, p1, p2 (the node, its parent), tail and far (words from the node's turn on: all members', the
    smallest member's), longest, goes_on (has the smallest member a further turn), and `more` aggregates."""
    rows = blocks.sparkSession.sql(f"""
        SELECT block, k1, k2, {', '.join(T_COLS)}, {BLOCK} - bit_count(grouping_id()) AS level, min(conv) AS conv, count(*) AS n, max(len) AS longest,
               sum(left) AS all_left, min_by(left, conv) AS first_left, min_by(len, conv) AS first_len {more}
        FROM {{rows}} GROUP BY block, k1, k2, ROLLUP ({', '.join(T_COLS)})""", rows=blocks)
    rows = rows.withColumn("turns", F.array(*T_COLS)).withColumn("last_turn", F.get("turns", F.col("level") - 1)).where("(level = 0 AND block = 0) OR last_turn IS NOT NULL")
    start, level = F.col("block") * BLOCK, F.col("level")

    def upto(seed: int, key: str, n: Column) -> Column:
        taken = F.slice("turns", F.lit(1), F.greatest(n, F.lit(0)))
        each = F.transform(taken, lambda t, i: marks(start + i, t)[seed])
        return F.aggregate(each, F.col(key), lambda acc, x: acc.bitwiseXOR(x))

    before = F.aggregate(F.transform(F.slice("turns", F.lit(1), F.greatest(level - 1, F.lit(0))), words_of), F.lit(0).cast("long"), lambda acc, x: acc + x)
    extra = [c for c in rows.columns if c.startswith("more_")]
    return rows.withColumn("before", before).select(
        "conv", (start + level).alias("depth"), "n", F.coalesce(words_of(F.col("last_turn")), F.lit(0).cast("long")).alias("last"), upto(0, "k1", level).alias("h1"), upto(1, "k2", level).alias("h2"),
        upto(0, "k1", level - 1).alias("p1"), upto(1, "k2", level - 1).alias("p2"), (F.col("all_left") - F.col("n") * F.col("before")).alias("tail"),
        (F.col("first_left") - F.col("before")).alias("far"), "longest", (F.col("first_len") > start + level).alias("goes_on"), "level", *extra)


def _pieces(batches):
    """Task function over rows sorted by node and member: members of a node one after another, in pieces of at most RUN."""
    key, ids = None, []

    def piece():
        return pa.RecordBatch.from_pydict({"e1": pa.array([key[0]], pa.int64()), "e2": pa.array([key[1]], pa.int64()), "len": pa.array([key[2]], pa.int64()), "first": pa.array([ids[0]], pa.int64()),
                                           "ids": pa.array([",".join(map(str, ids))])})

    for b in batches:
        for *now, conv in zip(*(b.column(c).to_pylist() for c in ("e1", "e2", "len", "conv"))):
            if ids and (now != key or len(ids) >= RUN):
                yield piece()
                ids = []
            key = now
            ids.append(conv)
    if ids:
        yield piece()


def _digests(batches):
    """Task function over pieces sorted by node and first member: the hash of each node's whole list, piece by piece."""
    key, seen, out = None, None, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 3 + [pa.string()])], names=["e1", "e2", "e_len", "ends"])

    for b in batches:
        for *now, ids in zip(*(b.column(c).to_pylist() for c in ("e1", "e2", "len", "ids"))):
            if now == key:
                seen.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, seen.hexdigest()))
            key, seen = now, hashlib.sha256(ids.encode())
        if len(out) >= 4096:
            yield batch()
            out = []
    if key is not None:
        out.append((*key, seen.hexdigest()))
    if out:
        yield batch()


def _ends(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(e1, e2, e_len, ends): for each node at which conversations end, the hash of their ids in ascending order."""
    last = blocks.where(F.col("block") == F.floor(F.greatest(F.col("len") - 1, F.lit(0)) / BLOCK)).select("e1", "e2", "len", "conv")
    pieces = scratch.save(last.repartitionByRange("e1", "e2", "len", "conv").sortWithinPartitions("e1", "e2", "len", "conv").mapInArrow(_pieces, "e1 long, e2 long, len long, first long, ids string"))
    return pieces.repartition("e1", "e2", "len").sortWithinPartitions("e1", "e2", "len", "first").mapInArrow(_digests, "e1 long, e2 long, e_len long, ends string")


def trie(turns: DataFrame, empty: DataFrame, scratch: Scratch) -> DataFrame:
    """turns: (conv, pos, len, id) with places from 0 without gaps; empty: (conv) of conversations without turns. One row per node."""
    blocks = _blocks(turns, empty, scratch)
    first = _rollup(blocks)
    own = scratch.save(first.groupBy("conv").agg(F.min("depth").alias("from_depth"), F.sum("last").alias("own"), F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"),
                                                 F.min_by("p1", "depth").alias("p1"), F.min_by("p2", "depth").alias("p2")))
    charged = skew_safe_lookup(blocks, own.drop("p1", "p2"), "conv", "block", "left", slice_rows=SLICE)
    born = "".join(f", count_if(from_depth = block * {BLOCK} + {i + 1}) AS more_born{i}" for i in range(BLOCK + 1))
    nodes = _rollup(charged, f", sum(coalesce(own, 0)) AS more_own, min_by(coalesce(own, 0), conv) AS more_first, sum(coalesce(leaf, 0)) AS more_leaves {born}")
    nodes = scratch.save(nodes)
    root = nodes.where("depth = 0").agg(F.min("conv")).first()[0]
    key = lambda a, b, c: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), c.cast("long").alias("c"))
    branches = own.where("from_depth > 1").select(F.col("conv").alias("child"), key("p1", "p2", F.col("from_depth") - 1).alias("node"))
    above = nodes.where("goes_on OR longest > depth").select(key("h1", "h2", F.col("depth")).alias("node"), F.col("conv").alias("upper"))
    uppers = skew_safe_lookup(branches, above, "node", "child", slice_rows=SLICE).select(F.col("child").alias("conv"), "upper")
    starts = own.select("conv", "from_depth").join(uppers, "conv", "left").withColumn("upper", F.coalesce("upper", F.when(F.col("from_depth") == 1, F.lit(root).cast("long"))))
    full = skew_safe_lookup(nodes, scratch.save(starts), "conv", "depth", slice_rows=SLICE)
    ends = _ends(blocks, scratch)
    full = full.join(ends, (F.col("h1") == F.col("e1")) & (F.col("h2") == F.col("e2")) & (F.col("depth") == F.col("e_len")), "left")
    born_here = F.get(F.array(*[f"more_born{i}" for i in range(BLOCK + 1)]), F.col("level"))
    return full.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == 0, None).when(F.col("depth") > F.col("from_depth"), F.col("conv")).otherwise(F.col("upper")).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), (born_here + F.col("goes_on").cast("long")).alias("n_children"), F.col("more_leaves").cast("long").alias("n_leaves"),
        (F.col("tail") - (F.col("more_own") - F.col("more_first") + F.col("far"))).alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """The trie of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return trie(*rebuild(ordered_turns(conversations, scratch), scratch), scratch)
