"""Substring dedup by seed and extend.

Words are runs of bytes other than the space and U+0009 to U+000D, unchanged. Seeds are winnowed anchors: of the
hashes of `ANCHOR` words in a row, the least in each stretch that a window of `window` words holds, so equal windows
have an anchor in common wherever they stand. Anchors that several texts hold are the joins between documents. Around each such
anchor the match is extended both ways, word by word, to every window that contains it; a window is a repeat if it also
starts in a document with a smaller id. Neighbouring repeats run together into the maximal repeat, and all its words go.
Windows are judged on the input texts.

Windows of one content meet by hash with partial aggregation, never pair by pair, so a passage in a third of all
documents costs a row an occurrence. Equal texts are one class: the smallest id speaks for it, the others' windows all repeat.
The filter of repeated anchors has a bounded size; if it overflows, more windows than needed are looked at, with the same result.
Windows are compared by 64-bit hashes.

Null texts count as empty and nothing is removed from them or from texts shorter than a window. Null ids rank after all
others. Rows that repeat an id do not repeat each other; they are told apart by their texts' hashes (60 bits of SHA-256, the whole of it for copies). Extra columns are not looked at.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bloom import BLOCK_BITS, ask, blocks_for, present
from .common import Scratch, merged
from .words import shingles, word_hashes

ANCHOR = 5
FILTER_BYTES = 64 << 20
NO_ID = (1 << 63) - 1


def winnow(grams: np.ndarray, stretch: int) -> np.ndarray:
    """Positions of the least hash in each stretch of consecutive grams, the last of equals; the same for equal contents."""
    if len(grams) < stretch:
        return np.empty(0, np.int64)
    seen = np.lib.stride_tricks.sliding_window_view(grams[::-1], stretch)
    out = []
    for i in range(0, len(seen), 1 << 16):
        out.append(len(grams) - 1 - (np.arange(i, i + len(seen[i : i + (1 << 16)])) + seen[i : i + (1 << 16)].argmin(axis=1)))
    return np.unique(np.concatenate(out))


def _anchors(window: int):
    """Task function: a text's anchor hashes."""

    def rows(batches):
        for b in batches:
            ids = b.column("id").to_numpy()
            for i, h, at in word_hashes(b.column("text").cast(pa.string())):
                found = []
                for k in range(len(at) - 1):
                    grams = shingles(h[at[k] : at[k + 1]], ANCHOR) if at[k + 1] - at[k] >= window else h[:0]
                    found.append(np.unique(grams[winnow(grams, window - ANCHOR + 1)]))
                sizes = [len(x) for x in found]
                if sum(sizes):
                    yield pa.record_batch({"id": np.repeat(ids[i : i + len(sizes)], sizes), "anchor": np.concatenate(found).view(np.int64)})

    return rows


def _windows(window: int, shared, width: int):
    """Task function: (id, tag, place, key) of every window around an anchor that the filter knows. place is the first word."""

    def rows(batches):
        bits = [np.frombuffer(x, np.uint8) for x in shared.value]

        def known(x):
            hit = np.ones(len(x), bool)
            for half, slot in zip(bits, ((x >> np.uint64(32)) % np.uint64(width), (x & np.uint64(0xFFFFFFFF)) % np.uint64(width))):
                hit &= (half[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return hit

        for b in batches:
            ids, tags = b.column("id").to_numpy(), b.column("tag").to_numpy()
            for i, h, at in word_hashes(b.column("text").cast(pa.string())):
                places, keys, sizes = [], [], []
                for k in range(len(at) - 1):
                    words = h[at[k] : at[k + 1]]
                    if len(words) >= window:
                        grams = shingles(words, ANCHOR)
                        a = winnow(grams, window - ANCHOR + 1)
                        a = a[known(grams[a])]
                        mark = np.zeros(len(words) + 1, np.int32)  # an anchor at word a is in the windows from a + ANCHOR - window to a
                        np.add.at(mark, np.maximum(a + ANCHOR - window, 0), 1)
                        np.add.at(mark, np.minimum(a, len(words) - window) + 1, -1)
                        p = np.flatnonzero(np.cumsum(mark)[: len(words) - window + 1])
                    else:
                        p = np.empty(0, np.int64)
                    sizes.append(len(p))
                    if len(p):
                        places.append(p)
                        keys.append(shingles(words, window)[p])
                if places:
                    yield pa.record_batch({"id": np.repeat(ids[i : i + len(sizes)], sizes), "tag": np.repeat(tags[i : i + len(sizes)], sizes), "place": np.concatenate(places), "key": np.concatenate(keys).view(np.int64)})

    return rows


def covered(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Boolean per word: is it in one of the windows?"""
    mark = np.zeros(n_words + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, np.minimum(starts + window, n_words), -1)
    return np.cumsum(mark)[:n_words] > 0


def _cut(window: int):
    """Task function: the text without its repeats. starts is null where nothing goes; copy is true where every window does."""

    def rows(batches):
        for b in batches:
            out = []
            for text, starts, copy in zip(b.column("text"), b.column("starts"), b.column("copy").to_pylist()):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n = len(words)
                if copy and n >= window:
                    kept, gone = [], [(0, n)]
                elif starts.is_valid and n:
                    go = covered(np.unique(starts.values.to_numpy()), n, window)
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], go, [False])).astype(np.int8)))
                    kept, gone = [w for w, g in zip(words, go) if not g], list(zip(edge[::2].tolist(), edge[1::2].tolist()))
                else:
                    kept, gone = words, []
                out.append((n, n - len(kept), b" ".join(kept), gone))
            rest = [c for c in b.schema.names if c not in ("text", "starts", "copy")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in rest] + [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2].decode("utf-8", "replace") for r in out], pa.string()), pa.array([sha256(r[2]).hexdigest() for r in out], pa.string()),
                 pa.array([[x for g in r[3] for x in g] for r in out], pa.list_(pa.int64()))],
                names=[*rest, "n_words", "n_removed", "kept_text", "kept_sha256", "repeats"])

    return rows


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text (on request), kept_sha256 and repeats (first word and end of each maximal repeat, in turn)."""
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")
    scratch, sc = Scratch(df.sparkSession, "repeats"), df.sparkSession.sparkContext
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), body.alias("text"),
                     F.sha2(body.cast("binary"), 256).alias("sha"))
    # Equal texts: which rows are not the first of their class.
    slim = scratch.save(docs.select("id", "sha"))
    blocks = blocks_for(slim.count())
    # Only rows that may share their id need a tag to tell them apart; the others' zeros cost nothing in shuffles.
    several = scratch.save(slim.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))
    id_blocks = blocks_for(several.count())
    docs = ask(docs, F.col("id"), scratch.save(present(several, F.col("id"), id_blocks)), id_blocks, "perhaps_several")
    docs = docs.withColumn("tag", F.when(F.col("perhaps_several"), F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))).drop("perhaps_several")
    classes = scratch.save(slim.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").withColumnRenamed("sha", "c_sha"))
    copies = scratch.save(merged(slim, classes, F.col("sha") == F.col("c_sha"), "inner").where("id > first").drop("c_sha").select(F.col("id").alias("c_id"), F.col("sha").alias("c_sha")).distinct())
    copy_bits = scratch.save(present(copies, F.col("c_id"), blocks))
    asked = ask(docs, F.col("id"), copy_bits, blocks, "perhaps_copy")
    same = (F.col("id") == F.col("c_id")) & (F.col("sha") == F.col("c_sha"))
    some = merged(asked.where("perhaps_copy"), copies, same, "left")
    marked = (asked.where("NOT perhaps_copy").withColumn("copy", F.lit(False)).drop("perhaps_copy")
              .unionByName(some.withColumn("copy", F.col("c_id").isNotNull()).drop("perhaps_copy", "c_id", "c_sha")))
    firsts = marked.where("NOT copy")

    # Seeds: anchors of two documents and more, as a filter.
    anchors = firsts.select("id", "text").mapInArrow(_anchors(window), "id long, anchor long")
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    shared = scratch.save(shared.select("anchor"))
    size = blocks_for(shared.count(), FILTER_BYTES)
    width = size * BLOCK_BITS
    slots = [F.pmod(F.shiftrightunsigned("anchor", 32), F.lit(width)), F.pmod(F.col("anchor").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(width)) + width]
    slot = shared.select(F.explode(F.array(*slots)).alias("slot"))
    found = slot.groupBy(F.floor(F.col("slot") / BLOCK_BITS).cast("long").alias("block")).agg(F.bitmap_construct_agg(F.pmod("slot", F.lit(BLOCK_BITS))).alias("bits")).collect()
    halves = [bytearray(size * BLOCK_BITS // 8) for _ in range(2)]
    for r in found:  # at most FILTER_BYTES
        half, at = divmod(r["block"], size)
        halves[half][at * BLOCK_BITS // 8 : (at + 1) * BLOCK_BITS // 8] = r["bits"]
    filter_ = sc.broadcast([bytes(x) for x in halves])

    # Extension: windows around seeds, and the smallest id that holds each.
    windows = scratch.save(firsts.select("id", "tag", "text").mapInArrow(_windows(window, filter_, width), "id long, tag long, place long, key long"))
    first = windows.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select(F.col("key").alias("k2"), "first")
    first = scratch.save(first)
    gone = merged(windows, first, F.col("key") == F.col("k2"), "inner").where("id > first")
    spans = gone.groupBy(F.col("id").alias("s_id"), F.col("tag").alias("s_tag")).agg(F.collect_list("place").alias("starts"))
    spans = scratch.save(spans)
    scratch.drop(windows, first, shared)

    # The cut: only texts that may hold a repeat shuffle.
    blocks = blocks_for(spans.count())
    bits = scratch.save(present(spans, F.col("s_id"), blocks))
    asked = ask(marked, F.col("id"), bits, blocks, "perhaps")
    alone = asked.where("copy OR NOT perhaps").withColumn("starts", F.lit(None).cast("array<long>"))
    some = merged(asked.where("NOT copy AND perhaps"), spans, (F.col("id") == F.col("s_id")) & (F.col("tag") == F.col("s_tag")), "left")
    ready = alone.select("own", "text", "starts", "copy").unionByName(some.select("own", "text", "starts", "copy"))
    out = ready.mapInArrow(_cut(window), "own long, n_words long, n_removed long, kept_text string, kept_sha256 string, repeats array<long>")
    return out.withColumnRenamed("own", id_col) if text else out.drop("kept_text").withColumnRenamed("own", id_col)
