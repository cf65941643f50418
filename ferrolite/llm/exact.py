"""Exact dedup: two-pass Bloom filtering, by DataFrame functions only.

The first pass writes each row's id and SHA-256 and sets Bloom bits; bits set twice mark the hashes that may repeat.
In the second pass only rows whose bits are all marked shuffle by hash and are grouped exactly. The rest pass
straight through as groups of one.

Texts are equal when they are identical; null counts as empty. Of equal texts the row with the largest id stays
(null is the smallest id). Rows that repeat both id and text are each reported as kept by `mark_copies`;
`drop_copies` leaves one of them. An empty table gives an empty result. Further columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import Scratch, merged, text_of, unpack, whole_row


def _groups(slim: DataFrame, scratch: Scratch, max_filter_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """Table of groups of two rows and more, and the filter that finds their rows."""
    blocks = bloom.blocks_for(slim.count(), max_filter_bytes)
    bits = scratch.save(bloom.repeated(slim, F.col("sha"), blocks))
    perhaps = bloom.ask(slim, F.col("sha"), bits, blocks, "perhaps").where("perhaps")
    groups = perhaps.groupBy("sha").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return scratch.save(groups.withColumnRenamed("sha", "g_sha")), bits, blocks


def _decide(rows: DataFrame, groups: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """rows: sha, id and whatever is to be carried. Adds keep, n and kept."""
    asked = bloom.ask(rows, F.col("sha"), bits, blocks, "perhaps")
    alone = asked.where("NOT perhaps").withColumns({"keep": F.col("id"), "n": F.lit(1).cast("long")})
    some = merged(asked.where("perhaps"), groups, asked["sha"] == groups["g_sha"], "left")
    some = some.withColumns({"keep": F.when(F.col("g_sha").isNull(), F.col("id")).otherwise(F.col("keep")),
                             "n": F.coalesce("n", F.lit(1).cast("long"))}).drop("g_sha")
    both = alone.unionByName(some)
    return both.withColumn("kept", F.col("id").eqNullSafe(F.col("keep"))).drop("perhaps")


def _slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("sha"))


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(df.sparkSession, "exact")
    slim = scratch.save(_slim(df, id_col, text_col))
    out = _decide(slim, *_groups(slim, scratch, max_filter_bytes))
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), "kept",
                      F.col("sha").alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """The rows that stay, with all their columns. Texts that may repeat shuffle, the others do not."""
    scratch = Scratch(df.sparkSession, "exact")
    slim = scratch.save(_slim(df, id_col, text_col))
    groups, bits, blocks = _groups(slim, scratch, max_filter_bytes)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("sha"), whole_row().alias("row"))
    kept = _decide(rows, groups, bits, blocks).where("kept")
    single = kept.where("n = 1").select("row")
    several = kept.where("n > 1").groupBy("sha", "id").agg(F.first("row").alias("row")).select("row")
    return unpack(single.unionByName(several))
