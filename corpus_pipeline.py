"""The training-data pipeline: five stages over `documents`, each written as Parquet and reread as the next one's input.

toxicity       documents that the classifier rejects go
exact dedup    of equal texts the row with the largest doc_id stays
near dedup     of each group of near copies (five-word shingles, Jaccard similarity 0.8 and more) one row stays
mix            all rows, laid out in the order in which sources meet their target weights
encode         each text's byte-pair ids, with the bytes they decode to checked against the text, and its place in the mix; rows in that order
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferrolite.llm import bpe, exact, pfair, setsketch, toxicity
from ferrolite.llm.common import Scratch
from ferrolite.llm.queries import WEIGHTS
from ferrolite.plans.registry import configure

#: A learnt classifier and the tokenizer cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return setsketch.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return pfair.mix(docs, WEIGHTS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, text_sha256, round_trip (the ids decode to the text's bytes) and position (the row's place in the mix, from 0).

    Rereading a table with several part files gives no order, so places are worked out again, and rows are laid out by them."""
    import public_tokenizers as vocabularies

    configure(spark)
    ranks = vocabularies.path("byte_bpe_50k.tiktoken")
    placed = pfair.schedule(docs.select("doc_id", "source", "text"), WEIGHTS).select("position", "row.*")
    placed = placed.repartitionByRange("position").sortWithinPartitions("position")  # before the encoder, so that bounds are sampled without it
    coded = bpe.round_trip(placed.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)), ranks, vocabularies.PATTERN)
    return coded.select("doc_id", "source", "n_tokens", "ids", "text_sha256", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"), "position")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return done
        docs = scratch.save(done)
