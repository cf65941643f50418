"""Registry of named queries with, where SQL can say it, an independent SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


class Tables:
    """`t.orders` reads orders.parquet; nothing is read before it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def configure(spark: SparkSession) -> None:
    """Runtime settings the queries rely on: UTC, adaptive plans, and hot join keys split even below an aggregation."""
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
                       "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}.items():
        spark.conf.set(key, value)


@dataclass(frozen=True)
class Entry:
    name: str
    items: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, *items: str, sql: str | None = None):
    """Register fn(t: Tables) under a name with the inventory items it covers."""

    def add(fn):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(name, items, lambda spark, d: fn(Tables(spark, d)), sql)
        return fn

    return add
