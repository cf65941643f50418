"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.store import work_dir


def small_batches(spark: SparkSession) -> None:
    """Bounds on what a Python worker is handed at once, as texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def held(owner: str) -> dict:
    """What a Python worker keeps between tasks, for one owner at a time.

    Workers are reused, and task functions travel by value, so a module's globals are made anew in each task; another owner's tables go.
    """
    import sys
    import types

    box = sys.modules.setdefault("_worker_tables", types.ModuleType("_worker_tables")).__dict__
    if box.get("owner") != owner:
        box.update(owner=owner, tables={})
    return box["tables"]


class Scratch:
    """Tables of one run in the shared folder: computed once, reread by any executor, small ones dropped early."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark, self.base, self.count = spark, work_dir(spark, name), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:04d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out._bytes = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this run that nothing reads any more."""
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_of(name: str) -> Column:
    """A text column as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_row() -> Column:
    """Every input column in one struct, so that columns of any name cannot clash with an operator's own."""
    return F.struct("*")


def unpack(df: DataFrame, row: str = "row") -> DataFrame:
    return df.select(f"{row}.*")


def order_hash(*cols, seed: int = 7) -> Column:
    """Deterministic pseudo-random order of rows."""
    return F.xxhash64(F.lit(seed), *cols)


SMALL_BYTES = 4 << 20


def small(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Mark a saved table (or columns of it) for broadcast if its files are known to be small; else leave it to a shuffled join."""
    return F.broadcast(df) if getattr(table or df, "_bytes", SMALL_BYTES + 1) <= SMALL_BYTES else df


def merged(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """An equi-join whose right side is broadcast only if it is a saved table of checked size; else Spark decides by measured sizes and splits hot keys."""
    return left.join(small(right), on, how)
