"""Where runs may write: the shared folder the cluster names, a temporary one only in local mode."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, later branches read it back, a lost executor loses nothing."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def saved(df: DataFrame, name: str) -> DataFrame:
    """A table of one run in the shared folder: computed once, read back in its compressed form by each later branch."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
