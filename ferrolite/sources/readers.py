"""Sources: thin, typed calls on Spark's readers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


NO_CHAR = "\u0001"  # a separator that lines do not hold, so that the reader gives whole lines


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = False, infer: bool = False, **options) -> DataFrame:
    """A declared schema reads once; inference reads the data an extra time."""
    if (schema is None) == (not infer):
        raise ValueError("give a schema or ask for inference, not both")
    reader = spark.read.options(header=header, **options)
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path, inferSchema=True)


def read_delimited(spark: SparkSession, path: str, names, sep: str = "||", skip_header: bool = True) -> DataFrame:
    """Lines cut at a literal multi-character separator; the last field keeps any further separators.

    skip_header leaves out the first line of every file, whatever it says; the names are the caller's. Blank lines are no rows.
    """
    names = list(names)
    lines = spark.read.schema("value string").csv(path, sep=NO_CHAR, quote="", escape="", header=skip_header, enforceSchema=True).where("value IS NOT NULL")
    cut = F.split(F.col("value"), "\\Q" + sep + "\\E", len(names))
    return lines.select(*[F.get(cut, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_tsv(spark: SparkSession, path: str, n_features: int, label: str = "label") -> DataFrame:
    """Headerless tab file of numbers; column 0 is the label."""
    schema = ", ".join([f"{label} double", *[f"f{i} double" for i in range(n_features)]])
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", str(n_features)) if n_features else reader).load(path)


def read_images(spark: SparkSession, path: str, decode: bool = True) -> DataFrame:
    """Decoded image structs (origin, height, width, channels, mode, data), or the files as binary rows."""
    if decode:
        return spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    return spark.read.format("binaryFile").load(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """In-memory rows with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
