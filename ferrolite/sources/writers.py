"""Sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F


def write_csv(df: DataFrame, path: str, id_col: str | None = None) -> None:
    """A folder of CSV parts with headers; the id column comes first."""
    cols = df.columns if id_col is None else [id_col, *[c for c in df.columns if c != id_col]]
    df.select(*cols).write.mode("overwrite").csv(path, header=True)


def write_delimited(df: DataFrame, path: str, sep: str = "||", header: str | None = None, line_breaks: str = "refuse") -> None:
    """Lines joined by a literal separator, each file led by the header line if one is given.

    Line breaks inside fields raise an error, or become spaces with line_breaks="space".
    """
    if line_breaks not in ("refuse", "space"):
        raise ValueError("line_breaks is refuse or space")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    if line_breaks == "space":
        fields = [F.regexp_replace(f, "[\\r\\n]+", " ") for f in fields]
    line = F.concat_ws(sep, *fields)
    checked = F.when(line.rlike("[\\r\\n]"), F.raise_error(F.lit("a field holds a line break"))).otherwise(line)
    df.select(checked.alias(header or "value")).write.mode("overwrite").csv(
        path, sep="\u0001", quote="\u0000", escape="\u0000", emptyValue="", header=header is not None, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    df.select(F.col(label).alias("label"), F.col(features).alias("features")).write.mode("overwrite").format("libsvm").save(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
