"""Projection, filtering, conversion and nested-data reshaping."""

from __future__ import annotations

import importlib
import uuid

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import portable_hash
from ..functions.cols import as_list, r, require, same_keys
from .levels import decode_levels, encode_levels, level_table


def select_columns(df: DataFrame, cols) -> DataFrame:
    require(df, *as_list(cols))
    return df.select(*as_list(cols))


def drop_columns(df: DataFrame, cols) -> DataFrame:
    require(df, *as_list(cols))
    return df.drop(*as_list(cols))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    require(df, old)
    return df.withColumnRenamed(old, new)


def add_constant(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.lit(value))


def where(df: DataFrame, predicate) -> DataFrame:
    return df.where(predicate)


def where_any(df: DataFrame, members: dict[str, list]) -> DataFrame:
    """Rows for which at least one column is in its set."""
    cond = F.lit(False)
    for c, values in members.items():
        cond = cond | F.col(c).isin(list(values))
    return df.where(cond)


def binarize_label(df: DataFrame, col: str, out: str, contains: str | None = None, above=None,
                   equals=None) -> DataFrame:
    """0/1 label from a substring, a threshold or a value."""
    c = F.col(col)
    if contains is not None:
        rule = c.contains(contains)
    elif above is not None:
        rule = c > F.lit(above)
    else:
        rule = c == F.lit(equals)
    return df.withColumn(out, rule.cast("int"))


CONVERT_TARGETS = ("boolean", "byte", "short", "integer", "long", "float", "double", "string", "date", "timestamp")


def convert(df: DataFrame, cols, to: str, fmt: str | None = None) -> DataFrame:
    """Convert several columns to one type; values that do not parse become null."""
    if to not in CONVERT_TARGETS:
        raise ValueError(f"unknown conversion target {to!r}")
    out = {}
    for c in as_list(cols):
        if to in ("date", "timestamp") and fmt:
            parsed = F.try_to_timestamp(F.col(c), F.lit(fmt))
            out[c] = parsed.cast("date") if to == "date" else parsed.cast("timestamp_ntz")
        elif to == "string" and fmt:
            out[c] = F.date_format(F.col(c), fmt)
        else:
            out[c] = F.col(c).try_cast(to)
    return df.withColumns(out)


def to_categorical(df: DataFrame, cols, order: str = "frequency") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace columns by level codes; returns the frame and one level table per column."""
    tables = {c: level_table(df, c, order) for c in as_list(cols)}
    for c, levels in tables.items():
        df = encode_levels(df, c, levels, c)
    return df, tables


def clear_categorical(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    for c, levels in tables.items():
        df = decode_levels(df, c, levels, c)
    return df


def sql_stage(statement: str) -> SQLTransformer:
    """A SQL statement over __THIS__ as a pipeline stage."""
    return SQLTransformer(statement=statement)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def predictions_by(df: DataFrame, groups, prediction: str) -> DataFrame:
    """Registered predictions summed up per group with SQL."""
    keys, view = ", ".join(as_list(groups)), f"scored_{uuid.uuid4().hex}"
    register(df, view)
    try:  # the plan holds the view's own plan, so the name can go at once
        return df.sparkSession.sql(f"SELECT {keys}, count(*) AS n, round(avg({prediction}), 6) AS mean_prediction FROM {view} GROUP BY {keys}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


class ColumnStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A user function as a pipeline stage.

    `function` is SQL text in which __IN__ stands for the input column, or `module:name` of a function Column -> Column (a pandas_udf fits as
    well) that can be imported; either is saved with the stage. Any other callable works too, but such a stage refuses to be saved.
    """

    function = Param(Params._dummy(), "function", "SQL text over __IN__, or module:name", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, function=None, fn=None):
        super().__init__()
        self.fn = fn
        if fn is not None and function is None:
            name = f"{getattr(fn, '__module__', None)}:{getattr(fn, '__qualname__', None) or getattr(fn, '__name__', None)}"
            function = name if _imported(name) is fn else None
        self._set(**{k: v for k, v in {"inputCol": inputCol, "outputCol": outputCol, "function": function}.items() if v is not None})

    def write(self):
        if not self.isDefined(self.function):
            raise ValueError("only SQL text or a function that can be imported by name can be saved")
        return super().write()

    def _transform(self, df: DataFrame) -> DataFrame:
        column = F.col(self.getInputCol())
        text = self.getOrDefault(self.function) if self.isDefined(self.function) else None
        fn = self.fn or _imported(text)
        made = fn(column) if fn is not None else F.expr(text.replace("__IN__", "`" + self.getInputCol().replace("`", "``") + "`"))
        return df.withColumn(self.getOutputCol(), made)


def _imported(name: str | None):
    """The object that `module:name` stands for; None if it is none."""
    module, colon, path = (name or "").partition(":")
    if not colon or not all(p.isidentifier() for p in [*module.split("."), *path.split(".")]):
        return None
    try:
        found = importlib.import_module(module)
        for part in path.split("."):
            found = getattr(found, part)
    except (ImportError, AttributeError):
        return None
    return found


def udf_stage(in_col: str, out_col: str, fn) -> ColumnStage:
    """`fn`: SQL text over __IN__, `module:name`, or a function."""
    return ColumnStage(inputCol=in_col, outputCol=out_col, **({"function": fn} if isinstance(fn, str) else {"fn": fn}))


def pick_probability(df: DataFrame, i: int, vec: str = "probability", out: str = "p") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(vec))[i])


def residual(df: DataFrame, label: str, pred: str, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(label) - F.col(pred))


def mean_of(df: DataFrame, col: str) -> DataFrame:
    return df.agg(r(F.avg(col)).alias(f"mean_{col}"))


def argmax(df: DataFrame, array_col: str, out: str = "argmax") -> DataFrame:
    """0-based index of the first largest element."""
    return df.withColumn(out, F.array_position(array_col, F.array_max(array_col)) - 1)


def drop_na(df: DataFrame, cols=None) -> DataFrame:
    return df.dropna(subset=as_list(cols) or None)


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Replace categories by given values; an unknown category becomes null."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out or col, F.try_element_at(pairs, F.col(col)))


def split_to_array(df: DataFrame, col: str, sep: str, out: str | None = None) -> DataFrame:
    """Literal separator, not a pattern."""
    return df.withColumn(out or col, F.split(F.col(col), "\\Q" + sep + "\\E"))


def expand_struct(df: DataFrame, col: str, drop=()) -> DataFrame:
    """Lift the struct's fields; drop the struct and any error columns."""
    return df.select("*", f"{col}.*").drop(col, *as_list(drop))


def flatten_results(df: DataFrame, array_col: str, field: str, out: str) -> DataFrame:
    """One row per array element, keeping one field of it."""
    return df.withColumn("__e", F.explode(array_col)).withColumn(out, F.col("__e")[field]).drop("__e", array_col)


def first_of(df: DataFrame, array_col: str, field: str, out: str) -> DataFrame:
    """Field of the first element; null where the array is null or empty."""
    return df.withColumn(out, F.try_element_at(array_col, F.lit(1))[field])


def join_lines(df: DataFrame, array_col: str, field: str, out: str, sep: str = "\n") -> DataFrame:
    return df.withColumn(out, F.concat_ws(sep, F.transform(array_col, lambda e: e[field])))


def to_json_request(df: DataFrame, cols, out: str = "request") -> DataFrame:
    return df.withColumn(out, F.to_json(F.struct(*as_list(cols))))


def parse_json_response(df: DataFrame, col: str, schema: str, out: str = "response",
                        error: str = "error") -> DataFrame:
    """Typed struct from JSON; text that does not parse goes to the error column."""
    parsed = F.from_json(F.col(col), f"{schema}, _corrupt_record STRING", {"columnNameOfCorruptRecord": "_corrupt_record"})
    fields = [part.split()[0] for part in schema.split(",")]
    df = df.withColumn("__p", parsed)
    return (df.withColumn(out, F.struct(*[F.col("__p")[f].alias(f) for f in fields]))
            .withColumn(error, F.col("__p._corrupt_record")).drop("__p"))


def page_offsets(queries: DataFrame, pages: int, size: int) -> DataFrame:
    """Every query with every page offset; the offsets are a bounded literal sequence."""
    return queries.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit((pages - 1) * size), F.lit(size))))


def dict_features(df: DataFrame, map_col: str, n: int, out: str = "features") -> DataFrame:
    """Map entries as hashed features: a number adds to its name's slot, a text value counts 1 in the slot of `name=value`; null values count nothing."""
    def slot(e):
        value = e["value"].cast("string")
        number = value.try_cast("double")
        term = F.when(number.isNull(), F.concat_ws("=", e["key"], value)).otherwise(e["key"])
        return F.struct(F.pmod(portable_hash(0, term), F.lit(n)).alias("slot"), F.coalesce(number, F.lit(1.0)).alias("x"))

    slots = F.transform(F.filter(F.map_entries(map_col), lambda e: e["value"].isNotNull()), slot)
    dense = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(
        F.filter("__slots", lambda s: s["slot"] == i), F.lit(0.0), lambda acc, s: acc + s["x"]))
    return df.withColumn("__slots", F.coalesce(slots, F.array())).withColumn(out, array_to_vector(dense)).drop("__slots")


def dict_columns(df: DataFrame, map_col: str, names) -> DataFrame:
    """Named map keys as columns, 0 where a row lacks the key."""
    return df.select("*", *[F.coalesce(F.try_element_at(map_col, F.lit(k)).cast("double"), F.lit(0.0)).alias(k)
                            for k in as_list(names)]).drop(map_col)


def align_columns(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the columns both frames have, in the first frame's order."""
    shared = [c for c in train.columns if c in test.columns]
    return train.select(*shared), test.select(*shared)
