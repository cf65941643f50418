"""Small column helpers shared by the operators."""

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def as_list(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple, set)) else [x]


def r(c: Column, digits: int = 6) -> Column:
    """Rounded double; + 0.0 turns a negative zero into zero."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require(df: DataFrame, *cols: str) -> None:
    """Schema check at an operator's boundary."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def dbl(name: str) -> Column:
    return F.col(name).cast("double")


def div(a, b) -> Column:
    """Double division; null where the divisor is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def vec_to_array(df: DataFrame, *cols: str, digits: int | None = None) -> DataFrame:
    """Vector columns as ARRAY<DOUBLE> (the public boundary has no UDTs)."""
    for c in cols:
        arr = vector_to_array(F.col(c))
        if digits is not None:
            arr = F.transform(arr, lambda x: r(x, digits))
        df = df.withColumn(c, arr)
    return df


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def same_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner", hint: bool = False) -> DataFrame:
    """Join on keys where null equals null; the right side's key columns are dropped."""
    keys = as_list(keys)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    if hint:
        renamed = F.broadcast(renamed)
    on = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach a one-row frame's columns to every row as a scalar subquery (computed once, no join)."""
    one = row.select(F.struct(*row.columns)).scalar()
    return df.withColumn("__row", one).select("*", "__row.*").drop("__row")


def skew_safe_lookup(left: DataFrame, right: DataFrame, key: str, spread_by, how: str = "inner",
                     slice_rows: int = 1 << 20) -> DataFrame:
    """Join many left rows to the one right row of their key when a key may be hot.

    Keys are counted first. A key with more than `slice_rows` left rows is spread over as many slices as that
    takes, by a hash of `spread_by`, and only its right row is copied; other keys join as they are.
    """
    heavy = left.groupBy(F.col(key).alias("__hot")).agg(F.ceil(F.count(F.lit(1)) / slice_rows).alias("__slices")).where("__slices > 1")
    slices = F.coalesce("__slices", F.lit(1))
    salted = left.join(heavy, F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.pmod(F.xxhash64(*as_list(spread_by)), slices)).drop("__hot", "__slices")
    copies = right.join(heavy, F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))).drop("__hot", "__slices")
    return salted.join(copies, [key, "__salt"], how).drop("__salt")
