"""Exact ordered computations (positions, running totals, neighbours) without a one-task sort.

A global or per-group window normally sorts a whole group in one task. Here the
order is first cut into *cells*: ranges of the full sort key that hold about equally
many rows, as many as the number of rows asks for. Windows run inside one (group, cell); a small table with one row
per (group, cell) carries counts or totals over from the earlier cells. A
value that holds a large share of the rows is cut by the next sort columns, so
ties cannot make a cell hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .cols import as_list, same_keys, with_row

ROWS_PER_CELL = 1 << 20
LEAST_PER_CELL = 1 << 10
SAMPLE, PER_BOUND = 1 << 12, 16


@dataclass(frozen=True)
class Key:
    name: str
    desc: bool = False

    def sort(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.desc else c.asc_nulls_first()

    def back(self) -> Column:
        c = F.col(self.name)
        return c.asc_nulls_first() if self.desc else c.desc_nulls_last()


def keys_of(order) -> list[Key]:
    """'x' sorts up, '-x' sorts down."""
    return [k if isinstance(k, Key) else Key(k.lstrip("-"), k.startswith("-")) for k in as_list(order)]


def _falling(name: str, kind: T.DataType) -> Column | None:
    """What rises where a column falls, nulls last; none for types without such an image."""
    c = F.col(name)
    if isinstance(kind, T.IntegralType):
        return F.struct(c.isNull(), F.bitwise_not(c))
    if isinstance(kind, T.FractionalType):
        return F.struct(c.isNull(), ~F.isnan(c.cast("double")), -c)
    return F.struct(c.isNull(), F.bitwise_not(F.unix_date(c))) if isinstance(kind, T.DateType) else None


def _images(df: DataFrame, order: list[Key]) -> tuple[list[Key], list[Column]]:
    """Sort keys k0, k1, ... and their columns; where some sort up and some down, all sort up if their types allow it."""
    mixed, keys, values = len({k.desc for k in order}) > 1, [], []
    for i, k in enumerate(order):
        image = _falling(k.name, df.schema[k.name].dataType) if mixed and k.desc else None
        keys.append(Key(f"k{i}", k.desc and image is None))
        values.append((F.col(k.name) if image is None else image).alias(f"k{i}"))
    return keys, values


def _sample(df: DataFrame, order: list[Key], size: int) -> list:
    """At most `size` random rows' sort keys in order."""
    order, values = _images(df, order)
    keys = df.select(*values)
    some = keys.withColumn("draw", F.rand(7)).orderBy("draw").limit(size).drop("draw")
    return some.sortWithinPartitions(*[k.sort() for k in order]).collect()


def cells_for(n_rows: int, spark) -> int:
    """A cell for each ROWS_PER_CELL rows; small tables get fewer cells than shuffle partitions."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(tasks, -(-n_rows // LEAST_PER_CELL)), -(-n_rows // ROWS_PER_CELL), 1)


def cell_count(df: DataFrame) -> int:
    return cells_for(df.count(), df.sparkSession)


def _bounds(df: DataFrame, order: list[Key], n: int | None) -> list:
    """Sort keys that cut the rows into about equal cells. They only steer balance: any bounds give the same result."""
    n = n or cell_count(df)
    rows = _sample(df, order, max(SAMPLE, n * PER_BOUND)) if n > 1 else []
    picked = [rows[i * len(rows) // n] for i in range(1, n)] if rows else []
    return [r for r, before in zip(picked, [None, *picked]) if r != before]


def _not_after(bound: Column, order: list[Key], values: list[Column]) -> Column:
    """Does a bound stand before the row in the full sort order, or at its place? Null is the least value; null if there is no such bound.

    The bound is named once: structs compare field by field with null as the least, and a field that sorts down changes sides.
    """
    mine = F.struct(*values)
    if not any(key.desc for key in order):
        return bound <= mine
    if all(key.desc for key in order):
        return mine <= bound

    def sides(b: Column) -> Column:
        pairs = [(v, b[key.name].alias(key.name)) if key.desc else (b[key.name].alias(key.name), v) for key, v in zip(order, values)]
        low, high = (F.struct(*side) for side in zip(*pairs))
        return F.when(b.isNotNull(), low <= high)

    return F.get(F.transform(F.array(bound), sides), F.lit(0))


def cutter(source: DataFrame, order: list[Key], n: int | None = None):
    """A function that adds `__cell` to any frame with the sort columns, by bounds sampled once from `source`."""
    rows = _bounds(source, order, n)

    def cut(df: DataFrame) -> DataFrame:
        if not rows:
            return df.withColumn("__cell", F.lit(0).cast("long"))
        keys, values = _images(df, order)
        kind = T.StructType([T.StructField("__bounds", T.ArrayType(df.select(*values).schema))])
        held = with_row(df, df.sparkSession.createDataFrame([([tuple(r) for r in rows],)], kind))
        # Binary search, one projection a step: a higher-order function would interpret its comparisons anew for each row.
        # A step names the last one's cell twice, so that a plan into which all of them are written grows with the bounds only.
        held, step = held.withColumn("__cell", F.lit(0)), 1 << (len(rows).bit_length() - 1)
        while step:
            up = _not_after(F.get("__bounds", F.col("__cell") + (step - 1)), keys, values)
            held = held.withColumn("__cell", F.col("__cell") + F.when(F.coalesce(up, F.lit(False)), step).otherwise(0))
            step >>= 1
        return held.withColumn("__cell", F.col("__cell").cast("long")).drop("__bounds")

    return cut


def with_cells(df: DataFrame, order, n: int | None = None, bounds_from: DataFrame | None = None) -> DataFrame:
    """Add `__cell`, which never decreases along the order and splits the rows evenly.

    Cells are cut by the values of all sort columns in their own types, so a value that holds many rows is cut by the
    next columns, and a common prefix of strings does no harm. `bounds_from` may name a cheaper frame with the same
    first sort column (for counts of equal values: the rows before counting) to sample from.
    """
    order = keys_of(order)
    if bounds_from is None:
        return cutter(df, order, n)(df)
    return cutter(bounds_from, [k for k in order if k.name in bounds_from.columns], n)(df)


def _prefix(table: DataFrame, group: list[str], carried: dict[str, Column]) -> DataFrame:
    """Fold each (group, cell) summary over the earlier cells of its group."""
    w = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    return table.select(*group, "__cell", *[c.over(w).alias(k) for k, c in carried.items()])


def number_rows(df: DataFrame, order, group=(), out: str = "pos", total: str | None = None,
                cell: Column | None = None, sizes_from: DataFrame | None = None) -> DataFrame:
    """Exact 0-based position of every row along `order` within its group.

    `cell` may name a known even split of the order (for hash orders); otherwise
    the cells come from quantile sketches of the sort columns. The order must be total.
    `sizes_from` may name a cheaper frame with the same rows' sort and group columns, so that
    what was added to `df` is not worked out again to count the cells.
    """
    group = as_list(group)
    source = df if sizes_from is None else sizes_from
    cut = cutter(source, keys_of(order)) if cell is None else lambda rows: rows.withColumn("__cell", cell)
    parts = cut(df)
    sizes = cut(source).groupBy(*group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group)
    before = w.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                         F.sum("__n").over(w).alias("__total"))
    inner = Window.partitionBy(*group, "__cell").orderBy(*[k.sort() for k in keys_of(order)])
    ranked = parts.withColumn("__rn", F.row_number().over(inner))
    # Without groups the table has one row per cell; Spark decides by its size.
    joined = same_keys(ranked, sizes, [*group, "__cell"])
    joined = joined.withColumn(out, F.col("__rn") - 1 + F.col("__off"))
    if total:
        joined = joined.withColumn(total, F.col("__total"))
    return joined.drop("__cell", "__rn", "__off", "__total")


def running(df: DataFrame, order, group=(), sums: dict[str, Column] | None = None,
            minima: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None,
            bounds_from: DataFrame | None = None) -> DataFrame:
    """Running sum / min / max up to and including each row, per group, along a total order."""
    group, order = as_list(group), keys_of(order)
    parts = with_cells(df, order, bounds_from=bounds_from)
    spec = [(k, c, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + b) for k, c in (sums or {}).items()]
    spec += [(k, c, F.min, F.least) for k, c in (minima or {}).items()]
    spec += [(k, c, F.max, F.greatest) for k, c in (maxima or {}).items()]
    parts = parts.withColumns({f"__v_{k}": c for k, c, _, _ in spec})
    per_cell = parts.groupBy(*group, "__cell").agg(*[f(f"__v_{k}").alias(f"__t_{k}") for k, _, f, _ in spec])
    carry = _prefix(per_cell, group, {f"__c_{k}": f(F.col(f"__t_{k}")) for k, _, f, _ in spec})
    inner = (Window.partitionBy(*group, "__cell").orderBy(*[k.sort() for k in order])
             .rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumns({f"__w_{k}": f(f"__v_{k}").over(inner) for k, _, f, _ in spec})
    joined = same_keys(parts, carry, [*group, "__cell"])
    joined = joined.withColumns({k: join(F.col(f"__c_{k}"), F.col(f"__w_{k}")) for k, _, _, join in spec})
    return joined.drop("__cell", *[f"__{p}_{k}" for k, *_ in spec for p in "vcw"])


def next_valid(df: DataFrame, order, value: str, out: str, group=()) -> DataFrame:
    """First non-null value at or after each row (back fill) along a total order."""
    group, order = as_list(group), keys_of(order)
    parts = with_cells(df, order)
    inner = Window.partitionBy(*group, "__cell").orderBy(*[k.sort() for k in order])
    # Rows are met from the last to the first: a frame that grows takes one step a row, one that shrinks is gone through anew for each row.
    met = Window.partitionBy(*group, "__cell").orderBy(*[k.back() for k in order]).rowsBetween(Window.unboundedPreceding, 0)
    # The first valid value of a cell: each row asks for it, the cell keeps one copy.
    heads = (parts.where(F.col(value).isNotNull())
             .withColumn("__rn", F.row_number().over(inner)).where("__rn = 1")
             .select(*group, "__cell", F.col(value).alias("__head")))
    cells = parts.select(*group, "__cell").distinct()
    heads = same_keys(cells, heads, [*group, "__cell"], "left")
    later = Window.partitionBy(*group).orderBy(F.desc("__cell")).rowsBetween(Window.unboundedPreceding, -1)
    carry = heads.select(*group, "__cell", F.last("__head", ignorenulls=True).over(later).alias("__carry"))
    filled = parts.withColumn("__here", F.last(value, ignorenulls=True).over(met))
    joined = same_keys(filled, carry, [*group, "__cell"])
    return joined.withColumn(out, F.coalesce("__here", "__carry")).drop("__cell", "__here", "__carry")


def framed(df: DataFrame, pos: str, columns, group=(), before: int = 0, after: int = 0,
           size: int = 1 << 17) -> DataFrame:
    """Bounded row frames (lag, lead, moving windows) by position, in blocks of `size` rows.

    Rows near a block's edge are copied to the neighbour block, so each block
    is complete by itself. `columns` maps the block window to named columns.
    """
    group = as_list(group)
    size = max(size, before, after)
    blk, off = F.floor(F.col(pos) / size).cast("long"), F.pmod(F.col(pos), F.lit(size))
    homes = [blk]
    if before:
        homes.append(F.when(off >= size - before, blk + 1))
    if after:
        homes.append(F.when((off < after) & (blk > 0), blk - 1))
    copied = df.withColumn("__home", blk).withColumn("__blk", F.explode(F.array_compact(F.array(*homes))))
    w = Window.partitionBy(*group, "__blk").orderBy(pos)
    return (copied.withColumns(columns(w)).where(F.col("__blk") == F.col("__home"))
            .drop("__blk", "__home"))
