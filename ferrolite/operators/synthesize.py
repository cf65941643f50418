"""Feature synthesis over linked tables and series.

Every edge is one grouped aggregation of the child (combined before the
shuffle) and one left join up; cutoffs travel down the edges as a column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.cols import NUMERIC, as_list, dbl, div, r, skew_safe_lookup, union_all, with_row
from ..functions.ordered import framed, number_rows
from ..functions.store import cut

TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Entity:
    df: DataFrame
    key: str | None
    time_index: str | None = None
    spread_by: tuple[str, ...] = ()
    ignore: tuple[str, ...] = ()


@dataclass(frozen=True)
class EntitySet:
    """Tables by name and one-to-many edges (parent, child, foreign key)."""

    tables: dict[str, Entity]
    edges: list[tuple[str, str, str]] = field(default_factory=list)

    def children(self, name: str):
        return [(c, fk) for p, c, fk in self.edges if p == name]

    def parents(self, name: str):
        return [(p, fk) for p, c, fk in self.edges if c == name]

    def with_table(self, name: str, df: DataFrame, **changes) -> "EntitySet":
        return EntitySet({**self.tables, name: replace(self.tables[name], df=df, **changes)}, self.edges)


def validate(es: EntitySet) -> DataFrame:
    """Per edge: child rows, child rows without a parent, and repeated parent keys."""
    frames = []
    for parent, child, fk in es.edges:
        p, c = es.tables[parent], es.tables[child].df
        keys = p.df.select(F.col(p.key).alias("__k"))
        orphans = c.join(keys.distinct(), F.col(fk) == F.col("__k"), "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
        repeats = keys.groupBy("__k").count().where("count > 1").agg(F.count(F.lit(1)).alias("repeated_keys"))
        row = c.agg(F.count(F.lit(1)).alias("child_rows"))
        frames.append(with_row(with_row(row, orphans), repeats).select(F.lit(parent).alias("parent"), F.lit(child).alias("child"), "child_rows", "orphans", "repeated_keys"))
    return union_all(frames)


AGG: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: F.sum(dbl(c)), "mean": lambda c: F.avg(dbl(c)), "min": lambda c: F.min(dbl(c)),
    "max": lambda c: F.max(dbl(c)), "std": lambda c: F.stddev_samp(dbl(c))}
TRANS: dict[str, tuple[tuple, Callable[[str], Column]]] = {
    "month": (TIMES, lambda c: F.month(c)), "hour": (TIMES, lambda c: F.hour(c)), "absolute": (NUMERIC, lambda c: F.abs(c))}


def _quote(name: str) -> str:
    return f"`{name}`"


def _used(es: EntitySet, name: str) -> set[str]:
    e = es.tables[name]
    return {e.key, *e.ignore, *[fk for _, fk in es.parents(name)], "cutoff"}


def transforms(es: EntitySet, name: str, trans, df: DataFrame) -> DataFrame:
    out = {}
    for prim in as_list(trans):
        if prim == "time_since_previous":
            continue
        types, fn = TRANS[prim]
        for f in es.tables[name].df.schema.fields:
            if isinstance(f.dataType, types) and f.name not in _used(es, name):
                out[f"{prim.upper()}({f.name})"] = fn(f.name)
    df = df.withColumns(out)
    if "time_since_previous" in as_list(trans) and es.tables[name].time_index:
        e = es.tables[name]
        df = time_since_previous(df, e.time_index, e.key, out=f"TIME_SINCE_PREVIOUS({e.time_index})")
    return df


def time_since_previous(df: DataFrame, time: str, tie, group=(), out: str = "time_since_previous") -> DataFrame:
    """Seconds since the previous row by time (within a group, if given)."""
    pos = number_rows(df, [time, *as_list(tie)], group, out="__pos")

    def seconds(c):
        return F.unix_micros(F.col(c).cast("timestamp")) / 1e6

    pos = pos.withColumn("__sec", seconds(time))
    return framed(pos, "__pos", lambda w: {out: F.col("__sec") - F.lag("__sec").over(w)}, group, before=1).drop("__pos", "__sec")


def avg_time_between(time: str) -> Column:
    """(last - first) / (n - 1) in seconds; null for a single row."""
    sec = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    return div(F.max(sec) - F.min(sec), F.count(time) - 1)


def dfs(es: EntitySet, target: str, agg=("count",), trans=(), depth: int = 2, max_features: int = 500) -> tuple[DataFrame, list[str]]:
    """Feature matrix of the target (key first) and the list of feature names."""
    e = es.tables[target]
    df = transforms(es, target, trans, e.df)
    if depth > 0:
        for child, fk in es.children(target):
            df = df.join(_aggregate(es, child, fk, agg, trans, depth, max_features), df[e.key] == F.col("__fk"), "left").drop("__fk")
            counts = [c for c in df.columns if c == f"COUNT({child})"]
            df = df.withColumns({c: F.coalesce(F.col(_quote(c)), F.lit(0)) for c in counts})
    names = [c for c in df.columns if c not in {e.key, "cutoff"}]
    if len(names) > max_features:
        raise ValueError(f"{len(names)} features for {target}; allow fewer primitives, less depth or raise max_features")
    return df, names


def _aggregate(es: EntitySet, child: str, fk: str, agg, trans, depth: int, max_features: int) -> DataFrame:
    c = es.tables[child]
    rows, names = dfs(es, child, agg, trans, depth - 1, max_features) if c.key else (transforms(es, child, trans, c.df), list(c.df.columns))
    skip = _used(es, child)
    numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in skip and f.name in names]
    outs: dict[str, Column] = {}
    for prim in as_list(agg):
        if prim == "count":
            outs[f"COUNT({child})"] = F.count(F.lit(1))
        elif prim == "avg_time_between":
            if c.time_index:
                outs[f"AVG_TIME_BETWEEN({child}.{c.time_index})"] = avg_time_between(c.time_index)
        else:
            for n in numeric:
                outs[f"{prim.upper()}({child}.{n})"] = AGG[prim](_quote(n))
    return rows.groupBy(F.col(fk).alias("__fk")).agg(*[col.alias(name) for name, col in outs.items()])


def last_time_index(es: EntitySet, name: str, out: str = "last_time") -> DataFrame:
    """The row's own time or the latest time among its descendants, whichever is later."""
    e = es.tables[name]
    df = e.df.withColumn(out, F.col(e.time_index).cast("timestamp") if e.time_index else F.lit(None).cast("timestamp"))
    for child, fk in es.children(name):
        c = es.tables[child]
        if c.key or c.time_index:
            sub = last_time_index(es, child, "__t") if c.key else c.df.withColumn("__t", F.col(c.time_index).cast("timestamp"))
            latest = sub.groupBy(F.col(fk).alias("__k")).agg(F.max("__t").alias("__child"))
            df = df.join(latest, F.col(e.key) == F.col("__k"), "left").withColumn(out, F.greatest(out, "__child")).drop("__k", "__child")
    return df


def at_cutoff(es: EntitySet, target: str, cutoffs: DataFrame, window: Column | None = None, instance_ids=None) -> EntitySet:
    """Only rows known at the target's cutoff and, given a window, active inside it.

    `cutoffs` is (target key, cutoff). A row with descendants counts as active
    until its last descendant.
    """
    e = es.tables[target]
    if instance_ids is not None:
        cutoffs = cutoffs.join(instance_ids.select(e.key).distinct(), e.key, "left_semi")
    es = es.with_table(target, e.df.join(cutoffs, e.key))

    def down(es: EntitySet, name: str) -> EntitySet:
        parent = es.tables[name]
        for child, fk in es.children(name):
            c = es.tables[child]
            limits = parent.df.select(F.col(parent.key).alias(fk), "cutoff")
            source = last_time_index(es, child) if c.key and c.time_index and window is not None else c.df
            rows = skew_safe_lookup(source, limits, fk, [x for x in c.spread_by if x in c.df.columns] or list(c.df.columns))
            if c.time_index:
                rows = rows.where(F.col(c.time_index) <= F.col("cutoff"))
                if window is not None:
                    active = "last_time" if "last_time" in rows.columns else c.time_index
                    rows = rows.where(F.col(active) > F.col("cutoff") - window)
            es = down(es.with_table(child, rows.drop("last_time").select(*c.df.columns, "cutoff")), child)
        return es

    return down(es, target)


def parent_path(es: EntitySet, name: str, prefix: str = "") -> DataFrame:
    """Direct features: columns of parents and grandparents joined down, named `parent.column`."""
    df = es.tables[name].df
    for parent, fk in es.parents(name):
        p = es.tables[parent]
        up = parent_path(es, parent)
        up = up.select(F.col(_quote(p.key)).alias("__k"), *[F.col(_quote(c)).alias(f"{parent}.{c}") for c in up.columns if c != p.key])
        df = df.join(up, df[_quote(fk)] == F.col("__k"), "left").drop("__k")
    return df


def series_features(df: DataFrame, key: str, time, value: str, digits: int = 6) -> DataFrame:
    """Per series: size, moments, peaks, time-reversal asymmetry, lag-1 autocorrelation and linear trend."""
    pos = number_rows(df.select(key, *as_list(time), dbl(value).alias("x")), time, key, out="pos")
    rows = framed(pos, "pos", lambda w: {"prev": F.lag("x").over(w), "next": F.lead("x").over(w), "next2": F.lead("x", 2).over(w)}, key, before=1, after=2)
    x, nx, nx2 = F.col("x"), F.col("next"), F.col("next2")
    sums = rows.groupBy(key).agg(
        F.count("x").alias("length"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.var_pop("x").alias("variance"), F.count(F.when((x > F.col("prev")) & (x > nx), 1)).alias("peaks"),
        F.avg(F.when(nx2.isNotNull(), nx2 * nx2 * nx - nx * x * x)).alias("asymmetry"),
        F.sum(F.when(nx.isNotNull(), x * nx)).alias("__xn"), F.sum(F.when(nx.isNotNull(), x + nx)).alias("__s"),
        F.regr_slope("x", "pos").alias("slope"))
    m, n = F.col("mean"), F.col("length")
    auto = div(F.col("__xn") - m * F.col("__s") + (n - 1) * m * m, (n - 1) * F.col("variance"))
    return sums.select(key, "length", "peaks", *[r(F.col(c), digits).alias(c) for c in ("mean", "sd", "min", "max", "variance", "asymmetry", "slope")],
                       r(auto, digits).alias("autocorrelation"))


def _match_counts(windows: DataFrame, key: str, m: int, radius: float, block: int) -> DataFrame:
    """(key, w, times, c_short, c_long): distinct windows of m + 1 values, how often each occurs, and how many windows
    of the series lie within the radius by their first m and by all m + 1 values.

    Equal windows are counted once, so a constant stretch costs one row. A series
    of at most one block is compared as a whole. In longer ones only windows
    whose first values fall into neighbouring slices of width `radius` meet,
    block against block. A block pair yields counts, never pairs.
    """
    distinct = windows.groupBy(key, "w").agg(F.count(F.lit(1)).alias("times"))
    rows = cut(distinct)
    lengths = rows.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    rows = rows.join(lengths, F.col(key) == F.col("__k")).drop("__k")
    long_series = F.col("__n") > block
    rows = rows.withColumn("cell", F.when(long_series, F.floor(F.col("w")[0] / radius).cast("long")).otherwise(0))
    sizes = rows.groupBy(key, "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    held = cut(rows.join(sizes, [key, "cell"]).withColumn("block", F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int")))
    near = F.when(long_series, F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).otherwise(F.array("cell"))
    asks = held.select(F.col(key).alias("q_key"), F.col("w").alias("q_w"), F.col("times").alias("q_times"), F.col("cell").alias("q_cell"),
                       F.col("block").alias("q_block"), F.explode(near).alias("at"))
    plan = held.select(F.col(key).alias("p_key"), F.col("cell").alias("p_cell"), F.col("blocks").alias("p_blocks")).distinct()
    asks = (asks.join(plan, (F.col("q_key") == F.col("p_key")) & (F.col("at") == F.col("p_cell")))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("p_blocks") - 1))).drop("p_key", "p_cell", "p_blocks"))
    pairs = asks.select(F.col("q_key").alias("t_key"), F.col("at").alias("t_cell"), F.col("part").alias("t_block"),
                        F.col("q_cell").alias("t_qc"), F.col("q_block").alias("t_qb")).distinct()
    copies = (held.join(pairs, (F.col(key) == F.col("t_key")) & (F.col("cell") == F.col("t_cell")) & (F.col("block") == F.col("t_block")))
              .select("t_key", "t_cell", "t_block", "t_qc", "t_qb", "w", "times"))
    kind = windows.schema[key].dataType.simpleString()

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({key: [], "w": [], "times": [], "c_short": [], "c_long": []})
        other, weight = np.stack(b["w"].to_numpy()), b["times"].to_numpy()
        mine = np.stack(a["q_w"].to_numpy())
        short, full = np.zeros(len(a), "int64"), np.zeros(len(a), "int64")
        for s in range(0, len(a), 128):
            part = mine[s:s + 128]
            near_m = np.ones((len(part), len(other)), bool)
            for d in range(m):
                near_m &= np.abs(part[:, d][:, None] - other[:, d][None, :]) <= radius
            short[s:s + 128] = near_m @ weight
            full[s:s + 128] = (near_m & (np.abs(part[:, m][:, None] - other[:, m][None, :]) <= radius)) @ weight
        return pd.DataFrame({key: a["q_key"], "w": a["q_w"], "times": a["q_times"], "c_short": short, "c_long": full})

    hits = (asks.groupBy("q_key", "at", "part", "q_cell", "q_block").cogroup(copies.groupBy("t_key", "t_cell", "t_block", "t_qc", "t_qb"))
            .applyInPandas(count, f"{key} {kind}, w array<double>, times long, c_short long, c_long long"))
    return hits.groupBy(key, "w").agg(F.first("times").alias("times"), F.sum("c_short").alias("c_short"), F.sum("c_long").alias("c_long"))


def approx_entropy(df: DataFrame, key: str, time, value: str, m: int = 2, radius: float = 1.0, digits: int = 6, block: int = 2048) -> DataFrame:
    """Phi(m) - Phi(m + 1), Phi = mean log share of windows within the radius."""
    pos = number_rows(df.select(key, *as_list(time), dbl(value).alias("x")), time, key, out="pos")
    wide = framed(pos, "pos", lambda w: {f"x{i}": F.lead("x", i).over(w) for i in range(1, m + 1)}, key, after=m)
    last_short, last = F.col(f"x{m - 1}" if m > 1 else "x"), F.coalesce(F.col(f"x{m}"), F.lit(float("nan")))
    windows = wide.where(last_short.isNotNull()).select(key, F.array("x", *[F.col(f"x{i}") for i in range(1, m)], last).alias("w"))
    counts = _match_counts(windows, key, m, radius, block)
    whole = F.col("c_long") > 0  # a complete window matches itself; the last, short one matches none
    n_short, n_long = F.sum("times"), F.sum(F.when(whole, F.col("times")))
    phi_short = F.sum(F.col("times") * F.ln("c_short")) / n_short - F.ln(n_short)
    phi_long = F.sum(F.when(whole, F.col("times") * F.ln("c_long"))) / n_long - F.ln(n_long)
    return counts.groupBy(key).agg(r(phi_short - phi_long, digits).alias("approx_entropy"))


@dataclass(frozen=True)
class Problem:
    """One label definition: rows that pass a filter, aggregated over the window after the cutoff."""

    name: str
    condition: str
    aggregate: str
    value: str | None
    days: int


def enumerate_problems(filters: dict[str, str], aggregates, values, windows) -> list[Problem]:
    out = []
    for fname, cond in filters.items():
        for a in as_list(aggregates):
            for v in ([None] if a == "count" else as_list(values)):
                for d in as_list(windows):
                    out.append(Problem(f"{a}({v or '*'}) of {fname} in {d}d", cond, a, v, d))
    return out


def prediction_problems(df: DataFrame, key: str, time: str, spread_by, cutoffs: DataFrame, problems: list[Problem], digits: int = 6) -> DataFrame:
    """(problem, key, label) for every problem and entity, in one pass over the rows."""
    rows = skew_safe_lookup(df, cutoffs, key, spread_by)
    fns = {"count": lambda c: F.count(c), "sum": lambda c: F.sum(c), "mean": lambda c: F.avg(c), "max": lambda c: F.max(c), "min": lambda c: F.min(c)}
    aggs = []
    for i, p in enumerate(problems):
        inside = F.expr(p.condition) & (F.col(time) > F.col("cutoff")) & (F.col(time) <= F.col("cutoff") + F.expr(f"INTERVAL {p.days} DAYS"))
        v = F.lit(1.0) if p.value is None else dbl(p.value)
        aggs.append(fns[p.aggregate](F.when(inside, v)).cast("double").alias(f"p{i}"))
    labels = rows.groupBy(key).agg(*aggs)
    return labels.select(key, F.inline(F.array(*[F.struct(F.lit(p.name).alias("problem"), r(F.col(f"p{i}"), digits).alias("label")) for i, p in enumerate(problems)])))
