"""Nearest-neighbour joins, exact and approximate, with optional per-query label conditions.

Few queries (a checked bound): every task scans its base rows against all
queries and keeps k per query, so the base table is not shuffled.

Many queries: base rows are written once, in the order of the cells of their
nearest pivots, to the run's shared folder. A task holds a block of queries of
neighbouring cells and reads the base in groups of rows, near cells first. It
keeps k rows per query, and the triangle inequality skips groups that cannot
hold a nearer one; nothing but the k rows of a query is shuffled. The
approximate search sends copies of both sides to pairs of blocks instead.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.cols import as_list
from ..functions.hashing import portable_hash
from ..functions.store import work_dir
from .scale import normalize_rows

SMALL_QUERY_CELLS = 1 << 20  # query rows x dimensions a task may hold beside its base rows
BLOCK = 2048
QUERY_BLOCK = 8192  # queries that meet a block of base rows in one task; base rows are copied once for each such block
MAX_STATS = 200_000  # (label, cell) rows the router may hold
DIGITS = 9


def _matrix(col: pd.Series) -> np.ndarray:
    return np.asarray(np.stack(col.to_numpy()), dtype=np.float64) if len(col) else np.zeros((0, 0))


def _top(q: np.ndarray, b: np.ndarray, bid: np.ndarray, k: int, mask: np.ndarray | None, bound: np.ndarray | None = None):
    """(query row, base row, distance) of the k nearest per query; ties by base id.

    Squared distances by matrix product pick candidates within their rounding
    error; the candidates' distances are then computed directly. Rows farther
    than a query's `bound` do not matter.
    """
    q2, b2 = (q * q).sum(1), (b * b).sum(1)
    d2 = q2[:, None] + b2[None, :] - 2.0 * (q @ b.T)
    if mask is not None:
        d2 = np.where(mask, d2, np.inf)
    kk = min(k, b.shape[0])
    kth = np.full(len(q), np.inf) if bound is None else bound * bound
    if not np.isfinite(kth).all():
        kth = np.fmin(kth, np.partition(d2, kk - 1, axis=1)[:, kk - 1])
    slack = 1e-11 * (1.0 + q2 + (b2.max() if len(b2) else 0.0)) + 1e-8 * np.sqrt(np.maximum(np.where(np.isfinite(kth), kth, 0.0), 0.0))
    rows, cols = np.nonzero((d2 <= (kth + slack)[:, None]) & np.isfinite(d2))
    diff = q[rows] - b[cols]
    dist = np.round(np.sqrt((diff * diff).sum(1)), DIGITS)
    order = np.lexsort((bid[cols], dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    start = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - start < k
    return rows[keep], cols[keep], dist[keep]


def _mask(allowed: list | None, labels: np.ndarray | None):
    """rows: queries, columns: base rows."""
    if allowed is None or labels is None:
        return None
    return np.stack([np.isin(labels, list(a)) for a in allowed]) if len(allowed) else np.zeros((0, len(labels)), bool)


def _matches(qid, bid, lab, rows, cols, dist) -> pd.DataFrame:
    return pd.DataFrame({"query_id": qid[rows], "base_id": bid[cols], "label": lab[cols], "distance": dist})


def _best(q, qid, b, bid, lab, k, allowed, per_label) -> pd.DataFrame:
    if not per_label:
        return _matches(qid, bid, lab, *_top(q, b, bid, k, _mask(allowed, lab)))
    parts = []
    for value in pd.unique(lab):
        at = np.nonzero(lab == value)[0]
        mask = None if allowed is None else np.repeat(np.array([value in set(a) for a in allowed])[:, None], len(at), 1)
        rows, cols, dist = _top(q, b[at], bid[at], k, mask)
        parts.append(_matches(qid, bid, lab, rows, at[cols], dist))
    return pd.concat(parts) if parts else _matches(qid, bid, lab, *[np.array([], int)] * 2, np.array([]))


def _final(matches: DataFrame, k: int, per_label: bool) -> DataFrame:
    group = ["query_id", "label"] if per_label else ["query_id"]
    w = Window.partitionBy(*group).orderBy("distance", "base_id")
    return matches.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _prepare(df: DataFrame, key: str, vec: str, metric: str, extra: dict) -> DataFrame:
    out = df.select(F.col(key).cast("long").alias("id"), F.transform(vec, lambda x: x.cast("double")).alias("vec"), *[F.col(c).alias(a) for a, c in extra.items()])
    return normalize_rows(out, "vec") if metric == "cosine" else out


def _scan_few(q: DataFrame, b: DataFrame, k: int, schema: str, per_label: bool, conditional: bool) -> DataFrame:
    pdf = q.toPandas()  # bounded by the caller's check
    qm, qid = _matrix(pdf["vec"]), pdf["id"].to_numpy()
    allowed = [list(a) for a in pdf["allowed"]] if conditional else None

    def scan(batches):
        for part in batches:
            if len(part):
                lab = part["label"].to_numpy() if "label" in part else np.zeros(len(part), int)
                for s in range(0, len(qid), 256):
                    yield _best(qm[s:s + 256], qid[s:s + 256], _matrix(part["vec"]), part["id"].to_numpy(), lab, k,
                                allowed[s:s + 256] if allowed else None, per_label)

    return b.mapInPandas(scan, schema)


def _pivots(b: DataFrame, n: int) -> np.ndarray:
    rows = b.select("vec", portable_hash("pivot", "id").alias("h"), "id").orderBy("h", "id").limit(n).select("vec").toPandas()
    return _matrix(rows["vec"])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0.0))


def _assign(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot and the distance to it."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("to_pivot", T.DoubleType())])

    def nearest(batches):
        for part in batches:
            if len(part):
                d = _distances(_matrix(part["vec"]), pivots)
                c = d.argmin(1)
                yield part.assign(cell=c.astype("int32"), to_pivot=d[np.arange(len(c)), c])

    return df.mapInPandas(nearest, schema)


def _routed(q: DataFrame, pivots: np.ndarray, stats: pd.DataFrame, conditional: bool, per_label: bool, probes: int) -> DataFrame:
    """The `probes` base cells whose pivots are nearest to each query, within each label if `per_label`."""
    s_cell, s_lab = stats["cell"].to_numpy(), stats["label"].to_numpy()
    groups = [np.nonzero(s_lab == v)[0] for v in pd.unique(s_lab)] if per_label else [np.arange(len(s_cell))]
    schema = T.StructType([*q.schema.fields, T.StructField("own", T.IntegerType()), T.StructField("targets", T.ArrayType(T.IntegerType()))])

    def route(batches):
        for part in batches:
            if not len(part):
                continue
            d = _distances(_matrix(part["vec"]), pivots)
            targets = []
            for i in range(len(part)):
                allowed = np.isin(s_lab, list(part["allowed"].iloc[i])) if conditional else None
                chosen = []
                for at in groups:
                    ok = at if allowed is None else at[allowed[at]]
                    if len(ok):
                        chosen.append(ok[np.argsort(d[i, s_cell[ok]], kind="stable")[:probes]])
                targets.append(np.concatenate(chosen).astype("int32") if chosen else np.array([], "int32"))
            yield part.assign(own=d.argmin(1).astype("int32"), targets=targets)

    return q.mapInPandas(route, schema)


def _query_blocks(q: DataFrame, pivots: np.ndarray, size: int | None = None) -> list[tuple[int, int, int]]:
    """(cell, first block, number of blocks) for each cell with queries, cells near the first pivot first.

    Cells are put together while their queries fit a block, and a crowded cell gets blocks of its own, so the number of
    blocks follows the number of queries alone.
    """
    counts = {r["cell"]: r["count"] for r in _assign(q, pivots).groupBy("cell").count().collect()}  # at most as many rows as pivots
    size, out, block, held = size or QUERY_BLOCK, [], 0, 0
    for cell in _distances(pivots[:1], pivots)[0].argsort(kind="stable").tolist():
        n = counts.get(cell, 0)
        if not n:
            continue
        if held and held + n > size:
            block, held = block + 1, 0
        parts = -(-n // size)
        out.append((cell, block, parts))
        block, held = (block, held + n) if parts == 1 else (block + parts, 0)
    return out


def _cells(b: DataFrame, centres: np.ndarray, split: bool) -> tuple[DataFrame, pd.DataFrame, DataFrame]:
    """Base rows with their (label, cell) number `target`, a share of it as `block`, and the table of targets on the driver and as a broadcast.

    Labels tell cells apart only if the search goes by label (`split`); rows without one are not found then.
    """
    cells = _assign(b.where(F.col("label").isNotNull()) if split else b, centres).withColumn("__g", F.col("label") if split else F.lit(0))
    stats = (cells.groupBy(F.col("__g").alias("label"), "cell").agg(F.count(F.lit(1)).alias("n"), F.min("to_pivot").alias("lo"), F.max("to_pivot").alias("hi"))
             .orderBy("label", "cell").toPandas())  # at most labels x pivots <= MAX_STATS rows
    stats["target"] = np.arange(len(stats), dtype="int32")
    stats["blocks"] = np.maximum(1, -(-stats["n"] // BLOCK)).astype("int32")
    kind = cells.schema["__g"].dataType
    plan = b.sparkSession.createDataFrame(stats[["label", "cell", "target", "blocks"]], T.StructType([
        T.StructField("label", kind), *[T.StructField(c, T.IntegerType()) for c in ("cell", "target", "blocks")]]))
    plan = F.broadcast(plan.withColumnRenamed("label", "__g"))
    base = (cells.join(plan, ["__g", "cell"])
            .withColumn("block", (F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")).select("target", "block", "id", "vec", "label"))
    return base, stats, plan


def _centres(b: DataFrame, split: bool, probes: int | None, pivots: int | None) -> tuple[np.ndarray, int]:
    """Pivots of the base rows, and the number of labels that tell cells apart."""
    n_base = b.count()
    n_labels = b.select("label").distinct().count() if split else 1
    if n_labels > MAX_STATS:
        raise ValueError(f"{n_labels} labels; condition on at most {MAX_STATS} labels per call, or split the conditions into several calls")
    # Cells of about one block; the approximate search needs finer cells to skip most of them.
    wanted = pivots or (math.ceil(n_base / BLOCK) if probes is None else int(math.sqrt(n_base)) + 1)
    return _pivots(b, max(1, min(wanted, 512, MAX_STATS // max(n_labels, 1)))), n_labels


def _probed(q: DataFrame, b: DataFrame, k: int, schema: str, conditional: bool, per_label: bool, probes: int, pivots: int | None) -> DataFrame:
    centres, _ = _centres(b, conditional or per_label, probes, pivots)
    base, stats, plan = _cells(b, centres, conditional or per_label)
    spark = q.sparkSession
    routed = _routed(q, centres, stats, conditional, per_label, probes)
    blocks = F.broadcast(spark.createDataFrame(_query_blocks(q, centres), "own int, first int, parts int"))
    routed = (routed.join(blocks, "own").withColumn("q_block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
              .withColumn("target", F.explode("targets")).drop("targets", "own", "first", "parts")
              .join(F.broadcast(plan.select("target", "blocks")), "target")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pairs = routed.select(F.col("q_block").alias("with_q"), F.col("target").alias("at"), F.col("block").alias("part")).distinct()
    left = routed.select("q_block", "target", "block", F.col("id"), F.col("vec"), *(["allowed"] if conditional else []))
    right = (base.join(pairs, (F.col("target") == F.col("at")) & (F.col("block") == F.col("part")))
             .select("with_q", "at", "part", "id", "vec", "label"))

    def meet(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if not len(qp) or not len(bp):
            return pd.DataFrame({"query_id": [], "base_id": [], "label": [], "distance": []})
        b_m, bid, lab = _matrix(bp["vec"]), bp["id"].to_numpy(), bp["label"].to_numpy()
        parts = []
        for s in range(0, len(qp), 256):
            some = qp.iloc[s:s + 256]
            parts.append(_best(_matrix(some["vec"]), some["id"].to_numpy(), b_m, bid, lab, k,
                               [list(a) for a in some["allowed"]] if conditional else None, per_label))
        return pd.concat(parts)

    return (left.groupBy("q_block", "target", "block").cogroup(right.groupBy("with_q", "at", "part"))
            .applyInPandas(meet, schema))


def _row_groups(path: str) -> list[tuple[str, int, int, int]]:
    """(file, row group, first target, last target) of a folder of Parquet files, from their footers."""
    fs, root = FileSystem.from_uri(path)
    out = []
    for info in fs.get_file_info(FileSelector(root)):
        if info.base_name.endswith(".parquet"):
            with fs.open_input_file(info.path) as file:
                meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index("target")
            for g in range(meta.num_row_groups):
                found = meta.row_group(g).column(at).statistics
                out.append((info.path, g, found.min, found.max))
    return out


class _Nearest:
    """The k nearest rows found so far of each query of a block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.dist, self.id, self.label = np.full((n, k), np.inf), np.zeros((n, k), np.int64), np.full((n, k), None, object)

    def bound(self) -> np.ndarray:
        return self.dist[:, -1]

    def meet(self, at: np.ndarray, q: np.ndarray, b: np.ndarray, bid: np.ndarray, lab: np.ndarray) -> None:
        """Queries at the places `at` meet some base rows."""
        for s in range(0, len(at), 256):
            mine = at[s:s + 256]
            rows, cols, dist = _top(q[mine], b, bid, self.k, None, self.dist[mine, -1])
            if not len(rows):
                continue
            own = np.unique(rows)
            place = np.concatenate([np.repeat(own, self.k), rows])
            dist = np.concatenate([self.dist[mine[own]].ravel(), dist])
            ids, labels = np.concatenate([self.id[mine[own]].ravel(), bid[cols]]), np.concatenate([self.label[mine[own]].ravel(), lab[cols]])
            order = np.lexsort((ids, dist, place))
            place = place[order]
            rank = np.arange(len(place)) - np.searchsorted(place, place, side="left")
            keep = rank < self.k
            to, order = (mine[place[keep]], rank[keep]), order[keep]
            self.dist[to], self.id[to], self.label[to] = dist[order], ids[order], labels[order]

    def rows(self, qid: np.ndarray) -> pd.DataFrame:
        at, rank = np.nonzero(np.isfinite(self.dist))
        return pd.DataFrame({"query_id": qid[at], "base_id": self.id[at, rank], "label": self.label[at, rank], "distance": self.dist[at, rank]})


def _scan_many(q: DataFrame, b: DataFrame, k: int, schema: str, conditional: bool, per_label: bool, pivots: int | None) -> DataFrame:
    spark, split = q.sparkSession, conditional or per_label
    centres, n_labels = _centres(b, split, None, pivots)
    if not len(centres):
        return spark.createDataFrame([], schema)
    base, stats, _ = _cells(b, centres, split)
    n, dims = q.count(), centres.shape[1]
    path = work_dir(spark, "base")
    (base.repartition("target", "block").sortWithinPartitions("target", "block").write.option("parquet.block.size", BLOCK * (8 * dims + 16))
     .option("parquet.enable.dictionary", "false").parquet(path))
    groups = _row_groups(path)  # one for some BLOCK base rows
    s_cell, s_lo, s_hi = stats["cell"].to_numpy(), stats["lo"].to_numpy(), stats["hi"].to_numpy()
    s_lab = stats["label"].to_list()
    starts = [i for i in range(len(s_lab)) if i == 0 or s_lab[i] != s_lab[i - 1]]  # a label's targets follow each other
    ends = np.array([*starts[1:], len(s_lab)])
    # A block is read against the whole base: few enough for the cores to share, and bounded with what it finds.
    size = max(256, min(QUERY_BLOCK, -(-n // (4 * spark.sparkContext.defaultParallelism))))
    if per_label:
        size = max(64, min(size, 64 * QUERY_BLOCK // (n_labels * k)))
    blocks = _query_blocks(q, centres, size)
    placed = (_assign(q, centres).drop("to_pivot").join(F.broadcast(spark.createDataFrame(blocks, "cell int, first int, parts int")), "cell")
              .withColumn("q_block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("cell", "first", "parts"))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        fs, _ = FileSystem.from_uri(path)
        qm, qid = _matrix(part["vec"]), part["id"].to_numpy()
        to_pivot = _distances(qm, centres)
        nearest, everyone = to_pivot.min(0), np.arange(len(qid))
        asking = None
        if conditional:
            asking = {}
            for i, allowed in enumerate(part["allowed"]):
                for v in set(allowed if allowed is not None else ()):
                    asking.setdefault(v, []).append(i)
        visits = []  # (label's place, distance, file, row group, its targets of the label)
        for name, g, first, last in groups:
            near = nearest[s_cell[first:last + 1]].min()
            for j in range(np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="right") + 1):
                if asking is None or s_lab[starts[j]] in asking:
                    visits.append((j if per_label else 0, near, name, g, max(first, starts[j]), min(last, ends[j] - 1), j))
        found, held, out, opened, rows = _Nearest(len(qid), k), None, [], None, None
        for label, _, name, g, first, last, j in sorted(visits):
            if per_label and held not in (None, label):
                out.append(found.rows(qid))
                found = _Nearest(len(qid), k)
            held = label
            at = everyone if asking is None else np.array(asking[s_lab[starts[j]]])
            d, bound = to_pivot[np.ix_(at, s_cell[first:last + 1])], found.bound()[at]
            least = np.maximum(d - s_hi[first:last + 1], s_lo[first:last + 1] - d).min(1)
            at = at[~np.isfinite(bound) | (least <= bound + 1e-6 * (1 + np.where(np.isfinite(bound), bound, 0.0)))]
            if not len(at):
                continue
            if opened != (name, g):
                with fs.open_input_file(name) as file:
                    t = pq.ParquetFile(file).read_row_group(g).combine_chunks()
                rows = (t["target"].to_numpy(), t["vec"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1), t["id"].to_numpy(),
                        t["label"].to_pandas().to_numpy())
                opened = name, g
            some = slice(np.searchsorted(rows[0], first, side="left"), np.searchsorted(rows[0], last, side="right"))
            if some.stop > some.start:
                found.meet(at, qm, rows[1][some], rows[2][some], rows[3][some])
        return pd.concat([*out, found.rows(qid)])

    return placed.repartition(blocks[-1][1] + blocks[-1][2] if blocks else 1, "q_block").groupBy("q_block").applyInPandas(search, schema)


def knn_join(queries: DataFrame, base: DataFrame, key: str, vec: str, k: int, metric: str = "l2", label: str | None = None,
             conditioner: str | None = None, per_label: bool = False, probes: int | None = None, base_key: str | None = None,
             small: bool | None = None, pivots: int | None = None) -> DataFrame:
    """(query_id, base_id, label, distance, rank): the k nearest base rows of every query, ties by base id.

    `conditioner` is a query column with the allowed labels, applied before the
    ranking; `per_label` ranks within each label; `probes` visits only that many
    cells (approximate).
    """
    extra_q = {"allowed": conditioner} if conditioner else {}
    extra_b = {"label": label} if label else {}
    q, b = _prepare(queries, key, vec, metric, extra_q), _prepare(base, base_key or key, vec, metric, extra_b)
    kind = b.schema["label"].dataType.simpleString() if label else "int"
    if label is None:
        b = b.withColumn("label", F.lit(0))
    schema = f"query_id long, base_id long, label {kind}, distance double"
    shape = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    few = shape["n"] * (shape["d"] or 1) <= SMALL_QUERY_CELLS if small is None else small
    if probes is not None:
        out = _probed(q, b, k, schema, conditioner is not None, per_label, probes, pivots)
    elif few:
        out = _scan_few(q, b, k, schema, per_label, conditioner is not None)
    else:
        out = _scan_many(q, b, k, schema, conditioner is not None, per_label, pivots)
    out = _final(out, k, per_label)
    if metric == "cosine":  # unit vectors: cosine distance = squared distance / 2
        out = out.withColumn("distance", F.round(F.col("distance") * F.col("distance") / 2, DIGITS))
    return out if label else out.drop("label")


def conditional_knn(queries: DataFrame, base: DataFrame, key: str, vec: str, label: str, conditioner: str, k: int, **kw) -> DataFrame:
    return knn_join(queries, base, key, vec, k, label=label, conditioner=conditioner, **kw)


def matches_per_class(queries: DataFrame, base: DataFrame, key: str, vec: str, label: str, classes, **kw) -> DataFrame:
    """Nearest base row of every listed class, one column per class, in one pass; a query without any has nulls."""
    best = knn_join(queries, base.where(F.col(label).isin(list(classes))), key, vec, 1, label=label, per_label=True, **kw)
    best = queries.select(F.col(key).cast("long").alias("query_id")).distinct().join(best, "query_id", "left")
    return (best.groupBy("query_id").pivot("label", list(classes)).agg(F.min("base_id"))
            .select("query_id", *[F.col(str(c)).alias(f"match_{c}") for c in classes]))


def knn_classify(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int, weights: str = "distance", **kw) -> DataFrame:
    """Vote of the k nearest; with distance weights an exact match outvotes all others. Ties: smallest label."""
    near = knn_join(test, train, key, vec, k, label=label, **kw)
    if weights == "distance":
        near = near.withColumn("__d", F.min("distance").over(Window.partitionBy("query_id"))).withColumn(
            "__w", F.when(F.col("__d") == 0, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance"))))
    else:
        near = near.withColumn("__w", F.lit(1.0))
    votes = near.groupBy("query_id", "label").agg(F.round(F.sum("__w"), 6).alias("__v"))
    return votes.groupBy("query_id").agg(F.min_by("label", F.struct(-F.col("__v"), F.col("label"))).alias("prediction"))


def approx_knn_join(queries: DataFrame, base: DataFrame, key: str, vec: str, k: int, probes: int = 4, **kw) -> DataFrame:
    """Visits only the `probes` cells whose pivots are nearest."""
    return knn_join(queries, base, key, vec, k, probes=probes, **kw)
