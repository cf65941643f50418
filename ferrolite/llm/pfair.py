"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are put in a pseudo-random order and cut into blocks. Block j of a source with share w is
released at slot floor(j / w) and due by slot ceil((j + 1) / w). In each slot the released block with the earliest
deadline runs (ties: the earlier next deadline, then the source's name), so at every slot each source is less than
one block away from its share.

Shares are whole-number weights, so the schedule repeats after `sum(weights)` slots. Only that one period is worked
out on its own (its length is checked against `MAX_PERIOD`); the place of any block then follows from its number,
and blocks of all rows are placed in parallel. When a source has no rows left, the others go on with their weights
as a new phase; at most one phase a source. No row is dropped or repeated. The last block of a source may be short.

Sources that are not listed share one queue with `other`; null is one of them. Listed sources without rows take no
part. With no rows the result is empty. Equal rows keep places of their own. Texts may be of any kind, as they are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush
from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import hash_cell, portable_hash
from .common import unpack, whole_row

BLOCK_ROWS = 64
ROWS_PER_CELL = 1 << 17
MAX_PERIOD = 1 << 16


def period(weights: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """(source, release, deadline, slot) of each block of one period."""
    total = sum(weights.values())
    if total > MAX_PERIOD:
        raise ValueError(f"weights add up to {total}; at most {MAX_PERIOD} can be scheduled")
    due = lambda s, j: -(-(j + 1) * total // weights[s])
    waiting = sorted((0, s, 0) for s in weights)
    ready, out = [], []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heappop(waiting)
            heappush(ready, (due(s, j), due(s, j + 1), s, j))
        deadline, _, s, j = heappop(ready)
        out.append((s, j * total // weights[s], deadline, slot))
        if j + 1 < weights[s]:
            heappush(waiting, ((j + 1) * total // weights[s], s, j + 1))
    return out


@dataclass(frozen=True)
class Phase:
    number: int
    start: int  # slot
    before: dict[str, int]  # blocks of each source in earlier phases
    weights: dict[str, int]
    table: list[tuple[str, int, int, int]]


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[Phase]:
    """A phase ends right after the slot in which some source has run its last block. Work is by source and period, not by row."""
    left, done, start, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        shared = reduce(gcd, (weights[s] for s in left))
        now = {s: weights[s] // shared for s in left}
        table, total = period(now), sum(now.values())
        at = {s: [x[3] for x in table if x[0] == s] for s in now}
        last = {s: (n - 1) // now[s] * total + at[s][(n - 1) % now[s]] for s, n in left.items()}
        length = min(last.values()) + 1
        out.append(Phase(len(out), start, dict(done), now, table))
        cycles, rest = divmod(length, total)
        for s in now:
            ran = cycles * now[s] + sum(x < rest for x in at[s])
            done[s] += ran
            left[s] -= ran
        left = {s: n for s, n in left.items() if n}
        start += length
    return out


def schedule(df: DataFrame, weights: dict[str, int], id_col: str = "doc_id", source_col: str = "source", other: int = 1,
             block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """id, source, queue, block, phase, slot, release, deadline, position (0 for the first row of the mix) and row (the input row)."""
    if min([other, block_rows, *weights.values()]) < 1:
        raise ValueError("weights and block_rows are whole numbers of at least 1")
    source = F.col(source_col).cast("string")
    key = F.when(source.isin(list(weights)), F.concat(F.lit("="), source)).otherwise(F.lit("other"))
    rows = df.select(F.col(id_col).alias("id"), source.alias("source"), key.alias("queue"), whole_row().alias("row"))
    given = {f"={s}": w for s, w in weights.items()} | {"other": other}
    counts = {r["queue"]: r["count"] for r in rows.groupBy("queue").count().collect()}  # a row a listed source
    plan = phases({s: -(-n // block_rows) for s, n in counts.items()}, {s: given[s] for s in counts})

    rows = rows.withColumn("draw", portable_hash(seed, F.col("id")))
    cells = max(8, -(-sum(counts.values()) // ROWS_PER_CELL), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Ranks by cells of the draw. The join asks for the windows' own partitioning, so the rows are not shuffled again for it.
    rows = rows.withColumn("cell", hash_cell(F.col("draw"), cells))
    before = Window.partitionBy("queue").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("queue", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("queue").alias("s_queue"), F.col("cell").alias("s_cell"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("queue", "cell").orderBy("draw", "id")))
    placed = ranked.join(sizes, (F.col("queue") == F.col("s_queue")) & (F.col("cell") == F.col("s_cell"))).withColumn("rank", F.col("rank") - 1 + F.col("offset"))
    placed = placed.withColumn("block", F.floor(F.col("rank") / block_rows).cast("long"))

    # At most a phase a source, a row for each block of its period: a table of bounded size.
    made = [(p.number, s, p.before[s], p.weights[s], p.start, sum(p.weights.values()), k, r, d, slot)
            for p in plan for s in p.weights for k, (_, r, d, slot) in enumerate(x for x in p.table if x[0] == s)]
    ends = {(p.number, s): plan[p.number + 1].before[s] if p.number + 1 < len(plan) else 1 << 62 for p in plan for s in p.weights}
    kind = "phase int, p_queue string, p_before long, p_weight long, p_start long, p_total long, k long, p_release long, p_deadline long, p_slot long, p_end long"
    table = F.broadcast(df.sparkSession.createDataFrame([(*m, ends[m[0], m[1]]) for m in made], kind))
    local = F.col("block") - F.col("p_before")
    out = placed.join(table, (F.col("queue") == F.col("p_queue")) & (F.col("block") >= F.col("p_before")) & (F.col("block") < F.col("p_end"))
                      & (F.pmod(local, F.col("p_weight")) == F.col("k")))
    base = F.col("p_start") + F.floor(local / F.col("p_weight")).cast("long") * F.col("p_total")
    out = out.withColumns({"slot": base + F.col("p_slot"), "release": base + F.col("p_release"), "deadline": base + F.col("p_deadline")})
    # Every block but the last of each queue is full, so a slot's first row follows from the few short blocks before it.
    short = [(slot_of(plan, s, -(-n // block_rows) - 1), block_rows - n % block_rows) for s, n in counts.items() if n % block_rows]
    lost = F.lit(0)
    for at, missing in short:
        lost = lost + F.when(F.col("slot") > at, missing).otherwise(0)
    out = out.withColumn("position", F.col("slot") * block_rows + F.pmod("rank", F.lit(block_rows)) - lost)
    return out.select("id", "source", "queue", "block", "phase", "slot", "release", "deadline", "position", "row")


def slot_of(plan: list[Phase], source: str, block: int) -> int:
    """The slot of one block."""
    p = [p for p in plan if source in p.weights and p.before[source] <= block][-1]
    local, own = block - p.before[source], [x[3] for x in p.table if x[0] == source]
    return p.start + local // p.weights[source] * sum(p.weights.values()) + own[local % p.weights[source]]


def mix(df: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """The rows in mixed order: part files follow one another by position, and rows within them."""
    placed = schedule(df, weights, **options).select("position", "row")
    return unpack(placed.repartitionByRange("position").sortWithinPartitions("position"))
