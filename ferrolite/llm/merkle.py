"""Merkle manifest of a dataset as a postorder append log.

Leaves are hashes of whole rows. Within a group leaves ascend by id; every two consecutive nodes, and a last one alone,
become their hash until one node is left, the group's root. The groups' roots, in the order of the groups, give the dataset's root the same way.

Aligned builders take runs of 2^`HEIGHT` consecutive nodes and append each node to their log when it is complete: leaves in order,
each parent after its children, the ragged right edge last. A node's place follows from subtree sizes alone (`position`), so proofs
read their siblings from the log by address. The runs' roots are the nodes of the next tier; the number of tiers grows with the logarithm of the
largest group. All tiers are tables in the shared folder; a task holds one run at a time, and proofs go down the tiers by joins on the run.

`leaf_hash`: sha-256, in lowercase hex, of the fields one after another, each `-` if null, else its UTF-8 length in bytes, `:` and its value.
Null ids come first and are never tampered with; rows that repeat an id are ordered by their leaves, equal rows are leaves of their own. A null group comes
first, groups are ordered bytewise. An empty table has no roots. Columns other than the hashed ones are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cols import same_keys
from ..functions.ordered import number_rows
from .common import Scratch, small

HEIGHT = 10
NODE = 32  # bytes of a digest
LEFT, RIGHT = b"\x01", b"\x02"  # which side of the node its sibling stands on


def field(name: str) -> Column:
    value = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def join(*digests: bytes) -> bytes:
    """A parent: the hash of its children's digests as lowercase hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels(n: int) -> int:
    """Levels above n nodes until one is left."""
    return max(n - 1, 0).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place in the postorder log of n leaves of the node `index` of a level.

    The 2^level leaves under a full node are written with their last leaf, after the nodes that earlier leaves completed: a prefix of k leaves
    completes 2k - popcount(k) nodes. Nodes of the ragged edge follow when the last leaf is in, lowest first.
    """
    end = (index + 1) << level
    if end <= n:
        last = end - 1
        return 2 * last - last.bit_count() + level
    whole = (n & -n).bit_length() - 1  # levels up to this one have no ragged node
    return 2 * n - n.bit_count() + level - whole - 1


def build(leaves: list[bytes], top: int) -> bytes:
    """The log of one run: nodes in the order in which they are completed, up to level `top`."""
    log, open_ = [], []  # open_: (level, digest) of nodes whose parent is not complete
    for leaf in leaves:
        node, level = leaf, 0
        log.append(node)
        while level < top and open_ and open_[-1][0] == level:
            node, level = join(open_.pop()[1], node), level + 1
            log.append(node)
        open_.append((level, node))
    level, node = open_.pop()
    while level < top:
        node = join(open_.pop()[1], node) if open_ and open_[-1][0] == level else join(node)
        level += 1
        log.append(node)
    return b"".join(log)


def siblings(log: bytes, index: int, n: int, top: int) -> bytes:
    """Proof of one leaf within its run: for each level the side of the sibling and its digest; a zero byte where there is none."""
    out = []
    for level in range(top):
        other = (index >> level) ^ 1
        if other << level < n:
            at = position(level, other, n) * NODE
            out.append((LEFT if index >> level & 1 else RIGHT) + log[at : at + NODE])
        else:
            out.append(b"\x00")
    return b"".join(out)


def _steps(path: bytes):
    """(side, digest) of each level of a path."""
    i = 0
    while i < len(path):
        side = path[i : i + 1]
        yield side, path[i + 1 : i + 1 + NODE] if side != b"\x00" else b""
        i += 1 + NODE * (side != b"\x00")


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for side, other in _steps(path):
        leaf = join(other, leaf) if side == LEFT else join(leaf, other) if side == RIGHT else join(leaf)
    return leaf


def proof_hash(path: bytes) -> str:
    return hashlib.sha256("".join(d.hex() for _, d in _steps(path)).encode()).hexdigest()


def _top(n: int, total: int, height: int) -> int:
    """Levels of a run of n of its group's `total` nodes: all that are left if it is the only one, else the full height."""
    return levels(total) if total <= 1 << height else height


def _builders(height: int):
    def rows(batches):
        for b in batches:
            table = b.to_pydict()
            logs = [build(nodes, _top(len(nodes), total, height)) for nodes, total in zip(table["digests"], table["total"])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("grp", "run", "total")), pa.array([len(x) for x in table["digests"]], pa.int64()), pa.array(logs, pa.binary()),
                                              pa.array([x[-NODE:] for x in logs], pa.binary()), b.column("payload")], names=["grp", "run", "total", "n", "log", "root", "payload"])

    return rows


def _tier(nodes: DataFrame, scratch: Scratch, height: int) -> DataFrame:
    """nodes: (grp, pos, total, digest, payload). Runs with their logs: (grp, run, total, n, log, root, payload of each node)."""
    runs = nodes.groupBy("grp", F.shiftright("pos", height).alias("run")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "digest", "payload"))).alias("held"))  # at most 2^height nodes
    runs = runs.select("grp", "run", "total", F.col("held.digest").alias("digests"), F.col("held.payload").alias("payload"))
    payload = runs.schema["payload"].dataType.simpleString()
    return scratch.save(runs.mapInArrow(_builders(height), f"grp {nodes.schema['grp'].dataType.simpleString()}, run long, total long, n long, log binary, root binary, payload {payload}"))


def _tiers(nodes: DataFrame, scratch: Scratch, height: int) -> list[DataFrame]:
    """All tiers, lowest first; each group of the last has one run."""
    most, out = nodes.agg(F.max("total")).first()[0] or 0, []
    while True:
        out.append(_tier(nodes, scratch, height))
        most = -(-most >> height) if most > 1 else most
        if most <= 1:
            return out
        nodes = out[-1].select("grp", F.col("run").alias("pos"), F.ceil(F.col("total") / (1 << height)).alias("total"), F.col("root").alias("digest"), F.lit(None).cast("int").alias("payload"))


def _paths(height: int):
    """Task function: the path of each node of a run up to its group's root."""

    def rows(batches):
        for b in batches:
            for grp, run, total, n, log, above in zip(*(b.column(c).to_pylist() for c in ("grp", "run", "total", "n", "log", "above"))):
                top = _top(n, total, height)
                yield pa.RecordBatch.from_arrays([pa.array([grp] * n, b.schema.field("grp").type), pa.array([(run << height) + i for i in range(n)], pa.int64()),
                                                  pa.array([siblings(log, i, n, top) + above for i in range(n)], pa.binary())], names=["grp", "pos", "path"])

    return rows


def _with_above(tier: DataFrame, paths: DataFrame | None, keys: dict[str, str]) -> DataFrame:
    """Runs with the path above their root; empty where nothing is above."""
    if paths is None:
        return tier.withColumn("above", F.lit(b""))
    held = paths.select(*[F.col(a).alias(f"a_{a}") for a in keys], F.col("path").alias("above"))
    on = None
    for a, b in keys.items():
        one = tier[b].eqNullSafe(F.col(f"a_{a}"))
        on = one if on is None else on & one
    return tier.join(small(held, paths), on, "left").drop(*[f"a_{a}" for a in keys]).withColumn("above", F.coalesce("above", F.lit(b"")))


def _down(tiers: list[DataFrame], scratch: Scratch, height: int, roots: DataFrame | None) -> DataFrame:
    """The lowest tier's runs with the path above them; `roots` may name the path above each group's root (pos: the group's)."""
    paths = None
    for i, tier in enumerate(reversed(tiers)):
        above = _with_above(tier, paths, {"grp": "grp", "pos": "run"}) if i else _with_above(tier, roots, {"name": "grp"} if roots is not None else {})
        if i + 1 == len(tiers):
            return above
        kind = f"grp {tier.schema['grp'].dataType.simpleString()}, pos long, path binary"
        paths = scratch.save(above.mapInArrow(_paths(height), kind))
    raise ValueError("no tiers")


def _proofs(height: int):
    names = ["id", "leaf", "subroot", "root", "log_position", "proof_sha256", "folded_root", "verified"]

    def rows(batches):
        for b in batches:
            for run, total, n, log, payload, above, subroot, root in zip(*(b.column(c).to_pylist() for c in ("run", "total", "n", "log", "payload", "above", "subroot", "whole"))):
                top, out = _top(n, total, height), []
                for i, p in enumerate(payload):
                    path = siblings(log, i, n, top) + above
                    at = position(0, i, n) * NODE
                    leaf, place = log[at : at + NODE], (run << height) + i
                    folded = fold(p["tampered"] or leaf, path)
                    out.append((p["id"], leaf.hex(), subroot.hex(), root.hex(), position(0, place, total), proof_hash(path), folded.hex(), folded == root))
                kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), *[pa.string()] * 2, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows


def prove(leaves: DataFrame, scratch: Scratch, height: int = HEIGHT) -> DataFrame:
    """leaves: (grp, id, leaf hex, tampered hex or null). One row per leaf: id, leaf, subroot, root, log_position (of the leaf in its group's whole log),
    proof_sha256, folded_root (from the tampered leaf if there is one) and verified."""
    kept = scratch.save(leaves.select("grp", "id", F.unhex("leaf").alias("digest"), F.unhex("tampered").alias("tampered"), F.monotonically_increasing_id().alias("place")))
    nodes = number_rows(kept, ["id", "digest", "place"], "grp", total="total").select(
        "grp", "pos", "total", "digest", F.struct("id", "tampered").alias("payload"))
    tiers = _tiers(nodes, scratch, height)
    tops = tiers[-1].select(F.col("grp").alias("name"), F.col("root").alias("subroot"))
    order = scratch.save(number_rows(tops, ["name"], total="total").select(F.lit(0).alias("grp"), "pos", "total", F.col("subroot").alias("digest"), F.col("name").alias("payload")))
    upper = _tiers(order, scratch, height)
    whole = upper[-1].select(F.col("root").alias("whole"))
    lowest = _down(upper, scratch, height, None)
    over = scratch.save(lowest.mapInArrow(_paths(height), "grp int, pos long, path binary"))
    named = order.select(F.col("payload").alias("name"), F.col("pos").alias("o_pos"), F.col("digest").alias("subroot"))
    roots = scratch.save(named.join(over, F.col("o_pos") == F.col("pos")).select("name", "subroot", "path"))
    runs = same_keys(_down(tiers, scratch, height, roots), roots.select(F.col("name").alias("grp"), "subroot"), "grp")
    runs = runs.crossJoin(F.broadcast(whole))  # one row
    return runs.mapInArrow(_proofs(height), "id long, leaf string, subroot string, root string, log_position long, proof_sha256 string, folded_root string, verified boolean")
