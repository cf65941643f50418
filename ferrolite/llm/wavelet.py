"""Token ids as one wavelet matrix per shard: bit-planes with rank and select, in one compressed file.

`write` encodes texts with the tokenizers library, appends an end id to each document, and lays the ids of all
documents out in ascending order of id. Rows are dealt by ranges of (id, input place), so that ranges follow one another and a repeated
id is cut like any other; a task fills shard after shard of about `SHARD_TOKENS` ids and writes a file for each. Files have names
of their own; the manifest, a Parquet table whose commit takes one attempt of each task, says which files count.

A file holds, for each bit from the highest, the plane of that bit over the ids as the planes above have sorted them
(zeros before ones, stable). Planes are cut into blocks, compressed one by one where that makes them smaller; a directory at the end has
the place of each block, the ones before it, the zeros of each plane, and the documents' ids and lengths. `Matrix` answers from the blocks it
needs: `access` (ids at positions), `rank` and `count` (occurrences of an id up to a position), `select` and `find` (positions of an id), `all`.
`read`, `count`, `find` and `lookup` ask all files of a manifest as Spark jobs; positions count from the first id of the first shard.

Null texts count as empty: the end id alone. Null ids come first. Rows that repeat an id are documents of their own, in the input's
order. Text that looks like a special token is ordinary text. A document is never cut, so a shard may be as large as the longest one; 2 or 4 bytes a token are
held in memory, and a little more while one shard is built. An empty table gives an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ordered import running
from .bpe import byte_characters
from .common import Scratch, held, text_of

MAGIC = b"WVMATRX1"
SHARD_TOKENS = 1 << 20
TASK_BYTES = 32 << 20
TASK_FILES = 4
STEP = 1 << 15
BLOCK_BYTES = 1 << 14
BLOCK_BITS = BLOCK_BYTES * 8
HELD_BLOCKS = 128
PIECES = 1 << 16
KNOWN = 1 << 19
LOW = 0x2070
ANSWERS = 1 << 16
MANIFEST = "part long, seq long, path string, docs long, tokens long"
assert sys.byteorder == "little", "packed ids are written in the machine's own layout"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def plain_pattern(pattern: str) -> str:
    """The pattern with \\p{L}, \\p{N}, \\s and \\S written out for code points below `LOW`, as the built-in `re` is faster but lacks them."""
    import regex

    def ranges(name: str) -> str:
        inside = [bool(regex.match(name, chr(i))) for i in range(LOW)] + [False]
        edges = [i for i in range(LOW + 1) if inside[i] != (inside[i - 1] if i else False)]
        return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2]))

    out, i, listed = "", 0, False
    while i < len(pattern):
        name = regex.match(r"\\p\{\w+\}|\\[sS]", pattern[i:])
        if name:
            out += ranges(name[0]) if listed else f"[{ranges(name[0])}]"
        elif pattern[i] == "\\":
            raise ValueError(f"unknown class in {pattern!r}")
        else:
            out += pattern[i]
            listed = pattern[i] == "[" or listed and pattern[i] != "]"
        i += len(name[0]) if name else 1
    return out


class Pieces(dict):
    """Packed ids of the pieces met so far, in two generations of bounded size; a new piece goes through the library's model."""

    def __init__(self, made: str, kind: str, size: int):
        from tokenizers import Tokenizer

        self.tokenize, self.older, self.to = Tokenizer.from_str(made).model.tokenize, {}, dict(enumerate(byte_characters()))
        self.packed = [i.tobytes() for i in np.arange(size, dtype=kind)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            packed = self.packed
            ids = b"".join([packed[t.id] for t in self.tokenize((piece if piece.isascii() else piece.encode().decode("latin-1")).translate(self.to))])
        if len(self) >= KNOWN:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts, packed, by a tokenizer file of the library; each match of the pattern is encoded by itself, as the file's own splitting does."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            self.made = f.read()
        self.pattern, self.plain = pattern, plain_pattern(pattern)
        self.size = 1 + max(json.loads(self.made)["model"]["vocab"].values())
        self.bits = max(1, (self.size - 1).bit_length())
        self.kind = "<u2" if self.bits <= 16 else "<u4"

    def __call__(self, texts):
        import regex

        any_text, plain_text, high = regex.compile(self.pattern), re.compile(self.plain), re.compile(f"[^\\x00-\\u{LOW - 1:04x}]")
        key = f"pieces {zlib.crc32(self.made.encode())}"
        tables = held("wavelet")
        if key not in tables:
            tables[key] = Pieces(self.made, self.kind, self.size)
        known = tables[key]
        ids_of = known.__getitem__
        for text in texts:
            split = plain_text if text.isascii() or not high.search(text) else any_text
            if len(text) <= PIECES:
                data = b"".join(map(ids_of, split.findall(text)))
            else:
                out, matches = [], split.finditer(text)
                while part := b"".join([ids_of(m[0]) for m in islice(matches, PIECES)]):
                    out.append(part)
                data = b"".join(out)
            yield np.frombuffer(data, self.kind)


def places(set_: np.ndarray, zeros: int):
    """For each stretch of a plane, short enough for a core's own cache: where it begins, its zeros and ones within it, and where they go below the plane."""
    zero, one = 0, zeros
    for a in range(0, len(set_), STEP):
        part = set_[a : a + STEP]
        none, some = np.flatnonzero(~part), np.flatnonzero(part)
        yield a, none, some, slice(zero, zero + len(none)), slice(one, one + len(some))
        zero, one = zero + len(none), one + len(some)


def planes(ids: np.ndarray, bits: int):
    """(packed bits, number of zeros) of each plane, highest bit first."""
    for bit in reversed(range(bits)):
        set_ = (ids & ids.dtype.type(1 << bit)) != 0
        zeros = len(ids) - int(np.count_nonzero(set_))
        yield np.packbits(set_, bitorder="little"), zeros
        lower = np.empty_like(ids)
        for a, none, some, to_zeros, to_ones in places(set_, zeros):
            part = ids[a : a + STEP]
            lower[to_zeros], lower[to_ones] = part.take(none), part.take(some)
        ids = lower


def store(out, ids: np.ndarray, bits: int, doc_ids: list, lengths: list[int]) -> None:
    """Write one file: blocks of all planes, then the directory, its length and the magic."""
    import zstandard

    small, at = zstandard.ZstdCompressor(level=1), len(MAGIC)
    out.write(MAGIC)
    starts, before, zeros = [], [], []
    for packed, none in planes(ids, bits):
        zeros.append(none)
        ones = 0
        for i in range(0, len(packed), BLOCK_BYTES):
            block = packed[i : i + BLOCK_BYTES]
            starts.append(at)
            before.append(ones)
            ones += int(_ONES[block].sum())
            raw = block.tobytes()
            data = small.compress(raw)
            data = data if len(data) < len(raw) else raw
            out.write(data)
            at += len(data)
    starts.append(at)
    head = json.dumps({"tokens": len(ids), "bits": bits, "docs": len(lengths), "zeros": zeros, "wide": ids.dtype.itemsize}).encode()
    parts = [np.array(starts, "<u8"), np.array(before, "<u8"), np.array(lengths, "<u8"), np.array([i or 0 for i in doc_ids], "<i8"), np.array([i is None for i in doc_ids], "u1")]
    directory = zstandard.ZstdCompressor(level=3).compress(struct.pack("<Q", len(head)) + head + b"".join(p.tobytes() for p in parts))
    out.write(directory + struct.pack("<Q", len(directory)) + MAGIC)


class Matrix:
    """One file, read block by block. `file` is open for random access (size, seek, read)."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpack, self.held = file, zstandard.ZstdDecompressor(), {}
        tail = self._at(file.size() - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = struct.unpack("<Q", tail[:8])[0]
        data = self.unpack.decompress(self._at(file.size() - 16 - size, size))
        n = struct.unpack("<Q", data[:8])[0]
        head, at = json.loads(data[8 : 8 + n]), 8 + n
        self.tokens, self.bits, self.zeros, docs = head["tokens"], head["bits"], head["zeros"], head["docs"]
        self.kind = {2: np.uint16, 4: np.uint32}[head["wide"]]
        self.blocks = -(-self.tokens // BLOCK_BITS)  # of each plane

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.starts = take("<u8", self.blocks * self.bits + 1)
        self.before = take("<u8", self.blocks * self.bits).astype(np.int64).reshape(self.bits, self.blocks)
        self.lengths, ids, null = take("<u8", docs).astype(np.int64), take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if m else int(i) for i, m in zip(ids, null)]

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _packed(self, plane: int, block: int) -> np.ndarray:
        i = plane * self.blocks + block
        size = -(-min(BLOCK_BITS, self.tokens - block * BLOCK_BITS) // 8)
        data = self._at(int(self.starts[i]), int(self.starts[i + 1] - self.starts[i]))
        return np.frombuffer(data if len(data) == size else self.unpack.decompress(data, max_output_size=size), np.uint8)

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a block, and the ones of its plane before each byte; the last blocks asked for are kept."""
        key = (plane, block)
        if key not in self.held:
            if len(self.held) >= HELD_BLOCKS:
                self.held.pop(next(iter(self.held)))
            packed = self._packed(plane, block)
            ones = np.cumsum(_ONES[packed], dtype=np.int64)
            self.held[key] = packed, self.before[plane, block] + np.concatenate(([0], ones[:-1]))
        return self.held[key]

    def _bit_and_rank(self, plane: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit at each position of a plane (0 past the end), and the ones before it."""
        bit, rank = np.zeros(len(at), bool), np.zeros(len(at), np.int64)
        past = at >= self.tokens
        rank[past] = self.tokens - self.zeros[plane]
        blocks = np.where(past, -1, at // BLOCK_BITS)
        for b in np.unique(blocks[~past]):
            here = np.flatnonzero(blocks == b)
            packed, before = self._block(plane, int(b))
            off = at[here] - b * BLOCK_BITS
            byte, low = packed[off >> 3], (off & 7).astype(np.uint8)
            bit[here] = (byte >> low) & 1
            rank[here] = before[off >> 3] + _ONES[byte & ((1 << low) - 1).astype(np.uint8)]
        return bit, rank

    def access(self, at) -> np.ndarray:
        """Ids at positions."""
        at = np.asarray(at, np.int64)
        if len(at) and not 0 <= at.min() <= at.max() < self.tokens:
            raise IndexError("position outside the shard")
        ids = np.zeros(len(at), self.kind)
        for plane in range(self.bits):
            bit, rank = self._bit_and_rank(plane, at)
            ids = (ids << 1) | bit.astype(self.kind)
            at = np.where(bit, self.zeros[plane] + rank, at - rank)
        return ids

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        """Where the occurrences of an id before position `upto` lie in the order below the last plane."""
        ends = np.array([0, upto], np.int64)
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        for plane in range(self.bits):
            _, rank = self._bit_and_rank(plane, ends)
            ends = self.zeros[plane] + rank if token >> (self.bits - 1 - plane) & 1 else ends - rank
        return int(ends[0]), int(ends[1])

    def rank(self, token: int, upto: int) -> int:
        """Occurrences of an id before a position."""
        low, high = self._range(token, upto)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def _select(self, plane: int, one: bool, k: np.ndarray) -> np.ndarray:
        """Position of the k-th one or zero (from 0) of a plane."""
        ends = np.minimum(np.arange(self.blocks, dtype=np.int64) * BLOCK_BITS, self.tokens)
        before = self.before[plane] if one else ends - self.before[plane]
        blocks, out = np.searchsorted(before, k, "right") - 1, np.empty(len(k), np.int64)
        for b in np.unique(blocks):
            here = np.flatnonzero(blocks == b)
            size = min(BLOCK_BITS, self.tokens - int(b) * BLOCK_BITS)
            set_ = np.unpackbits(self._block(plane, int(b))[0], count=size, bitorder="little") == one
            out[here] = b * BLOCK_BITS + np.flatnonzero(set_)[k[here] - before[b]]
        return out

    def select(self, token: int, k) -> np.ndarray:
        """Positions of the k-th occurrences (from 0) of an id."""
        low, high = self._range(token, self.tokens)
        at = low + np.asarray(k, np.int64)
        if len(at) and not low <= at.min() <= at.max() < high:
            raise IndexError("fewer occurrences than asked for")
        for plane in reversed(range(self.bits)):
            one = bool(token >> (self.bits - 1 - plane) & 1)
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def find(self, token: int):
        """Positions of an id in ascending order, some at a time."""
        n = self.count(token)
        for i in range(0, n, ANSWERS):
            yield self.select(token, np.arange(i, min(n, i + ANSWERS)))

    def all(self) -> np.ndarray:
        """All ids: from the lowest plane up, each plane puts values back where they were before it sorted them."""
        ids = np.zeros(self.tokens, self.kind)
        for plane in reversed(range(self.bits)):
            packed = np.concatenate([self._packed(plane, b) for b in range(self.blocks)]) if self.blocks else np.empty(0, np.uint8)
            set_ = np.unpackbits(packed, count=self.tokens, bitorder="little").view(bool)
            upper, zeros = np.empty_like(ids), self.zeros[plane]
            ids[zeros:] |= self.kind(1 << (self.bits - 1 - plane))
            for a, none, some, from_zeros, from_ones in places(set_, zeros):
                part = upper[a : a + STEP]
                part[none], part[some] = ids[from_zeros], ids[from_ones]
            ids = upper
        return ids


def _shards(base: str, encoder: Encoder, end_id: int, shard_tokens: int):
    """Task function: encode the rows of a task in their order, write shards, and name them."""

    def rows(batches):
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        fs, root = FileSystem.from_uri(base)
        part, end, seq, held = TaskContext.get().partitionId(), np.array([end_id], encoder.kind), 0, []

        def done():
            name = f"{uuid.uuid4().hex}.wvm"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                store(out, np.concatenate([x for _, i in held for x in (i, end)]), encoder.bits, [d for d, _ in held], [len(i) + 1 for _, i in held])
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "path": [f"{base}/{name}"], "docs": [len(held)], "tokens": [sum(len(i) + 1 for _, i in held)]})

        n = 0
        for b in batches:
            for doc, ids in zip(b.column("id").to_pylist(), encoder(x.as_py() for x in b.column("text"))):
                held.append((doc, ids))
                n += len(ids) + 1
                if n >= shard_tokens:
                    yield done()
                    seq, n, held = seq + 1, 0, []
        if held:
            yield done()

    return rows


def write(docs: DataFrame, base: str, scratch: Scratch, tokenizer: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards under the folder `base`, which all executors share; returns their manifest (path, docs, tokens, start)."""
    spark, encoder = docs.sparkSession, Encoder(tokenizer, pattern)
    if not 0 <= end_id < 1 << encoder.bits:
        raise ValueError(f"end id {end_id} does not fit the vocabulary's {encoder.bits} bits")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(tasks, F.col("id").asc_nulls_first(), "place")
    dealt = dealt.sortWithinPartitions(F.col("id").asc_nulls_first(), "place").drop("place")
    made = scratch.save(dealt.mapInArrow(_shards(base, encoder, end_id, shard_tokens), MANIFEST))
    upto = running(made, ["part", "seq"], sums={"upto": F.col("tokens")})
    return scratch.save(upto.select("path", "docs", "tokens", (F.col("upto") - F.col("tokens")).alias("start")))


def _over_files(spark: SparkSession, manifest: DataFrame, answer, kind: str) -> DataFrame:
    """Ask each file of a manifest; `answer(matrix, start)` yields record batches. A task opens some files, one after another, as starting it costs as much as reading one."""

    def rows(batches):
        from pyarrow.fs import FileSystem

        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, name = FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    yield from answer(Matrix(file), start)

    tasks = max(spark.sparkContext.defaultParallelism, -(-manifest.count() // TASK_FILES))
    return manifest.select("path", "start").repartition(tasks, "path").mapInArrow(rows, kind)


def read(spark: SparkSession, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as unsigned 32-bit integers) and, if asked for, ids in that packing, of every document."""

    def answer(matrix: Matrix, start: int):
        found, ends = matrix.all(), np.cumsum(matrix.lengths)
        first = 0
        while first < len(ends):
            low = int(ends[first] - matrix.lengths[first])
            last = max(first + 1, int(np.searchsorted(ends, low + SHARD_TOKENS, "right")))
            flat = found[low : int(ends[last - 1])].astype("<u4")
            cuts = (ends[first:last] - low).tolist()
            parts = [flat[a:b].tobytes() for a, b in zip([0, *cuts], cuts)]
            out = {"doc_id": pa.array(matrix.doc_ids[first:last], pa.int64()), "start": pa.array(start + low + np.array([0, *cuts[:-1]], np.int64)),
                   "n_tokens": pa.array(matrix.lengths[first:last]), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64())}
            yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(parts, pa.binary())} if ids else {}))
            first = last

    return _over_files(spark, manifest, answer, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def count(spark: SparkSession, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences of the listed ids in all shards, from ranks alone."""
    tokens = list(dict.fromkeys(tokens))

    def answer(matrix: Matrix, start: int):
        yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "n": pa.array([matrix.count(t) for t in tokens], pa.int64())})

    return _over_files(spark, manifest, answer, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find(spark: SparkSession, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, position, doc_id, offset): every occurrence of the listed ids and the document that holds it, by select."""
    tokens = list(dict.fromkeys(tokens))

    def answer(matrix: Matrix, start: int):
        ends = np.cumsum(matrix.lengths)
        for t in tokens:
            for at in matrix.find(t):
                doc = np.searchsorted(ends, at, "right")
                yield pa.RecordBatch.from_pydict({"token": pa.array(np.full(len(at), t, np.int64)), "position": pa.array(start + at), "doc_id": pa.array([matrix.doc_ids[i] for i in doc], pa.int64()),
                                                  "offset": pa.array(at - (ends - matrix.lengths)[doc])})

    return _over_files(spark, manifest, answer, "token long, position long, doc_id long, offset long")


def lookup(spark: SparkSession, manifest: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """(position, token): the id at each listed position, by ranks. Positions outside are not in the result."""
    cell = lambda c: F.floor(c / F.lit(SHARD_TOKENS)).cast("long")
    spans = manifest.where("tokens > 0").select("path", "start", (F.col("start") + F.col("tokens")).alias("end"))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end") - 1))))
    asked = positions.select(F.col(position_col).cast("long").alias("position")).withColumn("cell", cell(F.col("position")))
    met = asked.join(spans, "cell").where("position >= start AND position < end").select("path", "start", "position")

    def rows(batches):
        from pyarrow.fs import FileSystem

        opened, file, matrix = None, None, None
        for b in batches:
            table = b.to_pydict()
            paths, at = np.array(table["path"], object), np.array(table["position"], np.int64) - np.array(table["start"], np.int64)
            cuts = [0, *(np.flatnonzero(paths[1:] != paths[:-1]) + 1).tolist(), len(paths)] if len(paths) else [0]
            for a, e in zip(cuts, cuts[1:]):
                if paths[a] != opened:
                    if file is not None:
                        file.close()
                    fs, name = FileSystem.from_uri(paths[a])
                    opened, file = paths[a], fs.open_input_file(name)
                    matrix = Matrix(file)
                yield pa.RecordBatch.from_pydict({"position": pa.array(table["position"][a:e], pa.int64()), "token": pa.array(matrix.access(at[a:e]).astype(np.int64))})
        if file is not None:
            file.close()

    return met.repartitionByRange("path", "position").sortWithinPartitions("path", "position").mapInArrow(rows, "position long, token long")
