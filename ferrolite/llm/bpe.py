"""Byte-level BPE with the tokenizers library over Arrow batches.

The vocabulary is a file of ranks (base64 token, rank). Bytes are mapped to printable characters, merges are read
off the ranks, and each match of the splitting pattern is encoded by itself. Nothing is trained, no special tokens
are added, and text that looks like one is ordinary text.

`encode` adds the ids (packed as little-endian unsigned 32-bit integers, the layout of training shards), their number
and, on request, the first and last code point of each token, a token that holds part of a character covering the whole character.
`decode` maps ids back through the byte table and joins bytes before it reads characters, so that characters split
over tokens are whole again; bytes that are no UTF-8 (a cut sequence of ids) become U+FFFD in the text column only.

Null texts count as empty: no ids, empty bytes. Other columns pass through; columns named like an output are replaced.
Ids outside the vocabulary, or packed ids whose length is no multiple of four, raise an error. Texts go in chunks
of about `CHUNK` characters; one text is never cut, as cuts could change its tokens.
"""

from __future__ import annotations

import base64
import json
import sys
from array import array
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import held, small_batches

CHUNK = 1 << 19
PIECES = 1 << 16
KNOWN = 1 << 18
assert array("I").itemsize == 4 and sys.byteorder == "little", "packed ids are written in the machine's own layout"
LONG = 64  # code points; longer pieces are not remembered


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank; a rank that the file skips is an error."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in f if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def _parts(token: bytes, rank: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens that merge last into `token`: merge lower ranks only, lowest first, leftmost first."""
    parts, own = [token[i : i + 1] for i in range(len(token))], rank[token]
    while len(parts) > 2:
        r, i = min((rank.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if r >= own:
            raise ValueError(f"token {own} cannot be made by merges")
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer_json(tokens: list[bytes], pattern: str) -> str:
    """A tokenizer of the library for these ranks, as its own JSON."""
    to = byte_characters()
    name = lambda b: "".join(to[x] for x in b)
    rank = {t: i for i, t in enumerate(tokens)}
    merges = [[name(p) for p in _parts(t, rank)] for t in tokens if len(t) > 1]
    steps = [{"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
             {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]
    return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                       "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}, "post_processor": None,
                       "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
                       "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                                 "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                                 "vocab": {name(t): i for i, t in enumerate(tokens)}, "merges": merges}})


def _tokenizer(made: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    kept, key = held("bpe"), f"model {crc32(made.encode())}"
    if key not in kept:
        kept[key] = Tokenizer.from_str(made)
    return kept[key]


def _chunks(texts: list[str]):
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= CHUNK):
            n += len(texts[j])
            j += 1
        yield texts[i:j]
        i = j


class Encoder:
    """What encode() runs in tasks.

    Ids without offsets come from a split by the pattern and a bounded memory of the pieces' ids, as most pieces
    are met many times; the library encodes each new piece. With offsets the library encodes whole texts.
    """

    def __init__(self, made: str, pattern: str):
        self.made, self.pattern = made, pattern

    def packed(self, texts: list[str]):
        """Ids of each text as little-endian unsigned 32-bit integers."""
        import regex

        find, model = regex.compile(self.pattern).finditer, _tokenizer(self.made).model
        known = held("bpe").setdefault(f"pieces {crc32(self.made.encode())}", {})
        to = dict(enumerate(byte_characters()))
        for text in texts:
            out, matches = [], find(text)
            while pieces := [m[0] for m in islice(matches, PIECES)]:
                if fresh := {p for p in pieces if p not in known}:
                    if len(known) > KNOWN:
                        known.clear()
                        fresh = set(pieces)
                    for p in fresh:
                        known[p] = array("I", [t.id for t in model.tokenize(p.encode().decode("latin-1").translate(to))]).tobytes()
                out += [known[p] for p in pieces]
                for p in fresh:
                    if len(p) > LONG:
                        del known[p]
            yield b"".join(out)

    def with_offsets(self, texts: list[str]):
        tok = _tokenizer(self.made)
        for part in _chunks(texts):
            for e in tok.encode_batch(part, add_special_tokens=False):
                yield np.array(e.ids, np.uint32), np.array(e.offsets, np.int32).reshape(-1, 2)


def _map(df: DataFrame, source: str, make, added: list[T.StructField], drop_source: bool = False) -> DataFrame:
    """Replace or append columns computed from one column, batch by batch."""
    small_batches(df.sparkSession)
    names = [f.name for f in added]
    keep = [f for f in df.schema.fields if f.name not in names and not (drop_source and f.name == source)]
    if source in names:
        raise ValueError(f"{source} would be overwritten")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(f.name)) for f in keep] + make(b.column(b.schema.get_field_index(source))),
                                             names=[f.name for f in keep] + names)

    return df.mapInArrow(run, T.StructType([*keep, *added]))


def encode(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", offsets: bool = False) -> DataFrame:
    """Add ids (binary, uint32 little-endian), n_tokens and, if asked for, starts and ends (code points, as packed int32)."""
    encoder = Encoder(tokenizer_json(read_ranks(ranks), pattern), pattern)
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    added += [T.StructField(c, T.BinaryType()) for c in ("starts", "ends")] * offsets

    def make(column):
        texts = [x or "" for x in column.to_pylist()]
        if offsets:
            rows = [(len(i), i.astype("<u4").tobytes(), o[:, 0].astype("<i4").tobytes(), o[:, 1].astype("<i4").tobytes()) for i, o in encoder.with_offsets(texts)]
        else:
            rows = [(len(x) // 4, x) for x in encoder.packed(texts)]
        kinds = [pa.int64()] + [pa.binary()] * (len(added) - 1)
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

    return _map(df.withColumn(text_col, F.col(text_col).cast("string")), text_col, make, added)


def byte_table(tokens: list[bytes]) -> tuple[bytes, bytes]:
    """All tokens' bytes after one another, and where each starts (uint32), the end included."""
    ends = np.cumsum([0] + [len(t) for t in tokens])
    return b"".join(tokens), ends.astype("<u4").tobytes()


def join_bytes(ids: np.ndarray, table: np.ndarray, at: np.ndarray) -> bytes:
    """Bytes of a sequence of ids."""
    if not len(ids):
        return b""
    if int(ids.max()) >= len(at) - 1:
        raise ValueError(f"id {int(ids.max())} is outside the vocabulary")
    start, size = at[ids].astype(np.int64), (at[ids + 1] - at[ids]).astype(np.int64)
    first = np.cumsum(size) - size
    return table[np.arange(int(size.sum())) - np.repeat(first - start, size)].tobytes()


def decode(df: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """Add decoded (binary): the bytes of packed ids; null where the ids are null."""
    flat, ends = byte_table(read_ranks(ranks))

    def make(column):
        table, at = np.frombuffer(flat, np.uint8), np.frombuffer(ends, "<u4")
        return [pa.array([None if x is None else join_bytes(np.frombuffer(x, "<u4"), table, at) for x in column.to_pylist()], pa.binary())]

    return _map(df, ids_col, make, [T.StructField("decoded", T.BinaryType())])


def round_trip(df: DataFrame, ranks: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The other columns, n_tokens, ids and decoded: encode() and decode() in one pass of one worker, which hands the text no further."""
    tokens = read_ranks(ranks)
    encoder, (flat, ends) = Encoder(tokenizer_json(tokens, pattern), pattern), byte_table(tokens)
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]

    def make(column):
        table, at = np.frombuffer(flat, np.uint8), np.frombuffer(ends, "<u4")
        ids = list(encoder.packed(x.as_py() or "" for x in column))
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([join_bytes(np.frombuffer(x, "<u4"), table, at) for x in ids], pa.binary())]

    return _map(df.withColumn(text_col, F.col(text_col).cast("string")), text_col, make, added, drop_source=True)


def as_text(decoded: Column) -> Column:
    """Decoded bytes as a string; bytes that are no UTF-8 become U+FFFD."""
    return F.make_valid_utf8(decoded.cast("string"))
