"""Words of UTF-8 texts and their 64-bit hashes, by numpy over slices of Arrow's own text buffers.

A word is a run of bytes other than the space and U+0009 to U+000D. No step holds more than about
`PIECE` bytes of text at once besides the hashes of one batch, so very long texts need no more memory than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))))


_TABLES: dict[str, np.ndarray] = {}  # filled once in each process; functions travel to tasks without them


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES.update(up=_powers(_BASE, PIECE + 1), down=_powers(_INV, PIECE + 1))
    return _TABLES["up"], _TABLES["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash, so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word runs over a break."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial over each word's bytes from one running sum, then mixed with the length."""
    up, down = _tables()
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        h = (total[end] - total[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _long_word(data: np.ndarray) -> np.ndarray:
    """A single word longer than a piece."""
    h = np.uint64(len(data))
    for i in range(0, len(data), PIECE):
        part = data[i : i + PIECE]
        h = mix(np.array([h], np.uint64) + _hashes(part, np.array([0]), np.array([len(part)])))[0]
    return np.array([h], np.uint64)


def _one_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, cut at white space."""
    out, at = [], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        if stop < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:
                more = at + PIECE
                while more < len(data) and not _SPACE[data[more]]:
                    more += 1
                out.append(_long_word(data[at:more]))
                at = more
                continue
        part = data[at:stop]
        out.append(_hashes(part, *_spans(part, np.empty(0, int))))
        at = stop
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def word_hashes(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of the column as (first row, word hashes, words before each row of the slice and after the last).

    `texts` is a string array; null counts as empty. `lower` maps A-Z to a-z first.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        part = _LOWER[part] if lower else part
        breaks = offsets[i : j + 1] - offsets[i]
        if len(part) > PIECE:
            h = _one_text(part)
            bounds = np.array([0, len(h)])
        else:
            start, end = _spans(part, breaks)
            h = _hashes(part, start, end)
            bounds = np.searchsorted(start, breaks)
        yield i, h, bounds
        i = j


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words; of all of them where there are fewer than k; none without words."""
    if not len(h):
        return h
    n = min(k, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + h[i : len(h) - n + 1 + i])
    return out
