"""Hashed character n-grams of texts, by numpy."""

from __future__ import annotations

import numpy as np

BITS = 18
SIZES = (3, 4, 5)
PIECE = 1 << 19
_MUL = np.uint32(0x9E3779B1)
_TABLES: dict[str, np.ndarray] = {}  # filled once in each process


def _hashed(c: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of the code points c."""
    out = []
    with np.errstate(over="ignore"):
        h = c * _MUL
        for n in range(2, SIZES[-1] + 1):
            if len(c) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[n - 1 :] * _MUL
            if n in SIZES:
                x = h ^ (h >> np.uint32(16))
                out.append(((x * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _table() -> np.ndarray:
    if "stamp" not in _TABLES:
        _TABLES["stamp"] = np.zeros(1 << BITS, np.int32)
    return _TABLES["stamp"]


def distinct(idx: np.ndarray) -> np.ndarray:
    """Each bucket once; the stamp table needs no clearing between texts."""
    stamp = _table()
    order = np.arange(len(idx), dtype=np.int32)
    stamp[idx] = order
    return idx[stamp[idx] == order]


def buckets(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text in lower case, with a space put before and after; long texts go piece by piece."""
    c = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    found = [distinct(_hashed(c[i : i + PIECE + SIZES[-1] - 1])) for i in range(0, len(c), PIECE)]
    return found[0] if len(found) == 1 else distinct(np.concatenate(found))
