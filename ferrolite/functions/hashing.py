"""Hash-based randomness: every draw is a function of a row's key, never of its partition."""

from pyspark.sql import Column, functions as F

HASH_SPACE = 1 << 32


def _col(c):
    return c if isinstance(c, Column) else F.col(c)


def portable_hash(seed, *cols) -> Column:
    """32-bit hash of the key columns as LONG; any SQL engine with md5 can compute it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def unit_draw(seed, *cols) -> Column:
    """Uniform draw in [0, 1) per key."""
    return portable_hash(seed, *cols) / F.lit(float(HASH_SPACE))


def hash_cell(h: Column, n: int) -> Column:
    """Equal slices of the hash space; non-decreasing in the hash."""
    return F.floor(h / F.lit(float(HASH_SPACE) / n)).cast("long")
