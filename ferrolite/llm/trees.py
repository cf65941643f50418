"""Trees of Spark ML read off as paths and written as column expressions or SQL text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

#: (feature number, is it "at most"?, threshold)
Test = tuple[int, bool, float]


def paths(tree) -> list[tuple[list[Test], float]]:
    """Every node of a regression or classification tree of Spark ML but the root: the tests on its way, and its prediction (nan inside)."""
    out, stack = [], []
    for line in tree.toDebugString.splitlines()[1:]:
        depth = len(line) - len(line.lstrip())
        stack = [s for s in stack if s[0] < depth]
        if m := re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+|NaN|-?Infinity)\)", line):
            stack.append((depth, (int(m[2]), m[3] == "<=", float(m[4]))))
            out.append(([s[1] for s in stack], float("nan")))
        elif m := re.match(r"\s*Predict: ([-0-9.eE]+)", line):
            out.append(([s[1] for s in stack], float(m[1])))
    return out


def leaves(tree) -> list[tuple[list[Test], float]]:
    return [(tests, value) for tests, value in paths(tree) if value == value]


def holds(tests: list[Test], columns: list[Column]) -> Column:
    """All tests of a path."""
    return reduce(lambda a, b: a & b, [columns[f] <= F.lit(t) if low else columns[f] > F.lit(t) for f, low, t in tests])


def tree_sql(tree, features: str) -> str:
    """A tree's prediction as SQL text over an array of features: one comparison a level, parsed in one piece however many trees there are."""
    lines = iter([line.strip() for line in tree.toDebugString.splitlines()[1:]])

    def node() -> str:
        line = next(lines)
        if m := re.match(r"Predict: (\S+)", line):
            return f"{float(m[1])!r}D"
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        low = node()
        next(lines)  # the other branch's own line says the opposite
        return f"IF({features}[{m[1]}] <= {float(m[2])!r}D, {low}, {node()})"

    return node()


def margin_sql(trees, weights, features: str) -> str:
    """The weighted sum of the trees, in their order."""
    return " + ".join(["0.0D", *[f"{tree_sql(t, features)} * {float(w)!r}D" for t, w in zip(trees, weights)]])
