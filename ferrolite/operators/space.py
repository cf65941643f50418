"""Search spaces as column expressions: a draw is a function of (seed, label, index).

A space maps labels to distributions (plain dicts). A `choice` whose options
are a dict opens a sub-space per option; its labels become `label__option__sub`
and are null for draws that took another branch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import HASH_SPACE, portable_hash


def choice(*options) -> dict:
    """Literals, or one dict {name: sub-space}."""
    opts = options[0] if len(options) == 1 and isinstance(options[0], dict) else list(options)
    return {"dist": "choice", "options": opts}


def pchoice(*pairs) -> dict:
    """(probability, literal) pairs."""
    return {"dist": "pchoice", "pairs": list(pairs)}


def uniform(low, high) -> dict:
    return {"dist": "uniform", "low": low, "high": high}


def quniform(low, high, q) -> dict:
    return {"dist": "quniform", "low": low, "high": high, "q": q}


def loguniform(low, high) -> dict:
    """exp(U(low, high)): the bounds are logarithms."""
    return {"dist": "loguniform", "low": low, "high": high}


def qloguniform(low, high, q) -> dict:
    return {"dist": "qloguniform", "low": low, "high": high, "q": q}


def randint(low, high) -> dict:
    """low <= value < high."""
    return {"dist": "randint", "low": low, "high": high}


def integer(low, high) -> dict:
    """low <= value <= high."""
    return {"dist": "int", "low": low, "high": high}


def discrete_uniform(low, high, q) -> dict:
    return {"dist": "discrete_uniform", "low": low, "high": high, "q": q}


def normal(mu, sigma) -> dict:
    return {"dist": "normal", "mu": mu, "sigma": sigma}


def lognormal(mu, sigma) -> dict:
    return {"dist": "lognormal", "mu": mu, "sigma": sigma}


@dataclass(frozen=True)
class Leaf:
    """One column of draws; `branch` lists the (label, option) choices it depends on."""

    label: str
    dist: dict
    branch: tuple[tuple[str, str], ...] = ()

    @property
    def name(self) -> str:
        return self.label.split("__")[-1]


def leaves(spec: dict, prefix: str = "", branch: tuple = ()) -> list[Leaf]:
    out = []
    for label, dist in spec.items():
        path = f"{prefix}{label}"
        out.append(Leaf(path, dist, branch))
        if dist["dist"] == "choice" and isinstance(dist["options"], dict):
            for option, sub in dist["options"].items():
                out += leaves(sub, f"{path}__{option}__", (*branch, (path, option)))
    return out


def _unit(seed, label: str, index: Column) -> Column:
    return portable_hash(f"{seed}|{label}", index) / F.lit(float(HASH_SPACE))


def draw(dist: dict, label: str, index: Column, seed) -> Column:
    """Inverse-CDF expression of one hashed uniform draw (two for normal ones)."""
    u, kind = _unit(seed, label, index), dist["dist"]
    if kind == "choice":
        options = list(dist["options"])
        return F.array(*[F.lit(o) for o in options])[F.floor(u * len(options)).cast("int")]
    if kind == "pchoice":
        total, edge, out = float(sum(p for p, _ in dist["pairs"])), 1.0, None
        for p, v in reversed(dist["pairs"]):
            edge -= p / total
            out = F.lit(v) if out is None else F.when(u < edge + p / total, F.lit(v)).otherwise(out)
        return out
    if kind in ("normal", "lognormal"):
        v = _unit(seed, f"{label}'", index)
        z = F.sqrt(-2 * F.ln(1 - u)) * F.cos(v * F.lit(6.283185307179586))
        x = F.lit(float(dist["mu"])) + F.lit(float(dist["sigma"])) * z
        return F.exp(x) if kind == "lognormal" else x
    low, high = dist["low"], dist["high"]
    if kind == "randint":
        return F.floor(F.lit(float(low)) + u * float(high - low)).cast("long")
    if kind == "int":
        return F.floor(F.lit(float(low)) + u * float(high - low + 1)).cast("long")
    if kind == "discrete_uniform":
        steps = int((high - low) / dist["q"] + 1e-9) + 1
        return F.lit(float(low)) + F.floor(u * steps) * F.lit(float(dist["q"]))
    x = F.lit(float(low)) + u * float(high - low)
    if kind.endswith("loguniform"):
        x = F.exp(x)
    elif not kind.endswith("uniform"):
        raise ValueError(f"unknown distribution {kind!r}")
    return F.round(x / dist["q"]) * F.lit(float(dist["q"])) if kind.startswith("q") else x


def draw_columns(df: DataFrame, spec: dict, index: str, seed) -> DataFrame:
    """One column per leaf; a leaf below an option that was not drawn is null."""
    for leaf in leaves(spec):
        value = draw(leaf.dist, leaf.label, F.col(index), seed)
        for label, option in leaf.branch:
            value = F.when(F.col(label) == option, value)
        df = df.withColumn(leaf.label, value)
    return df


def sample_space(spark: SparkSession, spec: dict, n: int, seed, start: int = 0) -> DataFrame:
    return draw_columns(spark.range(start, start + n).withColumnRenamed("id", "draw"), spec, "draw", seed)


def flatten_branch(draws: DataFrame, spec: dict, name: str, default=None, out: str | None = None) -> DataFrame:
    """Lift a parameter that several branches share to one column, with a default where no branch has it."""
    cols = [F.col(leaf.label) for leaf in leaves(spec) if leaf.name == name]
    if not cols:
        raise ValueError(f"no parameter {name!r} in the space")
    value = F.coalesce(*cols) if default is None else F.coalesce(*cols, F.lit(default))
    return draws.withColumn(out or name, value)


def params_of(row: dict, spec: dict) -> dict:
    """Parameters of one drawn row, by label; nulls (other branches) are dropped."""
    return {leaf.label: row[leaf.label] for leaf in leaves(spec) if row.get(leaf.label) is not None}


def short_names(params: dict) -> dict:
    return {label.split("__")[-1]: v for label, v in params.items()}


def grid(est, values: dict[str, list]) -> list[dict]:
    """Full parameter grid for an estimator."""
    b = ParamGridBuilder()
    for name, options in values.items():
        b = b.addGrid(est.getParam(name), options)
    return b.build()


def operator_config(config: dict) -> dict:
    """Allowed operators and parameter values {operator: {param: [values]}} as a space with one `model` choice."""
    return {"model": choice({op: {p: choice(*values) for p, values in params.items()} for op, params in config.items()})}
