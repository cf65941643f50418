"""Registered queries by theme."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    for m in sorted(x.name for x in iter_modules(__path__)):
        import_module(f"{__name__}.{m}")
