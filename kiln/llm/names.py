"""Column names that can't clash with those of the caller's table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(names: list[str]) -> list[Column]:
    """The columns of these names, whatever characters they hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def fresh(taken: list[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores added until no taken name equals it (names are compared without case)."""
    used, out = {name.lower() for name in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
