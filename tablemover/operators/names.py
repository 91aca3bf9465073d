"""Refer to a column by its name as data gives it (dots, spaces, backticks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names) -> list[Column]:
    return [col(n) for n in names]


def fresh(taken, *wanted: str) -> list[str]:
    """Names for helper columns that no column in ``taken`` has (letter case aside)."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def same_keys(left, right) -> Column:
    """Null-safe equality of two lists of columns: one rule for keys, NULL equals NULL."""
    from functools import reduce

    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)])
