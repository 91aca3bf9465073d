"""K1/K2: append rows to a warehouse table; delete its rows first on request."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..spec import TableName


def load_table(df: DataFrame, warehouse, target: TableName, *, writers: int | None = None,
               insert_method: str | None = None, options: dict | None = None) -> None:
    """K1: append.  ``writers`` caps the connections of a JDBC target; a catalog
    target is written by every partition of ``df``."""
    if warehouse.kind == "jdbc":
        warehouse.append(df, target, writers=writers, insert_method=insert_method, options=options)
    else:
        warehouse.append(df, target, options=options)


def replace_target(warehouse, target: TableName) -> int:
    """K2: delete all rows of ``target``, keep the table; return how many went."""
    return warehouse.delete_all(target)


def replace_and_load(df: DataFrame, warehouse, target: TableName, *, writers: int | None = None,
                     insert_method: str | None = None) -> int:
    """K2 + K1: the target ends up holding exactly ``df``; returns how many rows
    it held before.  A catalog target does both in one overwrite job."""
    return warehouse.replace_with(df, target, writers=writers, insert_method=insert_method)
