"""Rows from a catalog table, a warehouse table or a warehouse query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spec import TableName


def read_catalog_table(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    """A table of the session catalog (Hive metastore or other) as a load source."""
    return spark.table(TableName(table, database).qualified())


def read_table_split(warehouse, table: TableName | str, *, splits: int = 8,
                     method: str | None = None, split_column: str | None = None) -> DataFrame:
    """A whole warehouse table, read in parallel splits."""
    table = TableName.parse(table) if isinstance(table, str) else table
    return warehouse.read_table(table, splits=splits, method=method, split_column=split_column)


def read_query(warehouse, sql: str, *, splits: int | None = None,
               split_column: str | None = None) -> DataFrame:
    """The result of a SQL text that the warehouse runs."""
    return warehouse.read_query(sql, splits=splits, split_column=split_column)
