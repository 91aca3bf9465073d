"""Order-free digests of rows, by which a load proves that what it moved is what it read.

A digest is the number of rows and two sums of independent 64-bit row hashes.  Sums of parts add up to the sum of
the whole, whatever the order and the number of tasks, so equal rows may repeat and each counts.  A changed,
lost or doubled value changes the sums but for a chance of about 1 in 2^128.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import col

SEEDS = (0, 0x5DEECE66D)


def _hashable(value: Column, kind: T.DataType) -> list[Column]:
    if isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
        return [F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})]
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # told by their text, so that -0.0 is not 0.0
        return [value.cast("string"), value.isNull()]
    return [value, value.isNull()]


def row_hash(schema: T.StructType, seed: int, columns=None, of: str | None = None) -> Column:
    """A NULL and a left out column hash apart; columns count by their order.  ``of`` names a struct column that
    has them."""
    parts = [p for c in (columns or schema.fieldNames())
             for p in _hashable(F.col(of).getField(c) if of else col(c), schema[c].dataType)]
    return F.xxhash64(F.lit(seed), *parts)


@dataclass(frozen=True)
class Digest:
    rows: int = 0
    sums: tuple[int, ...] = (0,) * len(SEEDS)

    def __add__(self, other: Digest) -> Digest:
        return Digest(self.rows + other.rows, tuple(a + b for a, b in zip(self.sums, other.sums)))

    def __sub__(self, other: Digest) -> Digest:
        return Digest(self.rows - other.rows, tuple(a - b for a, b in zip(self.sums, other.sums)))


def digest_columns(schema: T.StructType, prefix: str, where: Column | None = None, columns=None, of: str | None = None) -> list[Column]:
    """Aggregates for a ``Digest``, of the rows that meet ``where``; partial sums per task."""
    one = F.lit(1) if where is None else F.when(where, 1)
    out = [F.count(one).alias(f"{prefix}_rows")]
    for k, seed in enumerate(SEEDS):
        value = row_hash(schema, seed, columns, of).cast("decimal(20,0)")
        out.append(F.sum(value if where is None else F.when(where, value)).alias(f"{prefix}_sum{k}"))
    return out


def digest_from(row, prefix: str) -> Digest:
    return Digest(int(row[f"{prefix}_rows"]), tuple(int(row[f"{prefix}_sum{k}"] or Decimal(0)) for k in range(len(SEEDS))))


def digest(df: DataFrame, columns=None) -> Digest:
    """The digest of the rows of ``df``, or of some columns of them in the order given."""
    return digest_from(df.agg(*digest_columns(df.schema, "d", columns=columns)).first(), "d")


class Unreconciled(RuntimeError):
    """What a load wrote is not what it read."""
