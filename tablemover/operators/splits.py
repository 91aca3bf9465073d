"""Split planning: cut a table into ranges of a key that hold about equal numbers of rows.

The key may be any orderable columns (text, dates, several of them).  Its quantiles come from a mergeable sketch:
every task thins out its sorted keys level by level (an item of level h stands for 2^h rows), and sketches merge
in two rounds of groups, so neither a task nor the driver holds more than a bounded number of items.  A value so
frequent that it fills a split gets its own, cut further by a hash of whole rows; ranges leave it out.

Every row falls into exactly one split.  NULL is least, as in Spark's ordering.
"""

from __future__ import annotations

import datetime as dt
import sys
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import col, fresh

# Items of a level; the rank error of a sketch is of the order of 1 / SIZE.
SIZE = 1024
# Sketches that meet in one group of the first round.
FAN = 256
ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Sketch:
    """Levels of items; a level that is full is sorted, and every other item goes up with twice the weight."""

    def __init__(self, size: int):
        self.size, self.levels, self.odd = size, [], 0

    def add(self, items: pa.Table, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append(None)
        held = self.levels[level]
        items = items if held is None else pa.concat_tables([held, items])
        self.levels[level] = items
        if items.num_rows >= 2 * self.size:
            keep = items.num_rows % 2  # an odd one stays, so that no weight is lost
            rest = items.slice(items.num_rows - keep)
            order = pc.sort_indices(items.slice(0, items.num_rows - keep), sort_keys=[(c, "ascending") for c in items.column_names],
                                    null_placement="at_start").to_numpy()
            self.odd ^= 1
            self.levels[level] = rest
            self.add(items.take(pa.array(order[self.odd::2])), level + 1)

    def rows(self):
        for level, items in enumerate(self.levels):
            if items is not None and items.num_rows:
                yield items.combine_chunks().append_column("weight", pa.array(np.full(items.num_rows, 2 ** level, np.int64)))


def key_sketch(df: DataFrame, columns: list[str], size: int = SIZE) -> list[tuple[tuple, int]]:
    """(key, rows it stands for) in order: a bounded summary of the key columns.  The weights add up to the
    number of rows."""
    unfit = [c for c in columns if not isinstance(df.schema[c].dataType, ORDERABLE)]
    if unfit:
        raise ValueError(f"Columns {unfit} cannot be ordered.")
    names = [f"k{i}" for i in range(len(columns))]
    # Floats in one spelling: -0.0 is 0.0.
    keys = df.select(*[(col(c) + 0.0 if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else col(c)).alias(n)
                       for c, n in zip(columns, names)], F.spark_partition_id().alias("task"))
    kinds = ", ".join(f"{n} {keys.schema[n].dataType.simpleString()}" for n in names)

    def summed_up(batches):
        sketch, task = _Sketch(size), None
        for batch in batches:
            if batch.num_rows:
                task = batch.column(len(names))[0].as_py()
                sketch.add(pa.Table.from_batches([batch.select(names)]))
        for table in sketch.rows():
            yield from table.append_column("task", pa.array(np.full(table.num_rows, task, np.int32))).to_batches()

    def merged(table: pa.Table) -> pa.Table:
        sketch = _Sketch(size)
        weight = table.column("weight").to_numpy()
        for w in np.unique(weight):
            sketch.add(table.select(names).filter(pa.array(weight == w)), int(w).bit_length() - 1)
        task = table.column("task")[0].as_py() if table.num_rows else 0
        out = [t.append_column("task", pa.array(np.full(t.num_rows, task, np.int32))) for t in sketch.rows()]
        return pa.concat_tables(out)

    parts = keys.mapInArrow(summed_up, f"{kinds}, weight long, task int")
    for fan in (FAN, None):
        group = F.floor(F.col("task") / fan).cast("int") if fan else F.lit(0)
        parts = parts.withColumn("task", group).groupBy("task").applyInArrow(merged, f"{kinds}, weight long, task int")
    items = parts.orderBy(*names).collect()  # at most a few times SIZE per doubling of the rows
    return [(tuple(r[n] for n in names), r["weight"]) for r in items]


@dataclass(frozen=True)
class Plan:
    """``bounds`` part the keys into ranges: split i holds the keys below bounds[i] that are not below the one
    before.  ``hot`` values stand apart, each with its number of parts."""

    columns: tuple[str, ...]
    bounds: tuple[tuple, ...]
    hot: tuple[tuple[tuple, int], ...]

    @property
    def splits(self) -> int:
        return len(self.bounds) + 1 + sum(parts for _, parts in self.hot)


def plan_splits(sketch: list[tuple[tuple, int]], columns, splits: int) -> Plan:
    """About ``splits`` splits of equal weight.  Keys are never cut between rows of the same value, but for hot
    values, which hold more than a split's share each."""
    weight: dict[tuple, int] = {}
    for key, w in sketch:
        weight[key] = weight.get(key, 0) + w
    share = sum(weight.values()) / max(splits, 1)
    hot = [(k, max(1, round(w / share))) for k, w in weight.items() if splits > 1 and w > share]
    rest = [(k, w) for k, w in weight.items() if k not in dict(hot)]
    total, ranges = sum(w for _, w in rest), 0
    if rest:
        ranges = max(1, round(total / share)) if share else 1
    bounds, before, cut = [], 0, 1
    for k, w in rest:
        # A value goes to the side on which more of it lies.
        if cut < ranges and before + w / 2 >= total * cut / ranges and before:
            bounds.append(k)
            while cut < ranges and before + w / 2 >= total * cut / ranges:
                cut += 1
        before += w
    return Plan(tuple(columns), tuple(bounds), tuple(hot))


def split_number(df: DataFrame, plan: Plan) -> Column:
    """The split of each row, from 0.  Hot values are parted by a hash of all columns that can be hashed."""
    def struct_of(values):
        return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(f"k{i}") for i, (c, v) in enumerate(zip(plan.columns, values))])

    own = F.struct(*[(col(c) + 0.0 if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else col(c)).cast(df.schema[c].dataType).alias(f"k{i}")
                     for i, c in enumerate(plan.columns)])
    number = F.lit(0)
    for b in plan.bounds:
        number = number + F.when(own >= struct_of(b), 1).otherwise(0)
    at = len(plan.bounds) + 1
    hashed = [col(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    chain = None
    for value, parts in plan.hot:
        there = F.lit(at) + F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int")
        chain = F.when(own == struct_of(value), there) if chain is None else chain.when(own == struct_of(value), there)
        at += parts
    return number if chain is None else chain.otherwise(number)


def in_splits(df: DataFrame, columns: list[str], splits: int) -> DataFrame:
    """``df`` with a partition for each split of a plan over its own keys."""
    plan = plan_splits(key_sketch(df, columns, max(SIZE, 16 * splits)), columns, splits)
    n = fresh(df.columns, "split")[0]
    return df.withColumn(n, split_number(df, plan)).repartitionById(plan.splits, F.col(n)).drop(n)


# -- the same plan as predicates of a database --------------------------------------
def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"No SQL literal for {type(value).__name__}.")


def _below(names: list[str], bound: tuple) -> str:
    """The key lies below the bound; NULL is least.  Never unknown."""
    name, value = names[0], sql_literal(bound[0])
    if bound[0] is None:
        here, same = "1 = 0", f"{name} IS NULL"
    else:
        here, same = f"({name} IS NULL OR {name} < {value})", f"({name} IS NOT NULL AND {name} = {value})"
    return here if len(names) == 1 else f"({here} OR ({same} AND {_below(names[1:], bound[1:])}))"


def _equal(names: list[str], key: tuple) -> str:
    return "(" + " AND ".join(f"{n} IS NULL" if v is None else f"({n} IS NOT NULL AND {n} = {sql_literal(v)})" for n, v in zip(names, key)) + ")"


def sql_predicates(plan: Plan, names: list[str], part_of: str | None = None) -> list[str]:
    """A predicate for each split.  ``names`` are the columns as the database writes them, ``part_of`` an integer
    expression by which a hot value's rows are parted (without it a hot value is one split).

    A range excludes what lies below any bound before it, not only the last one: where the database orders text
    by another rule than Spark's, the bounds may not ascend there, and still every row meets just one predicate."""
    below = [_below(names, b) for b in plan.bounds]
    apart = [f"NOT {_equal(names, v)}" for v, _ in plan.hot]
    out = []
    for i in range(len(below) + 1):
        terms = ([below[i]] if i < len(below) else []) + [f"NOT {b}" for b in below[:i]] + apart
        out.append(" AND ".join(terms) or "1 = 1")
    for value, parts in plan.hot:
        own = _equal(names, value)
        if part_of is None or parts == 1:
            out.append(own)
            continue
        part = f"MOD(MOD({part_of}, {parts}) + {parts}, {parts})"
        out += [f"{own} AND " + (f"({part} = 0 OR {part_of} IS NULL)" if j == 0 else f"{part} = {j}") for j in range(parts)]
    return out
