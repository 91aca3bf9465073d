"""Files whose schemas have drifted apart, read as one table without loss.

Types form a lattice: two types meet at the least one that holds all values of both (integers widen, an integer
and a fraction meet at a double only if it holds every such integer, decimals keep all digits on both sides), and
at text where there is none.  The schemas of all files, as their footers tell, are merged field by field; files of
one schema are read together under their own, and their columns cast up.  A column that a file lacks is NULL there.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.names import col

# The reader option that asks for it.
OPTION = "driftingschemas"
# Footers read at a time, by the driver.
FOOTERS = 16
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Integers that every value of which a float or double holds.
_EXACT = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType)}


def _as_decimal(t: T.DataType) -> T.DecimalType | None:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DoubleType) and isinstance(y, (T.FloatType, *_EXACT[T.DoubleType])):
            return x
        if isinstance(x, T.FloatType) and isinstance(y, _INTEGERS):
            return x if isinstance(y, _EXACT[T.FloatType]) else T.DoubleType() if isinstance(y, T.IntegerType) else T.StringType()
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    one, two = _as_decimal(a), _as_decimal(b)
    if one and two:
        scale = max(one.scale, two.scale)
        whole = max(one.precision - one.scale, two.precision - two.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType))
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.BinaryType, T.VariantType)) for t in (a, b)):
        raise ValueError(f"No type holds both {a.simpleString()} and {b.simpleString()}.")
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """Fields by name (letter case aside), in order of first appearance, each of the widest type."""
    names, kinds = {}, {}
    for s in schemas:
        for f in s.fields:
            low = f.name.lower()
            names.setdefault(low, f.name)
            try:
                kinds[low] = widest(kinds.get(low, T.NullType()), f.dataType)
            except ValueError as e:
                raise ValueError(f"Column {f.name}: {e}") from None
    return T.StructType([T.StructField(names[n], kinds[n]) for n in names])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` cast up; structs field by field, as a cast would go by position."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [(widened(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType)
                   if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    return value.cast(want)


def read_drifting(spark: SparkSession, path: str, fmt: str, options: dict | None = None) -> DataFrame:
    """All files under ``path``, of whatever schemas, under the merged one."""
    files = sorted(r.f for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                   .select(F.col("_metadata.file_path").alias("f"), F.col("length")).where("length > 0").collect())
    if not files:
        raise ValueError(f"No files under {path}.")

    def footer(file: str) -> T.StructType:
        return spark.read.format(fmt).options(**(options or {})).load(file).schema

    with ThreadPoolExecutor(FOOTERS) as pool:
        schemas = list(pool.map(footer, files))
    groups: dict[str, list[str]] = defaultdict(list)
    for file, schema in zip(files, schemas):
        groups[schema.json()].append(file)
    table = merged(schemas)
    parts = []
    for text, own in groups.items():
        schema = next(s for s in schemas if s.json() == text)
        rows = spark.read.format(fmt).schema(schema).options(**(options or {})).load(own)
        have = {f.name.lower(): f for f in schema.fields}
        parts.append(rows.select(*[
            (widened(col(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in table.fields]))
    return reduce(DataFrame.unionByName, parts)
