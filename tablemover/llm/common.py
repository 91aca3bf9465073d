"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def ship_by_value(module_name: str) -> None:
    """Python workers get the module's functions inside the task, so they need no install of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def release() -> None:
    """Give freed memory back to the system, so that an idle Python worker holds none of its last batch."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def remembered(owner: str | None, build=None):
    """What a Python worker keeps between tasks: one object, that of the last ``owner`` who asked.  An operator that
    keeps nothing asks with None, so that a reused worker does not hold an earlier operator's memory beside its own."""
    kept = sys.modules.setdefault("_tablemover_memory", types.ModuleType("_tablemover_memory"))
    if not hasattr(kept, "owner"):
        kept.owner = kept.value = None
    if kept.owner != owner:
        kept.owner = kept.value = None
        gc.collect()
        release()
        kept.value = build() if build else None
        kept.owner = owner
    return kept.value


# Bounds that operators set; any other is the session's own.
BATCH_SIZES = ("2m", "8m")


def arrow_batches(spark, size: str = "2m") -> None:
    """Bound the bytes of the batches that go to Python workers, unless the session has a bound of its own.  Spark's
    default, 64 MB, is held several times per task: by the JVM, by Arrow and as Python values."""
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key, default) in (default, *BATCH_SIZES):
        spark.conf.set(key, size)


def slices(batches, rows: int = 256, keep: str | None = None):
    """Record batches cut into parts of few rows, so that what a task builds per row stays small.  ``keep`` names
    what the worker remembers for the caller; all else is forgotten."""
    if keep is None:
        remembered(None)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
            release()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII and is much faster."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


# Bits per id, bits of a bitmap (Spark's), and bitmaps at most of ``maybe_among``: 16 MB in all.
BITS_PER_ID, BITMAP_BITS, MOST_BITMAPS = 32, 32768, 4096


def maybe_among(rows: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """The rows with a column ``maybe``, false where ``key`` is none of ``ids``, a staged table of one column of the
    key's type.  The ids set bits in bitmaps, which are broadcast: 4 bytes an id, 16 MB at most.  One in 32 of the
    other rows (more beyond 4 million ids) is true by chance, so an exact join must follow; but only the rows that
    are true need be shuffled for it, not a whole table of texts."""
    bitmaps = min(MOST_BITMAPS, ids.count() * BITS_PER_ID // BITMAP_BITS + 1)

    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(bitmaps * BITMAP_BITS))
    places = ids.select(bit(F.col(ids.columns[0])).alias("bit")).distinct()
    places = places.select(F.shiftright("bit", 15).alias("bitmap"), F.col("bit").bitwiseAND(BITMAP_BITS - 1).alias("place"))
    # Ids travel, not a bitmap from every task.
    maps = places.repartition("bitmap").groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))
    asked = rows.withColumn("asked", bit(key))
    place = F.col("asked").bitwiseAND(BITMAP_BITS - 1)
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(place, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    met = asked.join(F.broadcast(maps), F.shiftright("asked", 15) == F.col("bitmap"), "left")
    return met.select(*rows.columns, F.coalesce(F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1, F.lit(False)).alias("maybe"))


def integer_id(df: DataFrame, name: str) -> None:
    """Refuse an id column of another type than the integers."""
    if not isinstance(df.schema[name].dataType, T.IntegralType):
        raise ValueError(f"The id column {name} is {df.schema[name].dataType.simpleString()}; ids are integers.")


def packed(df: DataFrame, row: str = "row") -> DataFrame:
    """The whole input row as one struct column, so that no helper column can clash with its names."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    return df.select(F.struct(*quoted).alias(row))


def field(row: str, name: str) -> Column:
    return F.col(row).getField(name)


ship_by_value(__name__)
