"""An index of a target's keys beside its files, so that an append reads only files that may hold its keys.

For every file, by blocks of ``BLOCK`` rows, it has the range of the first key column (a zone) and a Bloom filter
of the whole key.  It lies in a hidden folder at the table's location, is kept by the loads that append, and is
always safe: a file that it does not know, or knows with another size or time, is read; one that has gone is
never asked for; and a replaced table takes the index with its files.

A file is left out if none of its blocks can hold an incoming key: first by the zones against the range of the
incoming keys, then, while these are at most ``MOST_KEYS``, by the Bloom filters against all of them.  With more
keys the zones decide alone, against many ranges of them; more files are read, and the result is the same.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..workspace import exists
from .names import col
from .splits import key_sketch, plan_splits, split_number

FOLDER = "_tablemover_keys"
BLOCK = 1_000_000
BITS_PER_KEY, HASHES = 12, 6
MOST_KEYS = 1_000_000
RANGES = 64
FILE = ["file", "size", "changed"]
# Key columns of other types have no index: the zones need an order, the filters a hash that equal keys share.
INDEXED = (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def indexable(schema: T.StructType, key: list[str]) -> bool:
    return all(isinstance(schema[c].dataType, INDEXED) for c in key)


def key_hash(schema: T.StructType, key: list[str]) -> Column:
    """Equal keys have equal hashes: -0.0 as 0.0, and a NULL unlike a left out column."""
    parts = []
    for c in key:
        kind = schema[c].dataType
        parts += [col(c) + 0.0 if isinstance(kind, (T.FloatType, T.DoubleType)) else col(c), col(c).isNull()]
    return F.xxhash64(*parts)


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """The places in a filter of ``size`` bits (a power of two): HASHES of them per key, from the hash's halves."""
    h = hashes.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(k) * high) & np.uint64(size - 1) for k in range(HASHES)])


def bloom(hashes: np.ndarray) -> bytes:
    size = 1 << max(6, int(len(hashes) * BITS_PER_KEY - 1).bit_length())
    filled = np.zeros(size, bool)
    filled[_bits(hashes, size).ravel()] = True
    return np.packbits(filled, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    words = np.frombuffer(bits, np.uint8)
    places = _bits(hashes, 8 * len(words))
    left = np.ones(places.shape[1], bool)
    for row in places:
        left[left] = (words[row[left] >> np.uint64(3)] >> (row[left] & np.uint64(7)).astype(np.uint8)) & 1 == 1
        if not left.any():
            return False
    return True


def _scan(rows: DataFrame) -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("changed")]


def index_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """Index rows for the files of ``rows`` (a scan): only key hashes, first key columns and their file's number are
    shuffled."""
    first = rows.schema[key[0]].dataType
    files = rows.select(*_scan(rows)).distinct().withColumn("number", F.row_number().over(Window.orderBy(*FILE)))
    keys = rows.select(*_scan(rows), F.floor(F.col("_metadata.row_index") / BLOCK).alias("block"), col(key[0]).alias("first"),
                       key_hash(rows.schema, key).alias("hash")).join(F.broadcast(files), FILE).select("number", "block", "first", "hash")

    def built(values, table):
        firsts = table.column("first")
        ends = pc.min_max(firsts)
        one = {"n": table.num_rows, "gap": firsts.null_count > 0, "lo": ends["min"].as_py(), "hi": ends["max"].as_py(),
               "bits": bloom(table.column("hash").to_numpy())}
        cells = {n: pa.array([v.as_py()], v.type) for n, v in zip(["number", "block"], values)}
        kinds = {"n": pa.int64(), "gap": pa.bool_(), "lo": firsts.type, "hi": firsts.type, "bits": pa.binary()}
        return pa.table(cells | {n: pa.array([one[n]], kinds[n]) for n in kinds})

    kind = first.simpleString()
    built_rows = keys.groupBy("number", "block").applyInArrow(
        built, f"number int, block long, n long, gap boolean, lo {kind}, hi {kind}, bits binary")
    return built_rows.join(F.broadcast(files), "number").select(*FILE, "block", "n", "gap", "lo", "hi", "bits")


def read_index(spark: SparkSession, location: str, schema: T.StructType, key: list[str]) -> DataFrame | None:
    """The index at the location if it is of this key."""
    path = f"{location.rstrip('/')}/{FOLDER}/{_name(key)}"
    if not exists(spark, path):
        return None
    kind = schema[key[0]].dataType.simpleString()
    return spark.read.schema(f"file string, size long, changed timestamp, block long, n long, gap boolean, lo {kind}, hi {kind}, bits binary").parquet(path)


def _name(key: list[str]) -> str:
    import zlib

    return f"key-{zlib.crc32(chr(0).join(k.lower() for k in key).encode()):08x}"


def unknown_files(files: DataFrame, index: DataFrame | None) -> DataFrame:
    return files if index is None else files.join(index.select(*FILE).distinct(), FILE, "left_anti")


def keep_index(location: str, rows: DataFrame, files: DataFrame, key: list[str]) -> int:
    """Add the files that the index lacks; ``rows`` are the table's, ``files`` (file, size, changed) its files.
    Returns how many were added."""
    spark = rows.sparkSession
    new = [r.file for r in unknown_files(files, read_index(spark, location, rows.schema, key)).select("file").collect()]
    if new:
        scan = rows.where(F.col("_metadata.file_path").isin(new))
        index_of(scan, key).write.mode("append").parquet(f"{location.rstrip('/')}/{FOLDER}/{_name(key)}")
    return len(new)


def candidate_files(index: DataFrame | None, files: DataFrame, incoming: DataFrame, key: list[str]) -> list[str]:
    """The files that may hold a key of ``incoming`` (staged rows)."""
    if index is None:
        return [r.file for r in files.select("file").collect()]
    current = index.join(files, FILE, "left_semi").where(_near(incoming, key[0], many=False))
    unknown = [r.file for r in unknown_files(files, index).select("file").collect()]
    if current.isEmpty():
        return sorted(unknown)
    if incoming.count() <= MOST_KEYS:
        hashes = incoming.select(key_hash(incoming.schema, key).alias("hash")).toArrow().column("hash").to_numpy()
        known = incoming.sparkSession.sparkContext.broadcast(np.unique(hashes))

        def met(batches):
            for batch in batches:
                hit = [may_hold(b, known.value) for b in batch.column("bits").to_pylist()]
                yield batch.select(["file"]).filter(pa.array(hit, pa.bool_()))

        current = current.select("file", "bits").mapInArrow(met, "file string")
    else:
        current = current.where(_near(incoming, key[0], many=True))
    return sorted({r.file for r in current.select("file").collect()} | set(unknown))


def _near(incoming: DataFrame, first: str, many: bool) -> Column:
    """Zones that meet the range of the incoming first key columns, or with ``many`` one of RANGES ranges of them."""
    kind, number = incoming.schema[first].dataType, F.lit(0)
    if many:
        number = split_number(incoming.select(col(first)), plan_splits(key_sketch(incoming, [first]), [first], RANGES))
    ranges = incoming.select(number.alias("range"), col(first).alias("first")).groupBy("range").agg(
        F.min("first").alias("lo"), F.max("first").alias("hi"), F.bool_or(F.col("first").isNull()).alias("gap")).collect()
    near = F.lit(False)
    for r in ranges:
        if r["lo"] is not None:
            near = near | F.coalesce((F.col("lo") <= F.lit(r["hi"]).cast(kind)) & (F.col("hi") >= F.lit(r["lo"]).cast(kind)), F.lit(False))
        if r["gap"]:
            near = near | F.col("gap")
    return near
