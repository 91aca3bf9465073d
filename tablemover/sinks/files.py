"""K3/K4: write a DataFrame to a file set.

One file per partition of the source (one per split of a warehouse read, one
per file split of a catalog table): no repartition, so no shuffle.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.names import col
from ..sources.files import ESCAPED_MARK, NULL_MARK, TEXT_OPTIONS, avro_available, escape_text, spark_format
from ..workspace import discard, exists, read_small, rename, touch, write_small


def _as_text(f: T.StructField, alone: bool):
    """A column as delimited text holds it: line breaks escaped, binary values in base64.  The NULL of a table's
    only column would be an empty line, which the writer leaves out, so it has a mark."""
    if alone and not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        text = _as_text(f, False).cast("string")
        return F.coalesce(text, F.lit(NULL_MARK)).alias(f.name)
    if isinstance(f.dataType, T.BinaryType):
        return F.regexp_replace(F.base64(col(f.name)), r"[\r\n]", "").alias(f.name)
    return escape_text(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)


def extract_files(df: DataFrame, path: str, file_format: str | None, *,
                  separator: str | None = None, overwrite: bool = False,
                  options: dict | None = None) -> str:
    """K3 with K4: ``overwrite`` replaces what is at ``path``; without it an
    existing ``path`` is an error.  A replacement is written beside the old output
    and swapped in when it is complete, so a failed extract leaves the old one,
    and a source may read the path that it replaces."""
    fmt = spark_format(file_format)
    if fmt == "avro" and not avro_available(df.sparkSession):
        raise RuntimeError("Writing Avro needs Spark's Avro module on the class path "
                           "(spark-submit --packages org.apache.spark:spark-avro_2.13:<spark version>).")
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
        if nested:
            raise ValueError(f"Delimited text cannot hold nested columns {nested}; "
                             "turn them to text with to_json first, or extract to orc or parquet.")
        df = df.select(*[_as_text(f, len(df.columns) == 1) for f in df.schema.fields])
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    # A new output is published by a rename; an existing one is an error before anything is written.
    place = f"{_beside(path)}-{uuid.uuid4().hex[:8]}" if overwrite and exists(spark, path) else path
    writer = df.write.format(fmt).mode("errorifexists")
    if fmt == "csv":
        writer = writer.options(**TEXT_OPTIONS).option("sep", separator or ",")
    try:
        writer.options(**(options or {})).save(place)
        if fmt == "csv":
            touch(spark, f"{place}/{ESCAPED_MARK}")
    except BaseException:
        if place != path:
            discard(spark, place)
        raise
    if place != path:
        publish(spark, place, path)
    return path


def _beside(path: str) -> str:
    """A hidden name next to ``path``, in the same file system."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/_tablemover-{name}" if folder else f"_tablemover-{name}"


def publish(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete folder ``new`` in the place of ``path``.  The swap is on record before it begins, so that
    ``recover`` can end one that was cut short; until the old output has moved aside it stays as it was."""
    record, old = f"{_beside(path)}.swap", f"{new}-old"
    write_small(spark, record, json.dumps({"new": new, "old": old}))
    rename(spark, path, old)
    rename(spark, new, path)
    discard(spark, old)
    discard(spark, record)


def recover(spark: SparkSession, path: str) -> bool:
    """End a swap at ``path`` that was cut short: the new output is complete, so it goes in.  True if there was one."""
    path = path.rstrip("/")
    record = f"{_beside(path)}.swap"
    text = read_small(spark, record)
    if text is None:
        return False
    swap = json.loads(text)
    if exists(spark, swap["new"]):
        if exists(spark, path):
            rename(spark, path, swap["old"])
        rename(spark, swap["new"], path)
    discard(spark, swap["old"])
    discard(spark, record)
    return True

