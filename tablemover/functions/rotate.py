"""Key rotation: re-seal the envelopes of a Parquet data set under a new pass phrase, in passes that can be resumed.

A registry table has a row for every salt under which values were sealed for the new pass phrase: (salt, version,
rows, batch).  A value whose salt it has is left as it is, so nothing is sealed twice, however often a rotation is
run.  All others, version ``1.1`` or ``2.0`` under the old pass phrase, are opened and sealed as ``2.0`` in one
plan: no plaintext is ever written.

The data set's files are dealt to batches, once, in a plan table.  A batch is written to a folder of its own and
then entered in the registry; one that is not entered is written anew.  When all are there, their files move to one
folder, which takes the place of the old by a recorded swap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.names import col, cols
from ..operators.spread import parallelism
from ..sinks.files import publish, recover
from ..workspace import children, discard, exists, rename, stage, touch
from .protect import VERSION_2_0, _parsed, decrypt_columns, encrypt_columns

REGISTRY = "salt string, version string, rows long, batch int"
# Files of a batch; a driver that is lost costs one batch.
FILES = 1000


def registry_table(spark: SparkSession, work: str) -> DataFrame:
    """(salt, version, rows, batch): the salts in use and how many values were sealed under each."""
    path = f"{work.rstrip('/')}/registry"
    return spark.read.schema(REGISTRY).parquet(path) if exists(spark, path) else spark.createDataFrame([], REGISTRY)


def _job_salt(c: Column) -> Column:
    """The salt of a ``2.0`` envelope, without its bucket."""
    parsed = _parsed(c)
    return F.when(parsed["ver"] == VERSION_2_0, F.element_at(F.split(parsed["salt"], ":"), 1))


def sealed_under(rows: DataFrame, columns) -> DataFrame:
    """(salt, rows): the values of the columns by their envelope's salt; null for those of ``1.1``."""
    values = rows.select(F.explode(F.array(*[F.struct(col(c).isNotNull().alias("there"), _job_salt(col(c)).alias("salt")) for c in columns])).alias("v"))
    return values.where("v.there").groupBy("v.salt").agg(F.count(F.lit(1)).alias("rows"))


def _resealed(rows: DataFrame, columns, old: str, new: str, known: DataFrame) -> DataFrame:
    """The rows with every value under a registered salt as it is and every other sealed anew."""
    salts = [r.salt for r in known.select("salt").distinct().collect()]  # one per batch
    kept = {f"kept_{i}": F.when(_job_salt(col(c)).isin(salts), col(c)) if salts else F.lit(None).cast("string") for i, c in enumerate(columns)}
    both = rows.select(F.struct(*cols(rows.columns)).alias("row"), *[k.alias(n) for n, k in kept.items()])
    due = both.select("row", *kept, *[F.when(F.col(n).isNull(), F.col("row").getField(c)).alias(f"due_{i}") for i, (n, c) in enumerate(zip(kept, columns))])
    names = [f"due_{i}" for i in range(len(columns))]
    done = encrypt_columns(decrypt_columns(due, names, old), names, new, empty="keep")
    new_of = {c: F.coalesce(F.col(n), F.col(d)) for c, n, d in zip(columns, kept, names)}
    return done.select(*[(new_of.get(c) if c in new_of else F.col("row").getField(c)).alias(c) for c in rows.columns])


def rotate_columns(spark: SparkSession, path: str, columns, old: str, new: str, work: str, *, files: int = FILES,
                   stop_after: int | None = None) -> int:
    """Rotate the envelopes of ``columns`` in the Parquet folder ``path`` from the pass phrase ``old`` to ``new``;
    returns how many values this run sealed.  ``work`` is a folder in shared storage that keeps the registry (for
    good) and, until it is done, the rotation.  ``stop_after`` ends a drill after so many batches."""
    path, work, columns = path.rstrip("/"), work.rstrip("/"), list(columns)
    recover(spark, path)
    place, sealed = f"{work}/rotation", 0
    whole = f"{path.rpartition('/')[0]}/_tablemover-{path.rpartition('/')[2]}-rotated"
    if exists(spark, f"{place}/assembled") and not exists(spark, whole):
        discard(spark, place)  # a run that was lost right after its swap
    if not exists(spark, f"{place}/plan"):
        rows = spark.read.parquet(path)
        due = sealed_under(rows, columns).join(registry_table(spark, work).select("salt").distinct(), "salt", "left_anti")
        if due.isEmpty():
            return 0
        discard(spark, place)
        listed = spark.createDataFrame(list(enumerate(sorted(rows.inputFiles()))), "number long, file string")
        first = registry_table(spark, work).agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]
        stage(listed.select("file", (F.floor(F.col("number") / files) + first).cast("int").alias("batch")), f"{place}/plan")
    plan = spark.read.parquet(f"{place}/plan")
    batches = [r.batch for r in plan.select("batch").distinct().orderBy("batch").collect()]
    for k in batches:
        known = registry_table(spark, work)
        if not known.where(F.col("batch") == k).isEmpty():
            continue
        if stop_after == 0:
            return sealed
        own = [r.file for r in plan.where(F.col("batch") == k).collect()]
        out = f"{place}/batch-{k}"
        discard(spark, out)  # of a run that was cut short
        rows, tasks = spark.read.parquet(*own), parallelism(spark)
        few = rows.rdd.getNumPartitions() < tasks
        # Two key derivations per value of 1.1 (about 1 ms): every core has a share of a batch of few files.
        done = _resealed(rows.repartition(tasks) if few else rows, columns, old, new, known)
        done = stage(done.repartition(len(own)) if few else done, out)
        counted = sealed_under(done, columns).join(known.select("salt").distinct(), "salt", "left_anti").where("salt IS NOT NULL")
        entry = counted.select("salt", F.lit(VERSION_2_0).alias("version"), "rows", F.lit(k).alias("batch"))
        entry = entry.unionByName(spark.createDataFrame([("", VERSION_2_0, 0, k)], REGISTRY))  # a batch may have nothing to seal
        entry.coalesce(1).write.mode("append").parquet(f"{work}/registry")
        sealed += registry_table(spark, work).where(F.col("batch") == k).agg(F.sum("rows")).first()[0]
        if stop_after is not None:
            stop_after -= 1
    if not exists(spark, f"{place}/assembled"):
        for k in batches:
            for file in children(spark, f"{place}/batch-{k}"):
                name = file.rpartition("/")[2]
                if not name.startswith(("_", ".")):
                    rename(spark, file, f"{whole}/{k}-{name}")
        touch(spark, f"{place}/assembled")
    publish(spark, whole, path)
    discard(spark, place)
    return sealed
