"""How many tasks a step is dealt to.  Nothing here runs a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What a task reads where a session's splits are smaller.
TASK_BYTES = 32 << 20


def parallelism(spark: SparkSession, default: int = 8) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # a Connect session has no SparkContext
        return int(spark.conf.get("spark.default.parallelism", str(default)))


def wide(spark: SparkSession) -> int:
    """At least a task per core, and never fewer than the session's shuffles have."""
    try:
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except ValueError:  # a non-numeric setting
        shuffles = 1
    return max(parallelism(spark), shuffles)


def in_tasks(df: DataFrame) -> DataFrame:
    """A scan of files in the session's splits; where these are small, several are read by a task, one after the
    other.  A task for each, and a file that it writes, would cost more than its rows."""
    spark = df.sparkSession
    splits, size = df.rdd.getNumPartitions(), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(wide(spark), -(-splits * size // TASK_BYTES))
    return df.coalesce(tasks) if tasks < splits else df
