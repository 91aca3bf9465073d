"""Shared working folder for staged tables and per-run catalog databases.

On a cluster the folder is the one named by ``spark.checkpoint.dir`` (shared
storage every executor can reach).  Only when the session names none and runs
on a local master, as in tests, do we create one and register it as the
checkpoint directory.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # a Connect session: only the SQL conf is visible
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        return root.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach: "
                           f"the session runs on {sc.master}, where a local folder is each machine's own.")
    if not root:
        root = tempfile.mkdtemp(prefix="tablemover-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder under the work root; runs never share one."""
    return f"{work_root(spark)}/tablemover/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as parquet under ``path`` and read it back.

    Cuts lineage so that several later actions reuse one computation, and the
    staged files survive the loss of any executor.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def new_database(spark: SparkSession, label: str = "wh") -> str:
    """Create an empty catalog database whose files live in the work folder."""
    name = f"tm_{label}_{uuid.uuid4().hex[:10]}"
    location = f"{new_run_dir(spark, label)}/{name}.db"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{location}'")
    return name


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written under another name first."""
    fs, target = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"{path} could not be written.")


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing if there is none."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(target)) if fs.exists(target) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; ``new`` must not exist."""
    fs, source = _file_system(spark, old)
    _, target = _file_system(spark, new)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}.")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder this library staged, once nothing will read it again.
    Best effort: a leftover folder costs space, never correctness."""
    try:
        fs, target = _file_system(spark, path)
        fs.delete(target, True)
    except Exception:
        pass
