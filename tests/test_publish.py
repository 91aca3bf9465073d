"""K4: an output is replaced by a swap."""

import os

import pytest
from pyspark.sql import functions as F

from tablemover.sinks import files
from tablemover.sinks.files import extract_files, recover


def old_output(spark, tmp_path):
    path = f"{tmp_path}/out"
    extract_files(spark.range(3), path, "parquet")
    return path


def values(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_a_failed_extract_leaves_the_old_output(spark, tmp_path):
    path = old_output(spark, tmp_path)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        extract_files(broken, path, "parquet", overwrite=True)
    assert values(spark, path) == [0, 1, 2] and os.listdir(tmp_path) == ["out"]


def test_a_source_may_read_its_target(spark, tmp_path):
    path = old_output(spark, tmp_path)
    for _ in range(2):
        extract_files(spark.read.parquet(path).select((F.col("id") * 2).alias("id")), path + "/", "parquet", overwrite=True)
    assert values(spark, path) == [0, 4, 8] and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["out"]


@pytest.mark.parametrize("renames", [0, 1, 2])
def test_a_swap_that_was_cut_short_is_ended(spark, tmp_path, monkeypatch, renames):
    """The driver goes after the record, between the two renames, or before the old output is deleted."""
    path, done = old_output(spark, tmp_path), []
    real = files.rename

    def some(*args):
        if len(done) == renames:
            raise KeyboardInterrupt
        done.append(args)
        real(*args)

    monkeypatch.setattr(files, "rename", some)
    if renames == 2:
        monkeypatch.setattr(files, "discard", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        extract_files(spark.range(5, 7), path, "parquet", overwrite=True)
    monkeypatch.undo()
    assert os.path.exists(path) == (renames != 1)
    assert recover(spark, path) and not recover(spark, path)
    assert values(spark, path) == [5, 6] and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["out"]


def test_without_overwrite_an_existing_path_is_an_error(spark, tmp_path):
    path = old_output(spark, tmp_path)
    with pytest.raises(Exception, match="already exists"):
        extract_files(spark.range(1), path, "parquet")
    assert values(spark, path) == [0, 1, 2]
