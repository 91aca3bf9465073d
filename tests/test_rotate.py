"""Key rotation."""

import os

import pytest

from tablemover.functions import rotate
from tablemover.functions.protect import decrypt_columns, encrypt_columns
from tablemover.functions.rotate import registry_table, rotate_columns
from tablemover.sinks import files

pytestmark = pytest.mark.usefixtures("few_partitions")


@pytest.fixture
def sealed(spark, tmp_path):
    """Two columns of envelopes in both versions, with nulls, over four files; the plain rows."""
    rows = [(k, None if k % 7 == 0 else f"name {k}", f"p{k}" if k % 3 else None) for k in range(40)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    for part, version in (("k % 2 = 0", "1.1"), ("k % 2 = 1", "2.0")):
        encrypt_columns(df.where(part), ["a", "b"], "old", version=version).repartition(2).write.mode("append").parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t", f"{tmp_path}/work", sorted(rows)


def opened(spark, path, phrase):
    return sorted(map(tuple, decrypt_columns(spark.read.parquet(path), ["a", "b"], phrase).collect()))


def values(rows):
    return sum(v is not None for r in rows for v in r[1:])


def test_stopped_and_run_again(spark, sealed, tmp_path):
    path, work, rows = sealed
    first = rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=1, stop_after=2)
    assert 0 < first < values(rows) and opened(spark, path, "old") == rows  # nothing shows before all is done
    assert first + rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=1) == values(rows)
    assert opened(spark, path, "new") == rows and not os.path.exists(f"{work}/rotation")
    assert rotate_columns(spark, path, ["a", "b"], "old", "new", work) == 0
    known = registry_table(spark, work).collect()
    assert sum(r.rows for r in known) == values(rows) and {r.version for r in known} == {"2.0"}
    assert sorted(f for f in os.listdir(tmp_path) if f[0] != ".") == ["t", "work"]


def test_only_new_rows_are_sealed_later(spark, sealed):
    path, work, rows = sealed
    rotate_columns(spark, path, ["a", "b"], "old", "new", work)
    before = {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()}
    more = spark.createDataFrame([(100, "late", None)], "k int, a string, b string")
    encrypt_columns(more, ["a", "b"], "old", version="1.1").write.mode("append").parquet(path)
    assert rotate_columns(spark, path, ["a", "b"], "old", "new", work) == 1
    after = {r.k: (r.a, r.b) for r in spark.read.parquet(path).collect()}
    assert {k: after[k] for k in before} == before and opened(spark, path, "new") == sorted([*rows, (100, "late", None)], key=lambda r: r[0])


@pytest.mark.parametrize("where", ["registry", "swap"])
def test_cut_short_anywhere(spark, sealed, where, monkeypatch):
    """After a batch was written but not entered; between the two renames of the swap."""
    path, work, rows = sealed
    if where == "registry":
        monkeypatch.setattr(rotate, "sealed_under", lambda r, c, real=rotate.sealed_under: real(r, c) if "rotation" not in r.inputFiles()[0] else 1 / 0)
    else:
        real = files.rename
        monkeypatch.setattr(files, "rename", lambda s, a, b: real(s, a, b) if b.endswith("-old") else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=2)
    monkeypatch.undo()
    rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=2)
    assert opened(spark, path, "new") == rows


def test_a_wrong_old_pass_phrase_leaves_all_as_it_was(spark, sealed):
    path, work, rows = sealed
    with pytest.raises(Exception):
        rotate_columns(spark, path, ["a", "b"], "wrong", "new", work)
    assert opened(spark, path, "old") == rows
    assert rotate_columns(spark, path, ["a", "b"], "old", "new", work) == values(rows)


def test_no_plaintext_at_rest(spark, sealed, tmp_path):
    path, work, _ = sealed
    rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=1, stop_after=3)
    for folder, _, names in os.walk(tmp_path):
        for name in names:
            with open(os.path.join(folder, name), "rb") as f:
                assert b"name 1" not in f.read()


def test_a_batch_of_few_files_is_dealt_to_every_core(spark, sealed, monkeypatch):
    """Opening and sealing run in as many tasks as the session is wide; the batch has its files' number again."""
    path, work, rows = sealed
    seen, real = [], rotate._resealed
    monkeypatch.setattr(rotate, "_resealed", lambda r, *a: seen.append(r.rdd.getNumPartitions()) or real(r, *a))
    files_before = len(spark.read.parquet(path).inputFiles())
    rotate_columns(spark, path, ["a", "b"], "old", "new", work, files=2)
    assert seen and min(seen) >= spark.sparkContext.defaultParallelism
    assert len(spark.read.parquet(path).inputFiles()) == files_before and opened(spark, path, "new") == rows
