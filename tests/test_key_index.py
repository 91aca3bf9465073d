"""R2's key index: an append reads only the target's files that may hold its keys."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablemover import load
from tablemover.operators import key_index
from tablemover.operators.key_index import bloom, candidate_files, may_hold, read_index
from tablemover.plans.registry import catalog_spec
from tablemover.spec import TableName
from tablemover.warehouse import CatalogWarehouse
from tablemover.workspace import new_database, new_run_dir, stage

pytestmark = pytest.mark.usefixtures("few_partitions")


@given(st.lists(st.integers(-2 ** 63, 2 ** 63 - 1), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_bloom_never_misses(values):
    hashes = np.array(values, np.int64)
    bits = bloom(hashes)
    assert all(may_hold(bits, hashes[k:k + 1]) for k in range(len(hashes)))


def test_bloom_seldom_errs():
    rng = np.random.default_rng(3)
    own, other = rng.integers(-2 ** 62, 2 ** 62, 20_000), rng.integers(-2 ** 62, 2 ** 62, 2000)
    bits = bloom(own)
    assert sum(may_hold(bits, other[k:k + 1]) for k in range(len(other))) < 20 and len(bits) <= 20_000 * 12 / 4


class Target:
    def __init__(self, spark, ddl="k long, t string, v double", key=("k",)):
        self.spark, self.db = spark, new_database(spark, "ix")
        spark.sql(f"CREATE TABLE {self.db}.t ({ddl}) USING parquet")
        self.name, self.wh, self.key = TableName("t", self.db), CatalogWarehouse(spark), list(key)

    def load(self, df, **kw):
        df.write.mode("overwrite").saveAsTable(f"{self.db}.src")
        return load(self.spark, catalog_spec(job_type="hive", hive_database=self.db, hive_table="src",
                                             target_table=f"{self.db}.t", key_columns=tuple(self.key), **kw))

    def index(self):
        return read_index(self.spark, self.wh.storage(self.name)[1], self.wh.schema(self.name), self.key)

    def candidates(self, df):
        rows = stage(df, new_run_dir(self.spark, "incoming"))
        return candidate_files(self.index(), self.wh.files(self.name), rows, self.key)

    def n_files(self):
        return self.wh.files(self.name).count()


def rows(spark, lo, hi, step=1):
    return spark.range(lo, hi, step, 1).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"), F.lit(0.5).alias("v"))


def test_an_append_of_new_keys_reads_no_target_row(spark, monkeypatch):
    t = Target(spark)
    t.load(rows(spark, 0, 1000, 2))
    t.load(rows(spark, 5000, 6000))
    assert t.n_files() == 2 == t.index().count()
    read = []
    monkeypatch.setattr(CatalogWarehouse, "read_files", lambda self, table, files: read.append(files) or self.spark.table(self.name(table)).limit(0))
    assert t.candidates(rows(spark, 2000, 3000)) == []  # beyond all zones
    assert t.candidates(rows(spark, 1, 1000, 2)) == []  # within a zone, told by its filter
    report = t.load(rows(spark, 1, 1000, 2))
    assert read == [] and report.loaded == 500 and t.index().count() == 3


def test_only_files_with_the_keys_are_read(spark):
    t = Target(spark)
    for lo in (0, 1000, 2000):
        t.load(rows(spark, lo, lo + 1000))
    assert len(t.candidates(rows(spark, 1500, 1510))) == 1 and len(t.candidates(rows(spark, 990, 1010))) == 2
    report = t.load(rows(spark, 990, 3010))
    assert report.loaded == 10 and report.rejected[f"{t.db}.t_ERR_2"] == 2010
    assert spark.table(f"{t.db}.t").count() == 3010


def test_files_of_others_are_read(spark):
    """Rows that another writer appended have no index row; a file that has changed its size is not trusted."""
    t = Target(spark)
    t.load(rows(spark, 0, 100))
    rows(spark, 500, 600).write.insertInto(f"{t.db}.t")
    assert len(t.candidates(rows(spark, 900, 901))) == 1
    assert t.load(rows(spark, 550, 650)).loaded == 50
    assert t.index().count() == t.n_files() == 3


def test_a_replaced_table_loses_its_index(spark):
    t = Target(spark)
    t.load(rows(spark, 0, 100))
    t.load(rows(spark, 1000, 1100), replace_target=True)
    assert t.index() is None
    assert t.load(rows(spark, 0, 50)).loaded == 50  # the old rows' keys are gone
    assert t.load(rows(spark, 0, 60)).loaded == 10


@pytest.mark.parametrize("ddl, key", [("k string, v int", ["k"]), ("k date, n decimal(9,2), v int", ["k", "n"]), ("k double, v int", ["k"]),
                                      ("K timestamp_ntz, n int, v int", ["n", "k"]), ("k boolean, v int", ["k"])])
def test_types_nulls_and_composite_keys(spark, ddl, key, monkeypatch):
    """Against the whole target's keys; also with the zones alone."""
    t = Target(spark, ddl, key)
    schema = spark.table(f"{t.db}.t").schema

    def some(lo, hi):
        values = {"string": "concat('k', id)", "date": "date_add(date'2024-01-01', int(id))", "decimal(9,2)": "id / 4", "double": "if(id = 3, -0.0D, if(id = 5, double('NaN'), id / 3))",
                  "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id))", "int": "id % 5", "boolean": "id % 2 = 0"}
        return spark.range(lo, hi, 1, 2).selectExpr(*[f"CAST(if(id % 7 = 6, NULL, {values[f.dataType.simpleString()]}) AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])

    plain = spark.createDataFrame([], schema)
    for most, (lo, hi) in ((10 ** 6, (0, 40)), (10 ** 6, (30, 60)), (0, (55, 90)), (10 ** 6, (0, 90)), (10 ** 6, (200, 210))):
        monkeypatch.setattr(key_index, "MOST_KEYS", most)
        t.load(some(lo, hi))
        seen = plain.select(*[F.col(k) for k in key]).unionByName(some(lo, hi).select(*key)).distinct()
        plain = plain.unionByName(some(lo, hi))
        assert spark.table(f"{t.db}.t").select(*key).distinct().exceptAll(plain.select(*key).distinct()).isEmpty()
        held = spark.table(f"{t.db}.t")
        assert held.join(seen, [held[k].eqNullSafe(seen[k]) for k in key]).count() == seen.count()


def test_a_nested_key_has_no_index(spark):
    t = Target(spark, "k array<int>, v int")
    df = spark.createDataFrame([([1], 1), ([2], 2)], "k array<int>, v int")
    t.load(df)
    assert t.load(df).loaded == 0 and t.index() is None


def test_minus_zero_is_zero(spark):
    t = Target(spark, "k double, v int")
    t.load(spark.createDataFrame([(0.0, 1)], "k double, v int"))
    assert t.load(spark.createDataFrame([(-0.0, 2)], "k double, v int")).loaded == 0
