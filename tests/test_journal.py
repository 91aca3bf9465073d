"""Loads that are cut short: a second run finishes or undoes the first."""

import pytest
from pyspark.sql import functions as F

from tablemover import load
from tablemover.operators.reconcile import Unreconciled, digest
from tablemover.plans import transfer
from tablemover.plans.journal import Interrupted, Journal
from tablemover.plans.registry import catalog_spec
from tablemover.spec import TableName
from tablemover.warehouse import CatalogWarehouse
from tablemover.workspace import exists, new_database, new_run_dir

pytestmark = pytest.mark.usefixtures("few_partitions")

PHASES = ("staged", "rejects", "changing", "changed")


class Case:
    """A target with two rows; a source of 20 with a bad value, a repeated key and a key that the target holds."""

    def __init__(self, spark, **kw):
        self.spark, self.db = spark, new_database(spark, "journal")
        spark.sql(f"CREATE TABLE {self.db}.t (k INT, s STRING) USING parquet")
        spark.sql(f"INSERT INTO {self.db}.t VALUES (1, 'old'), (100, 'old')")
        rows = [(str(k), f"new{k}") for k in range(17)] + [("x", "bad"), ("5", "again"), (None, None)]
        spark.createDataFrame(rows, "k string, s string").repartition(3).write.saveAsTable(f"{self.db}.src")
        self.journal = new_run_dir(spark, "journal")
        self.spec = dict(job_type="hive", hive_database=self.db, hive_table="src", target_table=f"{self.db}.t",
                         journal=self.journal, key_columns=("k",)) | kw

    def load(self, stop_after=None, **kw):
        return load(self.spark, catalog_spec(**self.spec | kw), stop_after=stop_after)

    def state(self):
        def rows(t):
            return sorted(map(tuple, self.spark.table(t).collect()), key=repr) if self.spark.catalog.tableExists(t) else None
        return [rows(f"{self.db}.{t}") for t in ("t", "t_ERR_1", "t_ERR_2")]

    def phases(self):
        return [r.phase for r in Journal(self.spark, self.journal, f"{self.db}.t").table().orderBy("at", "seq").collect()]

    def unfinished(self):
        return Journal(self.spark, self.journal, f"{self.db}.t").unfinished()


@pytest.fixture(scope="module")
def plain(spark):
    """What an undisturbed load leaves, by whether it replaces."""
    out = {}
    for replace in (False, True):
        case = Case(spark, journal=None, replace_target=replace)
        out[replace] = (case.load(), case.state())
    return out


@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("phase", PHASES)
def test_finished_after_every_phase(spark, plain, phase, replace):
    case = Case(spark, replace_target=replace)
    with pytest.raises(Interrupted):
        case.load(stop_after=phase)
    spark.sql(f"DROP TABLE {case.db}.src")  # the source is not read again
    spark.createDataFrame([], "k string, s string").write.saveAsTable(f"{case.db}.src")
    run_dir = case.unfinished().run_dir
    report, want = case.load(), plain[replace]
    assert case.state() == want[1] and report.resumed == phase
    assert (report.loaded, report.deleted) == (want[0].loaded, want[0].deleted)
    assert list(report.rejected.values()) == list(want[0].rejected.values())
    assert case.phases() == [*PHASES, "done"] and not exists(spark, run_dir)


@pytest.mark.parametrize("replace", [False, True])
def test_finished_after_half_a_change(spark, plain, replace, monkeypatch):
    """The driver goes while the target is being written."""
    case = Case(spark, replace_target=replace)
    method = "replace_with" if replace else "append"
    real = getattr(CatalogWarehouse, method)

    def half(self, df, table, **kw):
        real(self, df.where("k % 2 = 0"), table, **kw)
        raise KeyboardInterrupt

    monkeypatch.setattr(CatalogWarehouse, method, half)
    with pytest.raises(KeyboardInterrupt):
        case.load()
    monkeypatch.setattr(CatalogWarehouse, method, real)
    assert case.state()[0] != plain[replace][1][0] and case.unfinished().phase == "changing"
    assert case.load().resumed == "changing" and case.state() == plain[replace][1]


def test_finished_after_half_the_rejects(spark, plain, monkeypatch):
    case = Case(spark)
    real = CatalogWarehouse.create

    def second(self, df, table, **kw):
        if table.table.endswith("_2"):
            raise KeyboardInterrupt
        real(self, df, table, **kw)

    monkeypatch.setattr(CatalogWarehouse, "create", second)
    with pytest.raises(KeyboardInterrupt):
        case.load()
    monkeypatch.setattr(CatalogWarehouse, "create", real)
    assert case.load(drop_error_tables=False).resumed == "staged" and case.state() == plain[False][1]


def test_a_failure_before_anything_was_staged_leaves_no_entry(spark, plain, monkeypatch):
    case = Case(spark)
    monkeypatch.setattr(transfer, "stage_out", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        case.load()
    monkeypatch.undo()
    assert case.unfinished() is None
    assert case.load().resumed is None and case.state() == plain[False][1]


@pytest.mark.parametrize("phase, left", [("staged", "undone"), ("rejects", "undone"), ("changing", "undone"), ("changed", "done")])
def test_another_load_settles_the_first(spark, phase, left):
    """What had not changed the target, or can be taken back, is undone; the rest is finished first."""
    case = Case(spark)
    with pytest.raises(Interrupted):
        case.load(stop_after=phase)
    spark.createDataFrame([(50, "other")], "k int, s string").write.saveAsTable(f"{case.db}.more")
    report = case.load(hive_table="more")
    assert report.loaded == 1 and report.resumed is None
    assert case.phases()[-6 if phase != "changed" else -6] == left
    target = case.state()[0]
    assert (50, "other") in target and (100, "old") in target and ((0, "new0") in target) == (left == "done")


def test_half_an_append_is_taken_back_before_another_load(spark, monkeypatch):
    case = Case(spark)
    real = CatalogWarehouse.append

    def half(self, df, table, **kw):
        real(self, df.where("k % 2 = 0"), table, **kw)
        raise KeyboardInterrupt

    monkeypatch.setattr(CatalogWarehouse, "append", half)
    with pytest.raises(KeyboardInterrupt):
        case.load()
    monkeypatch.setattr(CatalogWarehouse, "append", real)
    spark.createDataFrame([(50, "other")], "k int, s string").write.saveAsTable(f"{case.db}.more")
    case.load(hive_table="more")
    assert case.state()[0] == [(1, "old"), (100, "old"), (50, "other")]


def test_a_load_without_a_key(spark):
    case = Case(spark, key_columns=())
    with pytest.raises(Interrupted):
        case.load(stop_after="changing")
    report = case.load()
    assert report.loaded == 19 and list(report.rejected.values()) == [1] and case.unfinished() is None


def test_only_a_journaled_load_can_be_stopped(spark):
    with pytest.raises(ValueError, match="journaled"):
        Case(spark, journal=None).load(stop_after="staged")


class KeyedDatabase:
    """A target without files, like a database: an append may have arrived in part."""

    kind = "jdbc"

    def __init__(self, spark, held):
        self.spark, self.rows, self.broken, self.key = spark, held, False, ("k",)
        self.tables = {}

    def exists(self, t):
        return t.table == "t" or t.table in self.tables

    def schema(self, t):
        return self.rows.schema

    def primary_key(self, t):
        return self.key

    def text_limits(self, t):
        return {}

    def count(self, t):
        return (self.rows if t.table == "t" else self.tables[t.table]).count()

    def create(self, df, t, writers=None):
        self.tables[t.table] = self._kept(df)

    def drop(self, t):
        del self.tables[t.table]

    def _kept(self, df):
        return self.spark.createDataFrame(df.collect(), df.schema)

    def read_table(self, t, splits=None, **kw):
        return self.rows if t.table == "t" else self.tables[t.table]

    def held_keys(self, t, key, incoming, **kw):
        return self.rows.select(*key)

    def append(self, df, t, **kw):
        part = df.where("k % 2 = 0") if self.broken else df
        self.rows = self._kept(self.rows.unionByName(part))
        if self.broken:
            raise KeyboardInterrupt


@pytest.mark.parametrize("reconcile", [False, True])
def test_an_append_to_a_database_goes_on_where_it_stopped(spark, reconcile):
    case = Case(spark, reconcile=reconcile)
    wh = KeyedDatabase(spark, spark.createDataFrame([(1, "old"), (100, "old")], "k int, s string"))
    wh.broken = True
    with pytest.raises(KeyboardInterrupt):
        load(spark, catalog_spec(**case.spec), warehouse=wh)
    wh.broken = False
    report = load(spark, catalog_spec(**case.spec), warehouse=wh)
    assert report.resumed == "changing" and report.loaded == 17 and wh.rows.count() == 19 == wh.rows.distinct().count()
    # Without a key the rows that arrived cannot be told.
    wh.key, wh.broken = (), True
    with pytest.raises(KeyboardInterrupt):
        load(spark, catalog_spec(**case.spec | {"key_columns": ()}), warehouse=wh)
    with pytest.raises(RuntimeError, match="without a key"):
        load(spark, catalog_spec(**case.spec | {"key_columns": ()}), warehouse=wh)


# -- reconciliation ------------------------------------------------------------------
@pytest.mark.parametrize("journaled", [False, True])
@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("key", [(), ("k",)])
def test_a_load_is_proved(spark, journaled, replace, key):
    case = Case(spark, reconcile=True, replace_target=replace, key_columns=key, **({} if journaled else {"journal": None}))
    proof = case.load().proof
    assert proof["source"].rows == 20 == proof["converted"].rows + proof["rejected"].rows
    assert proof["gained"] + proof["error_2"] == proof["converted"] and proof["error_1"] == proof["rejected"]


@pytest.mark.parametrize("where", ["append", "create"])
def test_one_changed_value_is_found(spark, where, monkeypatch):
    case = Case(spark, reconcile=True)
    real = getattr(CatalogWarehouse, where)
    monkeypatch.setattr(CatalogWarehouse, where, lambda self, df, t, **kw: real(
        self, df.withColumn("s", F.when(F.col("s").isin("new3", "bad"), F.concat("s", F.lit(" "))).otherwise(F.col("s"))), t, **kw))
    with pytest.raises(Unreconciled, match="_ERR_1" if where == "create" else r"\.t and"):
        case.load()


def test_digests_add_up_and_tell_rows_apart(spark):
    df = spark.createDataFrame([(1, None, 0.0, {"a": 1}), (1, None, -0.0, {"a": 1}), (None, "1", float("nan"), None), (2, "x", 1.5, {})],
                               "a int, b string, c double, m map<string,int>")
    parts = [digest(df.where(F.col("a").eqNullSafe(F.lit(v)))) for v in (1, None, 2)]
    whole = digest(df.repartition(5))
    assert parts[0] + parts[1] + parts[2] == whole and whole - parts[2] == parts[0] + parts[1] and whole.rows == 4
    one = [digest(df.limit(0).unionByName(spark.createDataFrame([r], df.schema))) for r in df.collect()]
    assert len(set(one)) == 4
    assert digest(df.unionByName(df)) == whole + whole != whole
