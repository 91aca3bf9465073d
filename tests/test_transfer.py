"""F1-F4 end to end on the given tables, each compared with DuckDB."""

import math

import pytest

import __spark_entry__ as E
from tablemover import CatalogWarehouse, JdbcWarehouse, TableName, extract, load
from tablemover.plans.registry import QUERIES, catalog_spec, create_table, source_database
from tablemover.workspace import new_database, new_run_dir

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 6)) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, df.collect()) == rows_of(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns


def test_extract_without_overwrite_refuses_existing(spark):
    db = source_database(spark, SF, ["nation"])
    path = f"{new_run_dir(spark, 'test')}/nation"
    spec = catalog_spec(source_table=f"{db}.nation", target_path=path, file_format="parquet")
    extract(spark, spec)
    with pytest.raises(Exception, match="already exists"):
        extract(spark, spec)


def test_replace_reports_deleted_rows(spark):
    src = source_database(spark, SF, ["nation"])
    db = new_database(spark, "test")
    create_table(spark, db, "nation", spark.table(f"{src}.nation").schema)
    spec = dict(job_type="hive", hive_database=src, hive_table="nation", target_table=f"{db}.nation")
    first = load(spark, catalog_spec(**spec))
    assert first.deleted is None and first.loaded == 25
    report = load(spark, catalog_spec(replace_target=True, **spec))
    assert report.deleted == 25 and spark.table(f"{db}.nation").count() == 25
    assert report.dropped == [f"{db}.nation_ERR_1"]
    assert report.rejected == {f"{db}.nation_ERR_1": 0} and report.loaded == 25


def test_missing_target_is_an_error(spark):
    src = source_database(spark, SF, ["nation"])
    with pytest.raises(ValueError, match="does not exist"):
        load(spark, catalog_spec(job_type="hive", hive_database=src, hive_table="nation",
                                 target_table="nowhere.nation"))


def test_catalog_warehouse_names_are_quoted(spark):
    assert CatalogWarehouse(spark).name(TableName("t-1", "d")) == "`d`.`t-1`"


def test_jdbc_options_and_split_predicates(spark):
    wh = JdbcWarehouse(spark, "jdbc:x://h", driver="D", user="u", password="secret",
                       extra_options={"fetchsize": "1000", "batchsize": ""})
    assert "secret" not in repr(wh)
    w = wh.write_options(TableName("t", "db"), 24)
    assert w["dbtable"] == "db.t" and w["numPartitions"] == "24" and "batchsize" not in w
    r = wh.read_options(dbtable="db.t", partitionColumn="k", numPartitions=8)
    assert r["fetchsize"] == "1000" and r["numPartitions"] == "8"  # extra options win
    plain = JdbcWarehouse(spark, "jdbc:x://h", driver="D", user="u", password="secret")
    assert plain.read_options(dbtable="db.t")["fetchsize"] == "10000"
    preds = wh.split_predicates("o_orderkey", 4)
    bucket = 'MOD(MOD("o_orderkey", 4) + 4, 4)'
    assert preds == [f'({bucket} = 0 OR "o_orderkey" IS NULL)'] + [f"{bucket} = {i}" for i in (1, 2, 3)]
    with pytest.raises(ValueError, match="JDBC URL"):
        wh.write_options(TableName("t"), 8, insert_method="internal.fastload")
    with pytest.raises(ValueError, match="password"):
        JdbcWarehouse(spark, "jdbc:x://h", driver="D", user="u", password="")


def test_encrypted_password_from_properties(spark, tmp_path):
    import os
    from tablemover.plans.transfer import spec_from_properties
    from test_protect import VECTOR_1_1
    key = tmp_path / "key"
    key.write_text("test1234\n")
    os.chmod(key, 0o400)
    props = {"td.hostname": "h", "td.userid": "u", "target.td.tablename": "db.t",
             "source.hdfs.path": "/in", "hdfs.fileformat": "orcfile",
             "td.encrypted.credential": VECTOR_1_1, "td.crypto.key.path": str(key)}
    spec = spec_from_properties(spark, props, driver="d")
    assert spec.password == "test" and "'test'" not in repr(spec)


def test_avro_without_module_is_a_clear_error(spark, tmp_path):
    from tablemover.sources.files import avro_available, read_avro
    if avro_available(spark):
        pytest.skip("Avro module present")
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_avro(spark, str(tmp_path), schema_inline='{"type": "record", "name": "r", "fields": []}')
    with pytest.raises(ValueError, match="exactly one"):
        read_avro(spark, str(tmp_path), schema_inline="{}", schema_path="/s.avsc")


class _Recorder:
    """Records the reader and writer calls a JDBC transfer makes."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call

    def first(self):
        return (0, 99)


class _FakeSpark:
    def __init__(self):
        self.read = _Recorder()


def test_jdbc_split_reads_build_the_right_calls():
    spark = _FakeSpark()
    wh = JdbcWarehouse(spark, "jdbc:x://h", driver="D", user="u", password="pw")
    wh.read_table(TableName("orders", "db"), splits=4, method="split.by.hash", split_column="o_orderkey")
    name, args, kwargs = spark.read.calls[-1]
    assert name == "jdbc" and args[1] == "db.orders"
    assert kwargs["predicates"] == wh.split_predicates("o_orderkey", 4)
    assert kwargs["properties"]["password"] == "pw"

    spark.read.calls.clear()
    wh.read_table(TableName("orders", "db"), splits=8, method="split.by.partition", split_column="o_orderkey")
    opts = [c[2] for c in spark.read.calls if c[0] == "options"]
    assert any('MIN("o_orderkey")' in o.get("query", "") for o in opts)
    split = [o for o in opts if "partitionColumn" in o][0]
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "99", "8")

    spark.read.calls.clear()
    wh.read_query("SELECT 1 AS k", splits=8)
    assert [o for o in [c[2] for c in spark.read.calls if c[0] == "options"]][0]["query"] == "SELECT 1 AS k"


def test_jdbc_append_uses_writer_count():
    class FakeFrame:
        def __init__(self):
            self.write, self.dealt_to = _Recorder(), None

        def repartition(self, n):
            self.dealt_to = n
            return self

    df = FakeFrame()
    wh = JdbcWarehouse(_FakeSpark(), "jdbc:x://h", driver="D", user="u", password="pw")
    wh.append(df, TableName("t", "db"), writers=8)
    assert df.dealt_to == 8  # a shuffle, so that the source before it keeps its own tasks
    names = [c[0] for c in df.write.calls]
    assert names == ["format", "options", "mode", "save"]
    opts = df.write.calls[1][2]
    assert opts["numPartitions"] == "8" and opts["dbtable"] == "db.t"
    assert df.write.calls[2][1] == ("append",)


def test_jdbc_table_split_defaults_to_primary_key():
    from pyspark.sql import types as T

    class KeyedWarehouse(JdbcWarehouse):
        key = ("o_orderkey", "o_custkey")

        def primary_key(self, table):
            return self.key

        def schema(self, table):
            return T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                                 T.StructField("name", T.StringType())])

    spark = _FakeSpark()
    wh = KeyedWarehouse(spark, "jdbc:x://h", driver="D", user="u", password="pw")
    wh.read_table(TableName("orders", "db"), splits=4)
    name, args, kwargs = spark.read.calls[-1]
    part = 'MOD(MOD("{}", 4) + 4, 4)'
    assert name == "jdbc" and kwargs["predicates"][1] == (
        f"MOD({part.format('o_orderkey')} * 31 + {part.format('o_custkey')}, 4) = 1")
    wh.read_table(TableName("orders", "db"), splits=4, split_column="HASHROW(name)")
    assert spark.read.calls[-1][2]["predicates"][1] == "MOD(MOD(HASHROW(name), 4) + 4, 4) = 1"
    for key, message in (((), "no key to split by"), (("name",), "not integers")):
        wh.key = key
        with pytest.raises(ValueError, match=message):
            wh.read_table(TableName("orders", "db"), splits=4)
        wh.read_table(TableName("orders", "db"), splits=1)  # one connection only when asked for


def test_keyed_load_removes_its_staged_rows(spark):
    import glob
    from tablemover.workspace import work_root
    before = set(glob.glob(f"{work_root(spark)}/tablemover/load-*"))
    E.queries()["dedup_target"](spark, SF).count()
    assert set(glob.glob(f"{work_root(spark)}/tablemover/load-*")) == before


def test_every_survey_id_is_exercised():
    from tablemover.plans.registry import COVERAGE, ORACLE_SQL, QUERIES
    assert set(COVERAGE) == set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    covered = {i for ids in COVERAGE.values() for i in ids}
    expected = {f"S{i}" for i in range(2, 7)} | {f"K{i}" for i in range(1, 5)} \
        | {"R1", "R2", "R3", "C1", "C2", "C3", "F1", "F2", "F3", "F4"}
    assert expected <= covered  # S1 needs the external Avro module (README)


def test_spec_settings_hold_for_the_transfer_only(spark):
    db = source_database(spark, SF, ["nation"])
    path = f"{new_run_dir(spark, 'test')}/nation"
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spec = catalog_spec(source_table=f"{db}.nation", target_path=path, file_format="parquet",
                        spark_settings={"spark.sql.files.maxRecordsPerFile": "5"})
    extract(spark, spec)
    assert len([f for f in __import__("os").listdir(path) if f.endswith(".parquet")]) == 5
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == before


def test_split_predicates_cover_every_row_once(duck):
    """Each row, NULL and negative keys included, falls in exactly one split."""
    wh = JdbcWarehouse(_FakeSpark(), "jdbc:x://h", driver="D", user="u", password="pw")
    hits = " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for p in wh.split_predicates("k", 8))
    n, wrong = duck.execute(f"""
        WITH t AS (SELECT * FROM (VALUES (NULL), (-9223372036854775808), (-7), (0), (5), (15))
                   AS v(k) UNION ALL SELECT o_orderkey FROM orders)
        SELECT COUNT(*), COUNT(*) FILTER (WHERE {hits} <> 1) FROM t""").fetchone()
    assert n > 6 and wrong == 0


def test_text_round_trip_keeps_every_value(spark):
    from tablemover.plans.registry import read_text
    from tablemover.sinks.files import extract_files
    values = ["", None, " padded ", 'q"uote', 'x|y', "line\nbreak", "cr\r\nlf", "back\\slash",
              "#not a comment", '"', "\\\"", "tab\there", "\x00", "\x10n", "\x10", "\n", "\x10\x10e\n\r"]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    path = f"{new_run_dir(spark, 'test')}/edge"
    extract_files(df, path, "textfile", separator="|")
    back = read_text(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_binary_columns_survive_text(spark):
    from tablemover.plans.registry import read_text
    from tablemover.sinks.files import extract_files
    df = spark.sql("SELECT 1L AS id, X'00FF80' AS b UNION ALL SELECT 2L, X'' UNION ALL SELECT 3L, NULL "
                   "UNION ALL SELECT 4L, CAST(repeat('x', 500) AS binary)")
    path = f"{new_run_dir(spark, 'test')}/binary"
    extract_files(df, path, "textfile", separator="|")
    assert sorted(read_text(spark, path, df.schema).collect()) == sorted(df.collect())


def test_foreign_text_with_open_quotes_goes_to_the_first_error_table(spark, tmp_path):
    """A quoted value with a line break, written by another tool: neither half loads as a row."""
    from pyspark.sql import types as T
    from tablemover.operators.rejects import conversion_split
    from tablemover.sources.files import MALFORMED_COLUMN, read_delimited
    (tmp_path / "f.txt").write_text('1,"a\nb"\n2,plain\n3,5" disk\n"4","x"\n\n6,"say ""hi"""\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    good, bad = conversion_split(read_delimited(spark, str(tmp_path / "f.txt"), schema), schema)
    assert sorted(map(tuple, good.collect())) == [(2, "plain"), (3, '5" disk'), (4, "x"), (6, 'say "hi"')]
    assert sorted(r[MALFORMED_COLUMN] for r in bad.collect()) == ['1,"a', 'b"']
    whole = conversion_split(read_delimited(spark, str(tmp_path / "f.txt"), schema, options={"multiLine": "true"}), schema)[0]
    assert (1, "a\nb") in set(map(tuple, whole.collect()))


def test_text_of_one_column_keeps_nulls(spark):
    from tablemover.plans.registry import read_text
    from tablemover.sinks.files import extract_files
    df = spark.createDataFrame([("a",), (None,), ("",), (" ",)], "v string")
    path = f"{new_run_dir(spark, 'test')}/one"
    extract_files(df, path, "textfile", separator="|")
    assert sorted(read_text(spark, path, df.schema).collect(), key=repr) == sorted(df.collect(), key=repr)


def test_staging_off_a_local_master_needs_a_shared_folder():
    from tablemover.workspace import work_root

    class Context:
        master = "spark://h:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(Session())


def test_instants_survive_text_across_time_zones(spark):
    import datetime as dt
    from tablemover.operators.rejects import conversion_split
    from tablemover.sinks.files import extract_files
    from tablemover.sources.files import read_delimited
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = spark.sql("SELECT 1L AS id, TIMESTAMP'2024-03-10 01:30:00.123456' AS ts, "
                       "TIMESTAMP_NTZ'2024-03-10 01:30:00.123456' AS local_ts")
        path = f"{new_run_dir(spark, 'test')}/tz"
        extract_files(df, path, "textfile", separator="|")
        expected = df.selectExpr("unix_micros(ts) AS us", "local_ts").first()
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        good, bad = conversion_split(read_delimited(spark, path, df.schema, "|"), df.schema)
        got = good.selectExpr("unix_micros(ts) AS us", "local_ts").first()
        assert bad.count() == 0 and got.us == expected.us
        assert got.local_ts == dt.datetime(2024, 3, 10, 1, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_jdbc_error_tables_use_the_writer_cap():
    class FakeFrame:
        def __init__(self):
            self.write, self.dealt_to = _Recorder(), None

        def repartition(self, n):
            self.dealt_to = n
            return self

    df = FakeFrame()
    wh = JdbcWarehouse(_FakeSpark(), "jdbc:x://h", driver="D", user="u", password="pw")
    wh.create(df, TableName("t_ERR_1", "db"), writers=8)
    opts = df.write.calls[1][2]
    assert opts["numPartitions"] == "8" and df.write.calls[2][1] == ("errorifexists",)


def test_load_into_a_partitioned_target(spark):
    src = source_database(spark, SF, ["orders"])
    db = new_database(spark, "part")
    spark.sql(f"CREATE TABLE {db}.orders (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_orderstatus STRING) "
              "USING parquet PARTITIONED BY (o_orderstatus)")
    spec = dict(job_type="hive", hive_database=src, hive_table="orders", target_table=f"{db}.orders",
                key_columns=("o_orderkey",))
    load(spark, catalog_spec(**spec))
    report = load(spark, catalog_spec(replace_target=True, **spec))
    got = spark.table(f"{db}.orders")
    want = spark.table(f"{src}.orders")
    assert report.deleted == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_replace_external_partitioned_target_under_dynamic_overwrite(spark, tmp_path):
    src = source_database(spark, SF, ["nation"])
    db = new_database(spark, "ext")
    spark.sql(f"CREATE TABLE {db}.nation (n_nationkey INT, n_name STRING, n_regionkey INT) "
              f"USING parquet PARTITIONED BY (n_regionkey) LOCATION '{tmp_path}/nation'")
    spark.createDataFrame([(99, "OLD", 7)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.insertInto(f"{db}.nation")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        report = load(spark, catalog_spec(job_type="hive", hive_database=src, hive_table="nation",
                                          target_table=f"{db}.nation", replace_target=True))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    got = spark.table(f"{db}.nation")
    assert report.deleted == 1 and got.count() == 25 and got.where("n_name = 'OLD'").count() == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_delete_all_on_an_external_table(spark, tmp_path):
    from tablemover.sinks.tables import replace_target
    db = new_database(spark, "ext")
    spark.sql(f"CREATE TABLE {db}.t (k BIGINT, p STRING) USING parquet PARTITIONED BY (p) "
              f"LOCATION '{tmp_path}/t'")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string").write.insertInto(f"{db}.t")
    assert replace_target(CatalogWarehouse(spark), TableName("t", db)) == 2
    assert spark.table(f"{db}.t").count() == 0 and spark.catalog.tableExists(f"{db}.t")


def test_nested_columns_refused_by_text_extract(spark):
    from tablemover.sinks.files import extract_files
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    with pytest.raises(ValueError, match="to_json"):
        extract_files(emb, f"{new_run_dir(spark, 'test')}/emb", "textfile")


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=25))
def test_text_round_trip_property(spark, values):
    from tablemover.plans.registry import read_text
    from tablemover.sinks.files import extract_files
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    path = f"{new_run_dir(spark, 'prop')}/t"
    extract_files(df, path, "textfile", separator="|")
    back = read_text(spark, path, df.schema)
    assert sorted(((r.id, r.v) for r in back.collect()), key=lambda r: r[0]) == list(enumerate(values))


def test_text_stress_quotes_separators_nul_line_breaks(spark):
    """Values built from the characters that broke text before come back exactly."""
    import random
    from tablemover.operators.rejects import conversion_split
    from tablemover.sinks.files import extract_files
    from tablemover.sources.files import read_delimited
    from pyspark.sql import types as T
    rnd = random.Random(3)
    alphabet = ['"', '|', ',', '\n', '\r', '\\', ' ', '\t', '\x00', '\x10', 'a', 'n', 'é', '𝄞', '#', "'"]
    vals = [None if rnd.random() < 0.05 else "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 10)))
            for _ in range(1000)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame(list(enumerate(vals)), schema).repartition(4)
    path = f"{new_run_dir(spark, 'stress')}/t"
    extract_files(df, path, "textfile", separator="|")
    want = sorted(enumerate(vals), key=lambda r: r[0])
    good, bad = conversion_split(read_delimited(spark, path, schema, "|"), schema)
    assert bad.count() == 0
    assert sorted(((r.id, r.v) for r in good.collect()), key=lambda r: r[0]) == want
