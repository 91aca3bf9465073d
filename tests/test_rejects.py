"""R1-R3 on Spark: conversion and duplicate rejects, skew, reject tables."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemover.operators.rejects import (REASON_COLUMN, conversion_split, duplicate_split,
                                          prepare_reject_tables)
from tablemover.sources.files import MALFORMED_COLUMN, read_delimited
from tablemover.spec import TableName

SF = "/root/testdata/sf0.001"


def multiset(rows):
    rows = rows.collect() if hasattr(rows, "collect") else rows
    return sorted(repr(tuple(r)) for r in rows)


def test_conversion_matches_duckdb(spark, duck):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    target = T.StructType([T.StructField(f.name, T.ByteType() if f.name == "l_orderkey" else f.dataType)
                           for f in li.schema.fields])
    good, bad = conversion_split(li, target)
    n_bad = duck.execute("SELECT COUNT(*) FROM lineitem WHERE TRY_CAST(l_orderkey AS TINYINT) IS NULL").fetchone()[0]
    assert bad.count() == n_bad and good.count() + n_bad == li.count()
    assert good.schema["l_orderkey"].dataType == T.ByteType()
    assert {r[0] for r in bad.select(REASON_COLUMN).distinct().collect()} == {"l_orderkey"}


def test_malformed_text_goes_to_first_error_table(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text("1|F|1.5\nx|F|1.0\n7|O|notnum\n3|O\n")
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("d", T.DoubleType())])
    good, bad = conversion_split(read_delimited(spark, str(path), target, "|"), target)
    assert [tuple(r) for r in good.collect()] == [(1, "F", 1.5)]
    reasons = sorted(r[REASON_COLUMN] for r in bad.collect())
    assert reasons == [MALFORMED_COLUMN, "d", "k"]


def test_not_nullable_target_rejects_null(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k long, s string")
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType(), False)])
    good, bad = conversion_split(df, target)
    assert good.count() == 1 and bad.first()[REASON_COLUMN] == "s"


def test_nested_into_flat_refused(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    target = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.StringType())])
    with pytest.raises(ValueError, match="to_json"):
        conversion_split(emb, target)


def test_duplicates_match_row_number(spark, duck):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    kept, rejects = duplicate_split(li, ["l_orderkey", "l_linenumber"])
    n_keys = duck.execute("SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)").fetchone()[0]
    assert kept.count() == n_keys
    assert multiset(kept.unionByName(rejects)) == multiset(li)


def test_hot_key_and_hot_copies(spark):
    """One key holds a third of the rows, and one row repeats many times."""
    base = spark.range(0, 3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    hot = spark.range(0, 1500).select(F.lit(-1).cast("long").alias("k"), F.col("id").alias("v"))
    copies = spark.range(0, 1500).select(F.lit(-2).cast("long").alias("k"), F.lit(7).cast("long").alias("v"))
    df = base.unionByName(hot).unionByName(copies)
    kept, rejects = duplicate_split(df, ["k"])
    got = {r["k"]: r["v"] for r in kept.collect()}
    assert got[-1] == 0 and got[-2] == 7 and got[5] == 5 and len(got) == 1002
    assert rejects.count() == df.count() - 1002
    assert multiset(kept.unionByName(rejects)) == multiset(df)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=40))
def test_good_plus_rejects_is_input(spark, rows):
    df = spark.createDataFrame(rows, "k long, v long")
    kept, rejects = duplicate_split(df, ["k"])
    assert multiset(kept.unionByName(rejects)) == multiset(rows)
    assert kept.count() == len({r[0] for r in rows})


class RecordingWarehouse:
    """Stand-in warehouse that records calls (the reference's mocked tests)."""

    kind = "catalog"

    def __init__(self, existing):
        self.existing, self.calls = set(existing), []

    def exists(self, t):
        self.calls.append(("exists", t.qualified()))
        return t.qualified() in self.existing

    def drop(self, t):
        self.calls.append(("drop", t.qualified()))


ERRS = (TableName("target_table_ERR_1", "db"), TableName("target_table_ERR_2", "db"))


def test_drop_in_order_when_present():
    wh = RecordingWarehouse({"db.target_table_ERR_1", "db.target_table_ERR_2"})
    assert prepare_reject_tables(wh, ERRS, drop=True) == ["db.target_table_ERR_1", "db.target_table_ERR_2"]
    assert [c for c in wh.calls if c[0] == "drop"] == [("drop", "db.target_table_ERR_1"),
                                                       ("drop", "db.target_table_ERR_2")]


def test_no_drop_when_absent():
    wh = RecordingWarehouse(set())
    assert prepare_reject_tables(wh, ERRS, drop=True) == []
    assert [c[0] for c in wh.calls] == ["exists", "exists"]


def test_leftover_without_drop_is_an_error():
    with pytest.raises(ValueError, match="earlier run"):
        prepare_reject_tables(RecordingWarehouse({"db.target_table_ERR_1"}), ERRS, drop=False)


def test_declared_text_length_is_a_conversion_reject(spark):
    from tablemover import CatalogWarehouse, TransferSpec, load
    from tablemover.workspace import new_database
    db = new_database(spark, "vc")
    spark.sql(f"CREATE TABLE {db}.t (k BIGINT, s VARCHAR(3)) USING parquet")
    spark.sql(f"CREATE TABLE {db}.src USING parquet AS "
              "SELECT * FROM VALUES (1L, 'abc'), (2L, 'abcd'), (3L, 'ab   '), (4L, NULL) AS v(k, s)")
    wh = CatalogWarehouse(spark)
    assert wh.text_limits(TableName("t", db)) == {"s": 3}
    report = load(spark, TransferSpec.build(warehouse="catalog", job_type="hive", hive_database=db,
                                            hive_table="src", target_table=f"{db}.t"))
    assert report.rejected == {f"{db}.t_ERR_1": 1}
    assert sorted(r["k"] for r in spark.table(f"{db}.t").collect()) == [1, 3, 4]
    rejected = spark.table(f"{db}.t_ERR_1").collect()
    assert [(r["k"], r[REASON_COLUMN]) for r in rejected] == [(2, "s")]


def test_names_with_dots_and_spaces(spark):
    from tablemover import TransferSpec, load
    from tablemover.workspace import new_database
    df = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (2, "z", 7), (2, "z", 7)],
                               "`a.b` long, `c d` string, n long")
    kept, rejects = duplicate_split(df, ["a.b"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "x", 5), (2, "z", 7)]
    assert multiset(kept.unionByName(rejects)) == multiset(df)
    target = T.StructType([T.StructField("a.b", T.IntegerType()), T.StructField("c d", T.StringType()),
                           T.StructField("n", T.LongType())])
    good, bad = conversion_split(df, target)
    assert good.count() == 4 and bad.count() == 0

    db = new_database(spark, "names")
    spark.sql(f"CREATE TABLE {db}.t (`a.b` BIGINT, `c d` STRING, n BIGINT) USING parquet")
    df.write.saveAsTable(f"{db}.src")
    spec = TransferSpec.build(warehouse="catalog", job_type="hive", hive_database=db, hive_table="src",
                              target_table=f"{db}.t", key_columns=("a.b",))
    load(spark, spec)
    load(spark, spec)  # every key is now held: all rows go aside
    assert spark.table(f"{db}.t").count() == 2
    assert spark.table(f"{db}.t_ERR_2").count() == 4


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-(2 ** 63), 2 ** 63 - 1)), min_size=1, max_size=40))
def test_conversion_good_plus_rejects_is_input(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    good, bad = conversion_split(df, T.StructType([T.StructField("v", T.ByteType())]))
    fits = [v for v in values if v is None or -128 <= v <= 127]
    assert sorted(map(repr, (r.v for r in good.collect()))) == sorted(map(repr, fits))
    assert bad.count() + len(fits) == len(values)


def bits(rows):
    """Rows with floats told apart to the sign of zero."""
    return sorted(repr(tuple(r)) for r in rows)


def test_duplicates_to_the_bit(spark):
    """-0.0 in keys and values, NaN, NULL keys, map and nested columns, and helper-like names."""
    nan = float("nan")
    rows = [(0.0, -0.0, {"a": 1}, [(1, None)], "x"), (-0.0, 0.0, {"a": 1}, [(1, None)], "x"), (-0.0, -0.0, {}, [], "y"),
            (None, 1.0, None, None, "p"), (None, nan, {"b": 2}, None, "q"), (None, nan, {"b": 2}, None, "q"),
            (nan, 2.0, {}, None, None), (nan, 2.0, {}, None, None), (3.0, None, None, None, "alone")]
    df = spark.createDataFrame(rows, "k0 double, row double, file map<string,int>, place array<struct<a:int,b:string>>, _held string")
    kept, rejects = duplicate_split(df, ["k0"])
    plain = [r.replace("Row(a=1, b=None)", "(1, None)") for r in bits(kept.collect() + rejects.collect())]
    assert plain == bits(rows)
    left = {repr(abs(r.k0) if r.k0 is not None else None): r for r in kept.collect()}
    assert sorted(left) == ["0.0", "3.0", "None", "nan"]
    assert left["None"]["row"] == 1.0 and repr(left["0.0"]["row"]) == "-0.0"


def test_null_keys_are_one_key_against_the_target_too(spark):
    from tablemover import TransferSpec, load
    from tablemover.workspace import new_database
    db = new_database(spark, "nulls")
    spark.sql(f"CREATE TABLE {db}.t (k BIGINT, _held STRING) USING parquet")
    spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k long, _held string").write.saveAsTable(f"{db}.src")
    spec = TransferSpec.build(warehouse="catalog", job_type="hive", hive_database=db, hive_table="src",
                              target_table=f"{db}.t", key_columns=("k",))
    assert load(spark, spec).loaded == 2
    again = load(spark, spec)
    assert again.loaded == 0 and again.rejected[f"{db}.t_ERR_2"] == 3
    assert sorted(map(tuple, spark.table(f"{db}.t").collect()), key=repr) == [(1, "c"), (None, "a")]


def test_a_map_cannot_be_a_key(spark):
    with pytest.raises(ValueError, match="maps"):
        duplicate_split(spark.createDataFrame([({"a": 1},)], "m map<string,int>"), ["m"])


@pytest.mark.parametrize("source, value, target, fits", [
    ("double", 1.7, "int", None), ("double", 2.0, "int", 2), ("double", 2.0 ** 63, "long", None), ("double", -0.0, "int", 0),
    ("double", 16777217.0, "float", None), ("double", 0.5, "float", 0.5), ("double", float("nan"), "int", None),
    ("long", 2 ** 53 + 1, "double", None), ("long", 2 ** 53, "double", float(2 ** 53)), ("int", 2, "boolean", None),
    ("int", 300, "byte", None), ("int", 7, "string", "7"), ("decimal(5,3)", "1.239", "decimal(4,1)", None),
    ("decimal(5,3)", "1.200", "decimal(4,1)", "1.2"), ("timestamp_ntz", "2024-01-01 10:00:00", "date", None),
    ("timestamp_ntz", "2024-01-01 00:00:00", "date", "2024-01-01"), ("string", "1.7", "int", None), ("string", "12", "int", 12),
    ("string", "1.239", "decimal(4,1)", None), ("string", "1.20", "decimal(4,1)", "1.2"), ("string", "1e1", "decimal(4,1)", "10.0"),
    ("string", "2024-01-01 10:00", "date", None), ("string", "2024-01-01", "date", "2024-01-01"), ("string", "0.1", "double", 0.1),
    ("string", "x", "double", None), ("string", "1e400", "double", None), ("string", "-1e39", "float", None), ("string", "1e38", "float", 9.999999680285692e37),
    ("string", "-Infinity", "double", float("-inf")), ("string", "inf", "float", float("inf")), ("string", "1e-400", "double", None),
    ("string", "0.000e5", "double", 0.0), ("string", "2020-01-01 00:00:00.123456789", "timestamp", None),
    ("string", "2020-01-01 00:00:00.123456000", "timestamp_ntz", "2020-01-01 00:00:00.123456"), ("string", "2020-01-01 00:00:00.1234567", "timestamp_ntz", None),
    ("string", "2020-01-01 00:00:00+02:00", "timestamp_ntz", None), ("string", "2020-01-01 00:00:00Z", "timestamp_ntz", None),
    ("string", "12:30:00", "timestamp", None), ("string", "2020-01-01", "timestamp_ntz", "2020-01-01 00:00:00")])
def test_a_value_fits_only_without_loss(spark, source, value, target, fits):
    df = spark.createDataFrame([(value if not isinstance(value, str) else None, str(value))], "v double, s string") \
        if source == "double" else spark.sql(f"SELECT CAST('{value}' AS {source}) AS v")
    df = df.select("v")
    schema = spark.sql(f"SELECT CAST(NULL AS {target}) AS v").schema
    good, bad = conversion_split(df, schema)
    assert bad.count() == (fits is None)
    if fits is not None:
        assert str(good.first().v) == str(fits)


def test_columns_must_match_unless_told(spark):
    from tablemover import TransferSpec, load
    from tablemover.workspace import new_database
    db = new_database(spark, "cols")
    spark.createDataFrame([(1, "a", 2.5)], "id int, nmae string, extra double").write.saveAsTable(f"{db}.src")
    def run(**kw):
        spark.sql(f"DROP TABLE IF EXISTS {db}.t")
        spark.sql(f"CREATE TABLE {db}.t (ID INT, name STRING) USING parquet")
        load(spark, TransferSpec.build(warehouse="catalog", job_type="hive", hive_database=db, hive_table="src",
                                       target_table=f"{db}.t", **kw))
        return tuple(spark.table(f"{db}.t").first())
    with pytest.raises(ValueError, match=r"\['nmae', 'extra'\].*\['name'\]"):
        run()
    assert run(allow_unmatched=True) == (1, None)
    assert run(column_mapping={"id": "id", "name": "nmae"}) == (1, "a")
    with pytest.raises(ValueError, match="unknown columns"):
        run(column_mapping={"name": "nothere"})


def test_json_lines_reject_bad_values_and_lines(spark, tmp_path):
    from tablemover.sources.files import read_files
    path = tmp_path / "in.json"
    path.write_text('{"k": 1, "s": "a", "xs": [1, 2]}\n{"k": "x", "s": "b"}\n{not json\n'
                    '{"k": 3, "s": null, "xs": []}\n')
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("xs", T.ArrayType(T.LongType()))])
    good, bad = conversion_split(read_files(spark, str(path), "json", columns=target), target)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", [1, 2]), (3, None, [])]
    assert sorted(r[REASON_COLUMN] for r in bad.collect()) == [MALFORMED_COLUMN, "k"]


def read_back(spark, path, columns, **options):
    from tablemover.sources.files import read_files
    df = read_files(spark, str(path), "textfile", columns=columns, separator="|", options=options)
    rows = [tuple(r) for r in df.collect()]
    return sorted((r[:-1] for r in rows if r[-1] is None), key=repr), sorted(r[-1] for r in rows if r[-1] is not None)


def test_escape_and_quote_options(spark, tmp_path):
    (tmp_path / "a").write_text('1|"a \\" b"\n2|"open\n3|plain\n4|"two \\\\"\n5|"odd \\"\n')
    assert read_back(spark, tmp_path / "a", ["k", "s"], escape="\\") == (
        [("1", 'a " b'), ("3", "plain"), ("4", "two \\")], ['2|"open', '5|"odd \\"'])
    (tmp_path / "b").write_text("1|'open\n2|'a|b'\n3|say \"x\n4|it's\n")
    good, bad = read_back(spark, tmp_path / "b", ["k", "s"], quote="'")
    assert bad == ["1|'open"] and good == [("2", "a|b"), ("3", 'say "x'), ("4", "it's")]
    assert read_back(spark, tmp_path / "b", ["k", "s"], quote="") == (
        [("1", "'open"), ("3", 'say "x'), ("4", "it's")], ["2|'a|b'"])


def test_foreign_text_keeps_what_looks_like_an_escape(spark, tmp_path):
    from tablemover.sinks.files import extract_files
    from tablemover.sources.files import read_delimited
    (tmp_path / "a").write_text("1|x\x10ny\n2|\x10z\n")
    assert read_back(spark, tmp_path / "a", ["k", "s"]) == ([("1", "x\x10ny"), ("2", "\x10z")], [])
    df = spark.createDataFrame([(1, "x\x10n\ny"), (2, None)], "k int, s string")
    extract_files(df, str(tmp_path / "own"), "textfile", separator="|")
    own = read_delimited(spark, str(tmp_path / "own"), ["k", "s"], "|")
    assert sorted(tuple(r)[:2] for r in own.collect()) == [("1", "x\x10n\ny"), ("2", None)]
    assert read_delimited(spark, str(tmp_path / "own"), ["k", "s"], "|", escaped=False).where("k = '1'").first().s == "x\x10en\x10ny"


def test_a_keyed_load_of_a_column_without_a_type(spark):
    from tablemover import TransferSpec, load
    from tablemover.workspace import new_database
    db = new_database(spark, "void")
    spark.sql(f"CREATE TABLE {db}.t (k TINYINT, s STRING) USING parquet")
    spec = TransferSpec.build(warehouse="catalog", job_type="hive", hive_database=db, hive_table="src", target_table=f"{db}.t", key_columns=("k",))
    report = load(spark, spec, source=spark.sql("SELECT explode(array(1, 1, 500)) AS k, NULL AS s"))
    assert report.loaded == 1 and list(report.rejected.values()) == [1, 1]


def test_texts_beyond_an_integer_type_raise_nothing_inside(spark):
    """A number of more digits than the type holds is told by a range test, not by an exception caught per value."""
    texts = ["1", " 7 ", "127", "128", "-128", "-129", "+5", "1.5", "x", "", None, "1e2", "9223372036854775808", "70000"]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    good, bad = conversion_split(df, T.StructType([T.StructField("k", T.ByteType())]))
    assert sorted(r.k for r in good.where("k IS NOT NULL").collect()) == [-128, 1, 5, 7, 127]
    assert {r.k for r in bad.collect()} == {r.k for r in df.where("k IS NOT NULL AND try_cast(k AS tinyint) IS NULL").collect()}
    assert "as bigint" in good._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rows_are_parted_without_a_shuffle(spark):
    """Repeated keys: the rows that stay and those that go are told by marks and shuffled in neither frame."""
    rows = [(k % 300, k % 7, f"v{k % 11}") for k in range(2000)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "k long, d long, s string").repartition(5)
    kept, rejects = duplicate_split(df, ["k"])
    for part in (kept, rejects):
        assert "hashpartitioning(file" not in (plan := part._jdf.queryExecution().executedPlan().toString()) and "SortMergeJoin" not in plan
        assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "row#" in x]
    assert multiset(kept.unionByName(rejects)) == sorted(repr(r) for r in rows)
    least = {}
    for r in rows:
        rank = tuple((v is not None, v) for v in r[1:])
        least[r[0]] = min(least.get(r[0], (rank, r)), (rank, r), key=lambda x: x[0])
    assert multiset(kept) == sorted(repr(r) for _, r in least.values())


def test_marks_beyond_the_broadcast_are_joined(spark, monkeypatch):
    from tablemover.operators import rejects as R

    df = spark.createDataFrame([(k // 2, k, "x") for k in range(500)], "k long, d long, s string").repartition(3)
    want = [multiset(x) for x in duplicate_split(df, ["k"])]
    monkeypatch.setattr(R, "MOST_BLOCKS", 0)
    assert [multiset(x) for x in duplicate_split(df, ["k"])] == want and len(want[0]) == len(want[1]) == 250
