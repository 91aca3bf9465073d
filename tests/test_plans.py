"""Physical-plan properties the design depends on at scale."""

import base64
import json

from pyspark.sql import types as T

from tablemover.functions.protect import decrypt_columns, encrypt_columns
from tablemover.operators.rejects import conversion_split, duplicate_split
from tablemover.plans.registry import REVENUE_SQL, source_database
from tablemover.sources.files import read_delimited
from tablemover.workspace import new_run_dir, stage

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, build):
    """How many jobs ``build`` starts."""
    sc = spark.sparkContext
    group = f"count-{id(build)}"
    sc.setJobGroup(group, "counted")
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def shuffled_columns(df) -> list[str]:
    """The output of every exchange in the plan that ran."""
    df.collect()
    tree = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in tree.split("\n") if "Exchange hashpartitioning" in line]


def test_unique_keys_shuffle_no_rows(spark):
    """Rows of keys that occur once pass without a shuffle; there is no window, and aggregates are partial."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    kept, rejects = duplicate_split(orders, ["o_orderkey"])
    assert kept.count() == orders.count() and rejects.count() == 0
    for df in (kept, rejects):
        assert "Window" not in physical(df)
        assert not [x for x in shuffled_columns(df) if "o_totalprice" in x]


def test_building_frames_starts_no_job(spark):
    """Encrypting and decrypting look at nothing before an action, whatever the input."""
    customer = spark.read.parquet(f"{SF}/customer.parquet").groupBy("c_name").count()
    for version in ("1.1", "2.0"):
        sealed = encrypt_columns(customer, ["c_name"], "pw", version=version)
        assert jobs_of(spark, lambda: encrypt_columns(customer, ["c_name"], "pw", version=version)) == 0
        assert jobs_of(spark, lambda: decrypt_columns(sealed, ["c_name"], "pw")) == 0
    assert jobs_of(spark, lambda: conversion_split(customer, customer.schema)) == 0


def test_conversion_is_one_narrow_pass(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    target = T.StructType([T.StructField(f.name, T.ByteType() if f.name == "l_orderkey" else f.dataType)
                           for f in li.schema.fields])
    good, bad = conversion_split(li, target)
    for df in (good, bad):
        plan = physical(df)
        assert "Exchange" not in plan and "try_cast(l_orderkey" not in plan


def test_a_text_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a").write_text("1|2.5|x\n")
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
    for df in conversion_split(read_delimited(spark, str(tmp_path / "a"), target, "|"), target):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_extract_query_prunes_columns(spark):
    db = source_database(spark, SF, ["lineitem", "orders"])
    plan = physical(spark.sql(REVENUE_SQL.format(db=f"`{db}`.")))
    assert "l_partkey" not in plan and "o_totalprice" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan


def test_table_extract_scan_has_no_shuffle(spark):
    db = source_database(spark, SF, ["orders"])
    assert "Exchange" not in physical(spark.table(f"{db}.orders"))


def test_decrypt_of_named_salts_runs_no_python(spark):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    sealed = stage(encrypt_columns(customer, ["c_name"], "pw"), f"{new_run_dir(spark, 'plan')}/sealed")
    envelope = json.loads(base64.b64decode(sealed.first()["c_name"]))
    opened = decrypt_columns(sealed, ["c_name"], "pw", version="2.0", salts=[envelope["salt"].partition(":")[0]])
    plan = physical(opened)
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert sorted(opened.collect()) == sorted(customer.collect())


def test_decrypt_has_one_plan_and_no_shuffle(spark):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    plan = physical(decrypt_columns(customer, ["c_name"], "pw"))
    assert "Exchange" not in plan and "Join" not in plan
