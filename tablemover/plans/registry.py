"""The transfers registered with the driver, each over the given tables.

Every function takes ``(spark, sf_dir)``, runs one whole transfer on the tables
of ``sf_dir`` (or on files Spark derives from them) into a fresh catalog
database and a fresh folder, and returns what landed, as a DataFrame.  The
matching ANSI SQL for DuckDB is in ``ORACLE_SQL``.
"""

from __future__ import annotations

from functools import reduce
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.protect import decrypt_columns, encrypt_columns, mask_columns
from ..functions.rotate import registry_table, rotate_columns
from ..operators.rejects import FILE_COLUMN, LINE_COLUMN, REASON_COLUMN, VALUES_COLUMN, conversion_split
from ..operators.spread import wide
from ..sinks.files import extract_files
from ..sources.files import read_delimited
from ..spec import TableName, TransferSpec
from ..workspace import new_database, new_run_dir, stage
from .journal import Interrupted
from .transfer import extract, load

SEP = "|"
PASSPHRASE = "registered-query-pass-phrase"
LINEITEM_KEY = ("l_orderkey", "l_linenumber")

REVENUE_SQL = """
SELECT o.o_orderpriority, l.l_returnflag, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       SUM(l.l_quantity) AS quantity
FROM {db}lineitem l JOIN {db}orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderpriority, l.l_returnflag
"""


# -- helpers ------------------------------------------------------------------
def source_database(spark: SparkSession, sf_dir: str, tables) -> str:
    """A catalog database whose tables are the given parquet files (read only)."""
    db = new_database(spark, "src")
    for t in tables:
        spark.sql(f"CREATE TABLE `{db}`.`{t}` USING parquet LOCATION '{sf_dir}/{t}.parquet'")
    return db


def create_table(spark: SparkSession, db: str, name: str, schema: T.StructType) -> TableName:
    """An empty parquet target table (DDL only, no job)."""
    spark.sql(f"CREATE TABLE `{db}`.`{name}` ({schema.toDDL()}) USING parquet")
    return TableName(name, db)


def read_text(spark: SparkSession, path: str, schema: T.StructType, separator: str | None = SEP) -> DataFrame:
    """Extracted text under its source's types, by the reader and the conversion that a load uses."""
    return conversion_split(read_delimited(spark, path, schema, separator), schema)[0]


def catalog_spec(**kw) -> TransferSpec:
    return TransferSpec.build(warehouse="catalog", **kw)


def _table(spark, db, t) -> DataFrame:
    return spark.table(f"`{db}`.`{t}`")


def _retyped(schema: T.StructType, **types) -> T.StructType:
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType), f.nullable)
                         for f in schema.fields])


# -- extracts (F3, F4; S5, S6, K3, K4) ------------------------------------------
def extract_table_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = source_database(spark, sf_dir, ["orders"])
    path = f"{new_run_dir(spark, 'extract')}/orders"
    extract(spark, catalog_spec(source_table=f"{db}.orders", target_path=path, file_format="parquet"))
    return spark.read.parquet(path)


def extract_table_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in eight ranges of priority and date (text and date, by quantiles), a file for each; the largest holds
    at most twice the median's rows."""
    db = source_database(spark, sf_dir, ["orders"])
    path = f"{new_run_dir(spark, 'extract')}/orders"
    extract(spark, catalog_spec(source_table=f"{db}.orders", target_path=path, file_format="parquet",
                                retrieve_method="split.by.range", split_column="o_orderpriority,o_orderdate"))
    out = spark.read.parquet(path)
    sizes = sorted(r["count"] for r in out.groupBy(F.col("_metadata.file_path")).count().collect())
    if sizes and sizes[-1] > 2 * median(sizes):
        raise AssertionError(f"Splits of unequal size: {sizes}")
    return out


def extract_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = source_database(spark, sf_dir, ["lineitem", "orders"])
    path = f"{new_run_dir(spark, 'extract')}/revenue"
    spec = catalog_spec(source_query=REVENUE_SQL.format(db=f"`{db}`."), target_path=path,
                        file_format="textfile", separator=SEP)
    extract(spark, spec)
    schema = spark.sql(REVENUE_SQL.format(db=f"`{db}`.")).schema
    return read_text(spark, path, schema)


def overwrite_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = source_database(spark, sf_dir, ["orders", "customer"])
    path = f"{new_run_dir(spark, 'extract')}/out"
    extract(spark, catalog_spec(source_table=f"{db}.orders", target_path=path, file_format="orcfile"))
    extract(spark, catalog_spec(source_query=f"SELECT * FROM `{db}`.customer", target_path=path,
                                file_format="orcfile", force_overwrite=True))
    return spark.read.orc(path)


def overwrite_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract that reads the path it replaces."""
    db = source_database(spark, sf_dir, ["customer"])
    path = f"{new_run_dir(spark, 'extract')}/customer"
    extract(spark, catalog_spec(source_table=f"{db}.customer", target_path=path, file_format="orcfile"))
    query = f"SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment, c_acctbal FROM orc.`{path}` WHERE c_acctbal > 0"
    extract(spark, catalog_spec(source_query=query, target_path=path, file_format="orcfile", force_overwrite=True))
    return spark.read.orc(path)


def extract_delimited_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents (separators, quotes and line breaks inside) to text and back."""
    db = source_database(spark, sf_dir, ["documents"])
    path = f"{new_run_dir(spark, 'extract')}/documents"
    extract(spark, catalog_spec(source_table=f"{db}.documents", target_path=path,
                                file_format="textfile", separator=SEP))
    return read_text(spark, path, _table(spark, db, "documents").schema)


def extract_pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages (quotes, commas, line breaks) to comma-separated text and back."""
    db = source_database(spark, sf_dir, ["pages"])
    path = f"{new_run_dir(spark, 'extract')}/pages"
    extract(spark, catalog_spec(source_table=f"{db}.pages", target_path=path, file_format="textfile"))
    return read_text(spark, path, _table(spark, db, "pages").schema, None)


def _roundtrip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Extract to text, then load it with default options; an error row is an error here."""
    src = source_database(spark, sf_dir, [table])
    path = f"{new_run_dir(spark, 'extract')}/{table}"
    extract(spark, catalog_spec(source_table=f"{src}.{table}", target_path=path, file_format="textfile"))
    db = new_database(spark, "wh")
    create_table(spark, db, table, _table(spark, src, table).schema)
    report = load(spark, catalog_spec(source_path=path, file_format="textfile", target_table=f"{db}.{table}"))
    if any(report.rejected.values()):
        raise AssertionError(f"{table} did not come back whole: {report}")
    return _table(spark, db, table)


def roundtrip_pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "pages")


def roundtrip_documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "documents")


# -- loads (F1, F2; S2, S3, S4, K1, K2) ------------------------------------------
def _files_from(spark, sf_dir, table, fmt) -> tuple[str, T.StructType]:
    """Files Spark derives from a given table: the input of a file load."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    path = f"{new_run_dir(spark, 'files')}/{table}"
    extract_files(df, path, fmt, separator=SEP)
    return path, df.schema


def load_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _files_from(spark, sf_dir, "customer", "textfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "customer", schema)
    load(spark, catalog_spec(source_path=path, file_format="textfile", separator=SEP,
                             target_table=f"{db}.customer"))
    return _table(spark, db, "customer")


def load_delimited_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-second timestamps and JSON text through delimited files."""
    path, schema = _files_from(spark, sf_dir, "events", "textfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "events", schema)
    load(spark, catalog_spec(source_path=path, file_format="textfile", separator=SEP,
                             target_table=f"{db}.events", key_columns=("event_id",)))
    return _table(spark, db, "events")


def load_delimited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks inside values, through delimited files."""
    path, schema = _files_from(spark, sf_dir, "documents", "textfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "documents", schema)
    load(spark, catalog_spec(source_path=path, file_format="textfile", separator=SEP,
                             target_table=f"{db}.documents"))
    return _table(spark, db, "documents")


def load_multiline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as foreign CSV: raw line breaks within quotes, read in small splits."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = f"{new_run_dir(spark, 'files')}/pages"

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))

    pages.select(F.concat_ws(",", F.col("page_id").cast("string"), F.coalesce(quoted("url"), F.lit("")),
                             F.coalesce(quoted("html"), F.lit("")))).write.text(path)
    db = new_database(spark, "wh")
    create_table(spark, db, "pages", pages.schema)
    load(spark, catalog_spec(source_path=path, file_format="textfile", target_table=f"{db}.pages", source_options={"multiLine": "true"},
                             spark_settings={"spark.sql.files.maxPartitionBytes": "65536"}))
    return _table(spark, db, "pages")


def load_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _files_from(spark, sf_dir, "part", "orcfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "part", schema)
    load(spark, catalog_spec(source_path=path, file_format="orcfile", target_table=f"{db}.part"))
    return _table(spark, db, "part")


def load_orc_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested column (array of floats) into a catalog target of the same type."""
    path, schema = _files_from(spark, sf_dir, "embeddings", "orcfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "embeddings", schema)
    load(spark, catalog_spec(source_path=path, file_format="orcfile", target_table=f"{db}.embeddings",
                             key_columns=("vec_id",)))
    return _table(spark, db, "embeddings")


def load_drifted_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of three schemas: narrow keys, a key as text, and one that lacks a column and has decimals."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = f"{new_run_dir(spark, 'files')}/orders"
    rest = F.coalesce(F.pmod("o_orderkey", F.lit(3)), F.lit(0))
    orders.where(rest == 0).withColumn("o_orderkey", F.col("o_orderkey").cast("int")).write.orc(f"{path}/a")
    orders.where(rest == 1).withColumn("o_custkey", F.col("o_custkey").cast("string")).write.orc(f"{path}/b")
    orders.where(rest == 2).drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,0)")).write.orc(f"{path}/c")
    db = new_database(spark, "wh")
    create_table(spark, db, "orders", orders.schema)
    load(spark, catalog_spec(source_path=path, file_format="orcfile", target_table=f"{db}.orders", source_options={"driftingSchemas": "true"}))
    return _table(spark, db, "orders")


def load_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = source_database(spark, sf_dir, ["supplier"])
    db = new_database(spark, "wh")
    create_table(spark, db, "supplier", _table(spark, src, "supplier").schema)
    load(spark, catalog_spec(job_type="hive", hive_database=src, hive_table="supplier",
                             target_table=f"{db}.supplier"))
    return _table(spark, db, "supplier")


def replace_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _files_from(spark, sf_dir, "customer", "orcfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "customer", schema)
    spec = dict(source_path=path, file_format="orcfile", target_table=f"{db}.customer")
    load(spark, catalog_spec(**spec))
    report = load(spark, catalog_spec(replace_target=True, **spec))
    if report.deleted is None:
        raise AssertionError("replace did not report a count")
    return _table(spark, db, "customer")


# -- rejects (R1, R2, R3) ----------------------------------------------------------
def _lineitem_load(spark, sf_dir, *, narrow_key: bool, key: bool, runs: int = 1):
    src = source_database(spark, sf_dir, ["lineitem"])
    db = new_database(spark, "wh")
    schema = _table(spark, src, "lineitem").schema
    if narrow_key:
        schema = _retyped(schema, l_orderkey=T.ByteType())
    create_table(spark, db, "lineitem", schema)
    spec = catalog_spec(job_type="hive", hive_database=src, hive_table="lineitem",
                        target_table=f"{db}.lineitem", replace_target=True,
                        key_columns=LINEITEM_KEY if key else ())
    for _ in range(runs):
        load(spark, spec)
    return db, spec


def reject_existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load lineitem, then append it again: every row of the second run breaks
    the key (a copy within the rows or a key the target holds)."""
    src = source_database(spark, sf_dir, ["lineitem"])
    db = new_database(spark, "wh")
    create_table(spark, db, "lineitem", _table(spark, src, "lineitem").schema)
    spec = catalog_spec(job_type="hive", hive_database=src, hive_table="lineitem",
                        target_table=f"{db}.lineitem", key_columns=LINEITEM_KEY)
    load(spark, spec)
    load(spark, spec)
    return _by_role(spark, db, [("target", "lineitem"), ("ERR_2", spec.error_tables[1].table)])


def _by_role(spark: SparkSession, db: str, roles) -> DataFrame:
    """The rows of several tables, each with its table's role; the narrowed key in its first type again."""
    parts = []
    for role, name in roles:
        t = _table(spark, db, name)
        if REASON_COLUMN not in t.columns:
            t = t.withColumn(REASON_COLUMN, F.lit(None).cast("string"))
        parts.append(t.withColumns({"table_role": F.lit(role), "l_orderkey": F.col("l_orderkey").cast("long")}))
    return reduce(DataFrame.unionByName, parts)


def reject_hot_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skew on the given data: whole lineitem rows keyed by the return flag, so that
    each of three keys holds about a third of all rows; all but three rows are rejects."""
    path, schema = _files_from(spark, sf_dir, "lineitem", "orcfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "flags", schema)
    spec = catalog_spec(source_path=path, file_format="orcfile", target_table=f"{db}.flags",
                        key_columns=("l_returnflag",), replace_target=True)
    load(spark, spec)
    return _table(spark, db, spec.error_tables[1].table)


def reject_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, spec = _lineitem_load(spark, sf_dir, narrow_key=True, key=False)
    return _table(spark, db, spec.error_tables[0].table)


def reject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, spec = _lineitem_load(spark, sf_dir, narrow_key=False, key=True)
    return _table(spark, db, spec.error_tables[1].table)


def dedup_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that stay: one per key, the least by the other columns."""
    db, spec = _lineitem_load(spark, sf_dir, narrow_key=False, key=True)
    return _table(spark, db, "lineitem")


def reject_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with drop + replace: counts are those of one run."""
    db, spec = _lineitem_load(spark, sf_dir, narrow_key=True, key=True, runs=2)
    return _by_role(spark, db, [("target", "lineitem"), ("ERR_1", spec.error_tables[0].table),
                                ("ERR_2", spec.error_tables[1].table)])


def reject_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices into an integer column: those with cents would lose them and go aside."""
    src = source_database(spark, sf_dir, ["lineitem"])
    db = new_database(spark, "wh")
    schema = _retyped(_table(spark, src, "lineitem").schema, l_extendedprice=T.IntegerType())
    create_table(spark, db, "lineitem", schema)
    spec = catalog_spec(job_type="hive", hive_database=src, hive_table="lineitem", target_table=f"{db}.lineitem")
    load(spark, spec)
    good = _table(spark, db, "lineitem").withColumns({
        "l_extendedprice": F.col("l_extendedprice").cast("double"), REASON_COLUMN: F.lit(None).cast("string")})
    return good.unionByName(_table(spark, db, spec.error_tables[0].table))


def reject_lossy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as foreign text (backslash escapes, apostrophes for quotes) whose moments have nine decimals and whose
    amounts have exponents: what the types cannot hold goes aside, with the text it came as."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = f"{new_run_dir(spark, 'files')}/events"
    told = F.concat("props", F.lit(" it's a \\ b"))
    quoted = F.concat(F.lit("'"), F.regexp_replace(told, r"(['\\])", r"\\$1"), F.lit("'"))
    lines = events.select(F.concat_ws("|", F.col("event_id").cast("string"), F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad((F.col("event_id") % 4 * 250).cast("string"), 3, "0")),
        F.concat((F.col("event_id") % 1000 + 1).cast("string"), F.lit("e"), (F.col("event_id") % 5 * 100).cast("string")),
        F.coalesce(quoted, F.lit(""))))
    lines.write.text(path)
    db = new_database(spark, "wh")
    create_table(spark, db, "moments", T.StructType([T.StructField("event_id", T.LongType()), T.StructField("moment", T.TimestampNTZType()),
                                                     T.StructField("amount", T.DoubleType()), T.StructField("props", T.StringType())]))
    spec = catalog_spec(source_path=path, file_format="textfile", separator=SEP, target_table=f"{db}.moments",
                        source_options={"quote": "'", "escape": "\\"})
    load(spark, spec)
    good = _table(spark, db, "moments").select("event_id", F.date_format("moment", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"),
                                               F.col("amount").isNotNull().alias("has_amount"), "props")
    bad = _table(spark, db, spec.error_tables[0].table)
    return good.withColumn(REASON_COLUMN, F.lit(None).cast("string")).unionByName(bad.select(
        F.col("event_id").cast("long").alias("event_id"), "moment", F.col("amount").isNotNull().alias("has_amount"), "props", REASON_COLUMN))


def reject_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as sorted text files (by the order's remainder), read in small splits; the rejects of narrow columns
    tell the line and the values that did not fit."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = f"{new_run_dir(spark, 'files')}/lineitem"
    parts = 16 + items.count() // 1_000_000
    dealt = items.withColumn("part", F.coalesce(F.pmod("l_orderkey", F.lit(parts)), F.lit(0)))
    lines = dealt.repartition(parts, "part").sortWithinPartitions("part", *items.columns)
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("l_orderkey", "l_partkey", "l_linenumber")])
    lines.select("part", line.alias("line")).write.partitionBy("part").text(path)
    db = new_database(spark, "wh")
    create_table(spark, db, "items", T.StructType([T.StructField("l_orderkey", T.ByteType()), T.StructField("l_partkey", T.ShortType()),
                                                   T.StructField("l_linenumber", T.IntegerType())]))
    spec = catalog_spec(source_path=path, file_format="textfile", separator=SEP, target_table=f"{db}.items", reject_addresses=True,
                        spark_settings={"spark.sql.files.maxPartitionBytes": "16384"})
    load(spark, spec)
    bad = _table(spark, db, spec.error_tables[0].table)
    told = F.array_join(F.transform(VALUES_COLUMN, lambda v: F.concat_ws("=", v["column"], v["value"])), ";")
    return bad.select(F.regexp_extract(FILE_COLUMN, r"part=(\d+)", 1).cast("long").alias("part"), LINE_COLUMN, REASON_COLUMN, told.alias("told"),
                      "l_orderkey", "l_partkey", "l_linenumber")


# -- loads that are cut short, and loads that are proved (F1, F2) ---------------------------
def resume_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended in two journaled loads.  The second stops when its rows are in the target but before that is
    on record; run again, it takes them back and goes on, without its source."""
    path, schema = _files_from(spark, sf_dir, "orders", "orcfile")
    db = new_database(spark, "wh")
    create_table(spark, db, "orders", schema)
    spec = catalog_spec(source_path=path, file_format="orcfile", target_table=f"{db}.orders", key_columns=("o_custkey",),
                        journal=new_run_dir(spark, "journal"))
    load(spark, spec, source=spark.read.orc(path).where("o_orderkey % 2 = 0"))
    rest = spark.read.orc(path).where("o_orderkey % 2 = 1")
    try:
        load(spark, spec, source=rest, stop_after="changing")
    except Interrupted:
        rest.where("o_orderkey % 3 = 0").write.insertInto(f"`{db}`.orders")  # as far as the lost driver came
    report = load(spark, spec, source=rest.limit(0))
    if report.resumed != "changing":
        raise AssertionError(f"The load did not go on where it stopped: {report}")
    parts = [_table(spark, db, name).withColumn("table_role", F.lit(role))
             for role, name in (("target", "orders"), ("ERR_2", spec.error_tables[1].table))]
    return parts[0].unionByName(parts[1])


def reconcile_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem into a narrow key, duplicates aside; the load proves by digests that the source's rows are the
    target's and the rejects'.  The result has the proof's counts and what it agrees on."""
    src = source_database(spark, sf_dir, ["lineitem"])
    db = new_database(spark, "wh")
    create_table(spark, db, "lineitem", _retyped(_table(spark, src, "lineitem").schema, l_orderkey=T.ByteType()))
    report = load(spark, catalog_spec(job_type="hive", hive_database=src, hive_table="lineitem", target_table=f"{db}.lineitem",
                                      key_columns=LINEITEM_KEY, reconcile=True))
    p = report.proof
    names = spark.createDataFrame([(n, p[n].rows) for n in sorted(p)], "part string, n long")
    agree = p["gained"] + p["error_2"] == p["converted"] and p["error_1"] == p["rejected"]
    return names.withColumn("agrees", F.lit(agree))


# -- protection (C1, C2, C3) ---------------------------------------------------------
def encrypt_decrypt(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    at_rest = stage(encrypt_columns(customer, ["c_name", "c_mktsegment"], PASSPHRASE),
                    f"{new_run_dir(spark, 'protect')}/customer")
    return decrypt_columns(at_rest, ["c_name", "c_mktsegment"], PASSPHRASE)


def encrypt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents (up to tens of thousands of words) sealed and opened."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at_rest = stage(encrypt_columns(documents, ["text"], PASSPHRASE),
                    f"{new_run_dir(spark, 'protect')}/documents")
    return decrypt_columns(at_rest, ["text"], PASSPHRASE)


def decrypt_mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    mixed = (encrypt_columns(customer, ["c_name"], PASSPHRASE, version="1.1")
             .unionByName(encrypt_columns(customer, ["c_name"], PASSPHRASE, version="2.0")))
    at_rest = stage(mixed, f"{new_run_dir(spark, 'protect')}/mixed")
    ver = F.get_json_object(F.unbase64(F.col("c_name")).cast("string"), "$.ver")
    return decrypt_columns(at_rest.withColumn("ver", ver), ["c_name"], PASSPHRASE, tasks=wide(spark))


def rotate_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names under an old pass phrase, a quarter of them as ``1.1``, rotated in three batches: stopped after
    the first, run again, and run once more, which seals nothing.  The registry accounts for every value."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    root = new_run_dir(spark, "rotate")
    old = (encrypt_columns(customer.where("c_custkey % 4 = 0"), ["c_name"], "old " + PASSPHRASE, version="1.1")
           .unionByName(encrypt_columns(customer.where("c_custkey % 4 <> 0 OR c_custkey IS NULL"), ["c_name"], "old " + PASSPHRASE)))
    at_rest = stage(old.repartition(6), f"{root}/customer")
    files = -(-len(at_rest.inputFiles()) // 3)
    rotated = [rotate_columns(spark, f"{root}/customer", ["c_name"], "old " + PASSPHRASE, PASSPHRASE, f"{root}/work", files=files, stop_after=n)
               for n in (1, None, None)]
    known = registry_table(spark, f"{root}/work")
    rows = spark.read.parquet(f"{root}/customer")
    if rotated[2] or sum(rotated) != rows.where("c_name IS NOT NULL").count() or known.agg(F.sum("rows")).first()[0] != sum(rotated):
        raise AssertionError(f"Sealed {rotated}")
    ver = F.get_json_object(F.unbase64(F.col("c_name")).cast("string"), "$.ver")
    return decrypt_columns(rows.withColumn("ver", ver), ["c_name"], PASSPHRASE)


def mask_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_columns(spark.read.parquet(f"{sf_dir}/customer.parquet"), ["c_name"])


QUERIES = {
    "extract_table_split": extract_table_split,
    "extract_table_ranges": extract_table_ranges,
    "extract_query": extract_query,
    "overwrite_extract": overwrite_extract,
    "overwrite_self": overwrite_self,
    "extract_delimited_text": extract_delimited_text,
    "extract_pages_text": extract_pages_text,
    "roundtrip_pages_text": roundtrip_pages_text,
    "roundtrip_documents_text": roundtrip_documents_text,
    "load_delimited": load_delimited,
    "load_delimited_events": load_delimited_events,
    "load_delimited_documents": load_delimited_documents,
    "load_multiline_pages": load_multiline_pages,
    "load_orc": load_orc,
    "load_orc_embeddings": load_orc_embeddings,
    "load_drifted_orc": load_drifted_orc,
    "load_catalog_table": load_catalog_table,
    "replace_target": replace_target,
    "reject_conversion": reject_conversion,
    "reject_lossy": reject_lossy,
    "reject_duplicates": reject_duplicates,
    "dedup_target": dedup_target,
    "reject_tables": reject_tables,
    "reject_existing_keys": reject_existing_keys,
    "reject_hot_copies": reject_hot_copies,
    "reject_lossy_text": reject_lossy_text,
    "reject_addresses": reject_addresses,
    "resume_load": resume_load,
    "reconcile_load": reconcile_load,
    "encrypt_decrypt": encrypt_decrypt,
    "encrypt_documents": encrypt_documents,
    "decrypt_mixed_versions": decrypt_mixed_versions,
    "rotate_envelopes": rotate_envelopes,
    "mask_columns": mask_columns_query,
}

COVERAGE = {
    "extract_table_split": ("S5", "K3", "F3"),
    "extract_table_ranges": ("S5", "K3", "F3"),
    "extract_query": ("S6", "K3", "F4"),
    "overwrite_extract": ("S5", "S6", "K3", "K4", "F3", "F4"),
    "overwrite_self": ("S6", "K3", "K4", "F4"),
    "extract_delimited_text": ("S5", "K3", "F3"),
    "extract_pages_text": ("S5", "K3", "F3"),
    "roundtrip_pages_text": ("S5", "K3", "F3", "S2", "R1", "K1", "F1"),
    "roundtrip_documents_text": ("S5", "K3", "F3", "S2", "R1", "K1", "F1"),
    "load_delimited": ("S2", "R1", "R3", "K1", "F1"),
    "load_delimited_events": ("S2", "R1", "R2", "R3", "K1", "F1"),
    "load_delimited_documents": ("S2", "R1", "R3", "K1", "F1"),
    "load_multiline_pages": ("S2", "R1", "K1", "F1"),
    "load_orc": ("S3", "R1", "R3", "K1", "F1"),
    "load_orc_embeddings": ("S3", "R1", "R2", "K1", "F1"),
    "load_drifted_orc": ("S3", "R1", "K1", "F1"),
    "load_catalog_table": ("S4", "R1", "R3", "K1", "F2"),
    "replace_target": ("S3", "K2", "K1", "F1"),
    "reject_conversion": ("S4", "R1", "K2", "F2"),
    "reject_lossy": ("S4", "R1", "K1", "F2"),
    "reject_duplicates": ("S4", "R2", "K2", "F2"),
    "dedup_target": ("S4", "R2", "K1", "F2"),
    "reject_tables": ("S4", "R1", "R2", "R3", "K2", "F2"),
    "reject_existing_keys": ("S4", "R2", "R3", "K1", "F2"),
    "reject_hot_copies": ("S3", "R2", "K2", "K1", "F1"),
    "reject_lossy_text": ("S2", "R1", "K1", "F1"),
    "reject_addresses": ("S2", "R1", "F1"),
    "resume_load": ("S3", "R2", "R3", "K1", "F1"),
    "reconcile_load": ("S4", "R1", "R2", "K1", "F2"),
    "encrypt_decrypt": ("C1", "C2"),
    "encrypt_documents": ("C1", "C2"),
    "decrypt_mixed_versions": ("C1", "C2"),
    "rotate_envelopes": ("C1", "C2"),
    "mask_columns": ("C3",),
}

_LINEITEM_OTHERS = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                    "l_returnflag, l_linestatus, l_shipdate")
_RANKED = f"""
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY {_LINEITEM_OTHERS.replace(', ', ' NULLS FIRST, ')} NULLS FIRST) AS rn
FROM {{source}}
"""
_BY_FLAG = ", ".join(f"{c} NULLS FIRST" for c in (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_linestatus, l_shipdate").split(", "))
_NARROW_FIT = "(l_orderkey IS NULL OR TRY_CAST(l_orderkey AS TINYINT) IS NOT NULL)"

ORACLE_SQL = {
    "extract_table_split": "SELECT * FROM orders",
    "extract_table_ranges": "SELECT * FROM orders",
    "extract_query": REVENUE_SQL.format(db=""),
    "overwrite_extract": "SELECT * FROM customer",
    "overwrite_self": "SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0",
    "extract_delimited_text": "SELECT * FROM documents",
    "extract_pages_text": "SELECT * FROM pages",
    "load_delimited_events": "SELECT * FROM events",
    "load_delimited_documents": "SELECT * FROM documents",
    "encrypt_documents": "SELECT * FROM documents",
    "load_delimited": "SELECT * FROM customer",
    "load_multiline_pages": "SELECT * FROM pages",
    "load_orc": "SELECT * FROM part",
    "load_orc_embeddings": "SELECT * FROM embeddings",
    "load_drifted_orc": """
        SELECT * EXCLUDE (o_orderpriority), CASE WHEN ((o_orderkey % 3) + 3) % 3 = 2 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "load_catalog_table": "SELECT * FROM supplier",
    "replace_target": "SELECT * FROM customer",
    "reject_conversion": f"SELECT *, 'l_orderkey' AS {REASON_COLUMN} FROM lineitem WHERE NOT {_NARROW_FIT}",
    "reject_duplicates": (f"SELECT * EXCLUDE (rn) FROM ({_RANKED.format(source='lineitem')}) r "
                          "WHERE rn > 1"),
    "dedup_target": (f"SELECT * EXCLUDE (rn) FROM ({_RANKED.format(source='lineitem')}) r "
                     "WHERE rn = 1"),
    "reject_tables": f"""
        WITH fit AS (SELECT * FROM lineitem WHERE {_NARROW_FIT}),
             ranked AS ({_RANKED.format(source='fit')})
        SELECT * EXCLUDE (rn), NULL::VARCHAR AS {REASON_COLUMN},
               CASE WHEN rn = 1 THEN 'target' ELSE 'ERR_2' END AS table_role FROM ranked
        UNION ALL SELECT *, 'l_orderkey', 'ERR_1' FROM lineitem WHERE NOT {_NARROW_FIT}""",
    "reject_existing_keys": f"""
        WITH ranked AS ({_RANKED.format(source='lineitem')})
        SELECT * EXCLUDE (rn), NULL::VARCHAR AS {REASON_COLUMN}, 'target' AS table_role FROM ranked WHERE rn = 1
        UNION ALL SELECT *, NULL, 'ERR_2' FROM lineitem""",
    "reject_hot_copies": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_BY_FLAG}) AS rn FROM lineitem) r
        WHERE rn > 1""",
    "reject_lossy_text": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                   || CASE WHEN fine OR big THEN lpad(CAST(event_id % 4 * 250 AS VARCHAR), 3, '0') ELSE '' END AS moment,
               true AS has_amount, props || ' it''s a \\ b' AS props,
               CASE WHEN fine AND big THEN 'moment,amount' WHEN fine THEN 'moment' WHEN big THEN 'amount' END AS {REASON_COLUMN}
        FROM (SELECT *, event_id % 4 > 0 AS fine, event_id % 5 = 4 AS big FROM events) e""",
    "reject_addresses": f"""
        WITH n AS (SELECT 16 + count(*) // 1000000 AS parts FROM lineitem),
             lines AS (SELECT l_orderkey, l_partkey, l_linenumber, coalesce(((l_orderkey % parts) + parts) % parts, 0) AS part,
                              row_number() OVER (PARTITION BY coalesce(((l_orderkey % parts) + parts) % parts, 0) ORDER BY
                                  l_orderkey NULLS FIRST, l_partkey NULLS FIRST, {_LINEITEM_OTHERS.replace('l_partkey, l_suppkey,', 'l_suppkey NULLS FIRST, l_linenumber NULLS FIRST,').replace(', l_', ' NULLS FIRST, l_').replace('NULLS FIRST NULLS', 'NULLS')} NULLS FIRST) AS line
                       FROM lineitem, n),
             judged AS (SELECT *, TRY_CAST(l_orderkey AS TINYINT) IS NULL AND l_orderkey IS NOT NULL AS bad_key,
                               TRY_CAST(l_partkey AS SMALLINT) IS NULL AND l_partkey IS NOT NULL AS bad_part FROM lines)
        SELECT part, line AS reject_line, concat_ws(',', CASE WHEN bad_key THEN 'l_orderkey' END, CASE WHEN bad_part THEN 'l_partkey' END) AS reject_reason,
               concat_ws(';', CASE WHEN bad_key THEN 'l_orderkey=' || l_orderkey END, CASE WHEN bad_part THEN 'l_partkey=' || l_partkey END) AS told,
               CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber
        FROM judged WHERE bad_key OR bad_part""",
    "resume_load": """
        WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_orderkey NULLS FIRST) AS rn FROM orders)
        SELECT * EXCLUDE (rn), CASE WHEN rn = 1 THEN 'target' ELSE 'ERR_2' END AS table_role FROM ranked
        WHERE rn = 1 OR o_orderkey % 2 = 1""",
    "reconcile_load": f"""
        WITH fit AS (SELECT * FROM lineitem WHERE {_NARROW_FIT}),
             n AS (SELECT (SELECT count(*) FROM lineitem) AS source, (SELECT count(*) FROM fit) AS converted,
                          (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM fit)) AS gained)
        SELECT unnest(['source', 'converted', 'rejected', 'error_1', 'error_2', 'gained']) AS part,
               unnest([source, converted, source - converted, source - converted, converted - gained, gained]) AS n, true AS agrees FROM n""",
    "reject_lossy": f"""
        SELECT *, CASE WHEN CAST(TRY_CAST(l_extendedprice AS INTEGER) AS DOUBLE) = l_extendedprice OR l_extendedprice IS NULL
                       THEN NULL ELSE 'l_extendedprice' END AS {REASON_COLUMN} FROM lineitem""",
    "roundtrip_pages_text": "SELECT * FROM pages",
    "roundtrip_documents_text": "SELECT * FROM documents",
    "encrypt_decrypt": "SELECT * FROM customer",
    "decrypt_mixed_versions": ("SELECT *, '1.1' AS ver FROM customer "
                               "UNION ALL SELECT *, '2.0' AS ver FROM customer"),
    "rotate_envelopes": "SELECT *, '2.0' AS ver FROM customer",
    "mask_columns": ("SELECT c_custkey, repeat('*', length(c_name)) AS c_name, c_nationkey, "
                     "c_acctbal, c_mktsegment FROM customer"),
}
