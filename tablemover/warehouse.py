"""Where loads go and extracts come from.

Two kinds share one small interface:

* ``CatalogWarehouse`` - tables of the Spark session catalog (in-memory, Hive
  metastore, or any V2 catalog).  Files live in shared storage, so every
  executor reads and writes them directly.
* ``JdbcWarehouse`` - a relational database reached by Spark's JDBC source.
  Reads are split into ``n`` connections; writes use ``numPartitions``
  connections; DDL (exists, drop, delete-all) runs once on the driver.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

from .operators.key_index import candidate_files, indexable, keep_index, read_index
from .operators.names import cols
from .operators.rejects import in_range, key_range
from .operators.splits import in_splits, key_sketch, plan_splits, sql_predicates
from .operators.spread import in_tasks
from .spec import TableName, merge_options

_UNSUPPORTED = re.compile("UNSUPPORTED|NOT_SUPPORTED|_EXTERNAL|external table|does not support|not allowed", re.I)
_CHAR_TYPE = re.compile(r"(?:var)?char\((\d+)\)")


# The retrieve method that splits by quantiles of the split columns.
RANGE_METHOD = "split.by.range"


def split_columns(schema: StructType, given: str | None) -> list[str]:
    """The comma-separated columns under the schema's own spelling."""
    by_lower = {c.lower(): c for c in schema.fieldNames()}
    names = [c.strip() for c in (given or "").split(",") if c.strip()]
    unknown = [c for c in names if c.lower() not in by_lower]
    if not names or unknown:
        raise ValueError(f"{RANGE_METHOD} needs the columns to split by; unknown: {unknown}.")
    return [by_lower[c.lower()] for c in names]


def _quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


class CatalogWarehouse:
    """Tables in the Spark catalog; ``catalog`` picks a non-default one."""

    kind = "catalog"

    def __init__(self, spark: SparkSession, catalog: str | None = None):
        self.spark = spark
        self.catalog = catalog

    def name(self, table: TableName) -> str:
        parts = [p for p in (self.catalog, table.database, table.table) if p]
        return ".".join(_quote(p) for p in parts)

    def exists(self, table: TableName) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def drop(self, table: TableName) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def schema(self, table: TableName) -> StructType:
        return self.spark.table(self.name(table)).schema

    def count(self, table: TableName) -> int:
        return in_tasks(self.spark.table(self.name(table))).count()

    def primary_key(self, table: TableName) -> tuple[str, ...]:
        """Spark's catalog tables declare no enforced key; the caller names one."""
        return ()

    def text_limits(self, table: TableName) -> dict[str, int]:
        """Declared lengths of CHAR(n)/VARCHAR(n) columns, which a write enforces."""
        limits = {}
        for row in self.spark.sql(f"DESCRIBE TABLE {self.name(table)}").collect():
            if not row.col_name or row.col_name.startswith("#"):
                break  # partition and detail sections follow the columns
            m = _CHAR_TYPE.fullmatch((row.data_type or "").strip().lower())
            if m:
                limits[row.col_name] = int(m.group(1))
        return limits

    def delete_all(self, table: TableName) -> int:
        """Delete every row, keep the table and its definition; return the count.
        ``TRUNCATE``; else ``DELETE`` (V2 tables); else, for external file
        tables, an overwrite with no rows."""
        n = self.count(table)
        for statement in ("TRUNCATE TABLE", "DELETE FROM"):
            try:
                self.spark.sql(f"{statement} {self.name(table)}")
                return n
            except AnalysisException as e:  # only "this kind of table does not do that" leads on
                if not _UNSUPPORTED.search(f"{e.getCondition()} {e}"):
                    raise
        self.replace_with(self.spark.createDataFrame([], self.schema(table)), table)
        return n

    def append(self, df: DataFrame, table: TableName, *, writers: int | None = None,
               options: dict[str, str] | None = None) -> None:
        """Insert by column name.  The DataFrame's own partitions are the writers:
        forcing a writer count here would add a shuffle and cap a cluster-wide write."""
        target_cols = self.schema(table).fieldNames()
        df.select(*cols(target_cols)).write.options(**(options or {})).insertInto(self.name(table))

    def replace_with(self, df: DataFrame, table: TableName, *, writers: int | None = None,
                     insert_method: str | None = None) -> int:
        """K2 + K1 in one job: every old row goes, ``df`` comes in; return how
        many rows went.  ``INSERT OVERWRITE`` also serves external tables (which
        refuse ``TRUNCATE``).  Partition overwrite is held static for the write,
        so no old partition survives even when the session overwrites dynamically."""
        n = self.count(table)
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key, None)
        self.spark.conf.set(key, "static")
        try:
            target_cols = self.schema(table).fieldNames()
            df.select(*cols(target_cols)).write.insertInto(self.name(table), overwrite=True)
        finally:
            if before is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, before)
        return n

    def create(self, df: DataFrame, table: TableName, *, fmt: str = "parquet",
               writers: int | None = None) -> None:
        """Write ``df`` as a new table (used for the reject tables)."""
        df.write.format(fmt).mode("errorifexists").saveAsTable(self.name(table))

    def storage(self, table: TableName) -> tuple[str | None, str | None]:
        """(provider, location) of a table of files; (None, None) of any other."""
        told = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()}
        provider = (told.get("Provider") or "").lower()
        if provider not in ("parquet", "orc", "csv", "json", "text") or not told.get("Location"):
            return None, None
        return provider, told["Location"]

    def files(self, table: TableName) -> DataFrame | None:
        """(file, size, changed) of the table's data files, listed by Spark; None for a table of another kind."""
        location = self.storage(table)[1]
        if location is None:
            return None
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
        return listed.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))

    def read_files(self, table: TableName, files: list[str]) -> DataFrame:
        """The rows that lie in some of the table's files; no other file is opened."""
        self.spark.catalog.refreshTable(self.name(table))
        rows = self.spark.table(self.name(table))
        return rows.where(F.col("_metadata.file_path").isin(files)) if files else rows.limit(0)

    def held_keys(self, table: TableName, key: list[str], incoming: DataFrame, *, splits: int | None = None,
                  split_column: str | None = None) -> DataFrame | None:
        """The target's keys that may meet those of ``incoming`` (staged rows), None if no file can have one.  The
        key index beside a parquet table tells which files these are."""
        provider, location = self.storage(table)
        rows = self.spark.table(self.name(table))
        if provider == "parquet" and indexable(incoming.schema, key):
            index = read_index(self.spark, location, incoming.schema, key)
            if index is not None:
                files = candidate_files(index, self.files(table), incoming, key)
                if not files:
                    return None
                rows = self.read_files(table, files)
        return in_range(rows, key[0], key_range(incoming, key[0])).select(*cols(key))

    def keep_key_index(self, table: TableName, key: list[str]) -> None:
        """Bring the key index up to the table's files, where it can have one."""
        provider, location = self.storage(table)
        self.spark.catalog.refreshTable(self.name(table))
        rows = self.spark.table(self.name(table))
        by_lower = {c.lower(): c for c in rows.columns}
        key = [by_lower[k.lower()] for k in key]
        if provider == "parquet" and indexable(rows.schema, key):
            keep_index(location, rows, self.files(table), key)

    def read_table(self, table: TableName, *, splits: int | None = None,
                   method: str | None = None, split_column: str | None = None) -> DataFrame:
        """Whole table.  Splits follow the files (data location), as the
        scan's own partitioning: no repartition, so no shuffle.  With
        ``split.by.range`` they are ranges of the split columns (comma-separated)
        that hold about equal numbers of rows."""
        rows = self.spark.table(self.name(table))
        if method == RANGE_METHOD:
            return in_splits(rows, split_columns(rows.schema, split_column), splits or 1)
        return rows

    def read_query(self, sql: str, *, splits: int | None = None,
                   split_column: str | None = None) -> DataFrame:
        return self.spark.sql(sql)


def _as_pattern(meta, name: str | None) -> str | None:
    """A name for a metadata call that takes patterns: its ``_`` and ``%`` mean themselves."""
    escape = meta.getSearchStringEscape()
    return re.sub(r"[%_]" + (f"|{re.escape(escape)}" if escape else ""), lambda m: (escape or "") + m[0], name) if name else name


class JdbcWarehouse:
    """A relational warehouse behind a JDBC URL."""

    kind = "jdbc"

    def __init__(self, spark: SparkSession, url: str, *, driver: str, user: str,
                 password: str, extra_options: dict[str, str] | None = None,
                 batch_size: int = 10000, fetch_size: int = 10000):
        if not password:
            raise ValueError("A JDBC warehouse needs a password.")
        self.spark = spark
        self.url = url
        self.driver = driver
        self.user = user
        self._password = password
        self.extra_options = dict(extra_options or {})
        self.batch_size = batch_size
        self.fetch_size = fetch_size  # rows per round trip; some drivers default to ~10

    def __repr__(self) -> str:
        return f"JdbcWarehouse(url={self.url!r}, user={self.user!r}, password='***')"

    # -- options ---------------------------------------------------------------
    def base_options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "user": self.user,
                "password": self._password}

    def read_options(self, dbtable: str | None = None, query: str | None = None,
                     **split) -> dict[str, str]:
        opts = self.base_options()
        opts["fetchsize"] = str(self.fetch_size)
        if query is not None:
            opts["query"] = query
        else:
            opts["dbtable"] = dbtable
        opts.update({k: str(v) for k, v in split.items() if v is not None})
        return merge_options(opts, self.extra_options)

    def write_options(self, table: TableName, writers: int | None,
                      insert_method: str | None = None) -> dict[str, str]:
        opts = self.base_options()
        opts["dbtable"] = table.qualified()
        if writers:
            opts["numPartitions"] = str(writers)  # so many connections; ``dealt`` keeps it from narrowing what comes before
        opts["batchsize"] = str(self.batch_size)
        if insert_method not in (None, "", "batch.insert"):
            # Spark's JDBC writer sends batched INSERTs; a vendor bulk protocol is
            # switched on by the driver's own URL parameters instead.
            raise ValueError(f"Insert method {insert_method} is chosen in the JDBC URL, "
                             "not as an insert method; use batch.insert or leave it unset.")
        return merge_options(opts, self.extra_options)

    # -- DDL on the driver (one connection, a few statements) -----------------
    def _connect(self):
        jvm = self.spark.sparkContext._jvm
        jvm.java.lang.Class.forName(self.driver)
        props = jvm.java.util.Properties()
        props.setProperty("user", self.user)
        props.setProperty("password", self._password)
        return jvm.java.sql.DriverManager.getConnection(self.url, props)

    def _execute(self, fn):
        conn = self._connect()
        try:
            return fn(conn)
        finally:
            conn.close()

    def exists(self, table: TableName) -> bool:
        def check(conn):
            meta = conn.getMetaData()
            for db, name in ((table.database, table.table),
                             (table.database and table.database.upper(), table.table.upper())):
                rs = meta.getTables(None, _as_pattern(meta, db), _as_pattern(meta, name), None)
                try:
                    if rs.next():
                        return True
                finally:
                    rs.close()
            return False
        return self._execute(check)

    def primary_key(self, table: TableName) -> tuple[str, ...]:
        """Key columns declared by the database, in key order (empty if none)."""
        def read(conn):
            meta = conn.getMetaData()
            for db, name in ((table.database, table.table),
                             (table.database and table.database.upper(), table.table.upper())):
                rs = meta.getPrimaryKeys(None, db, name)
                cols = []
                try:
                    while rs.next():
                        cols.append((rs.getShort("KEY_SEQ"), rs.getString("COLUMN_NAME")))
                finally:
                    rs.close()
                if cols:
                    return tuple(c for _, c in sorted(cols))
            return ()
        return self._execute(read)

    def text_limits(self, table: TableName) -> dict[str, int]:
        """Declared lengths of CHAR/VARCHAR columns, from the database's metadata."""
        def read(conn):
            meta = conn.getMetaData()
            for db, name in ((table.database, table.table),
                             (table.database and table.database.upper(), table.table.upper())):
                rs = meta.getColumns(None, _as_pattern(meta, db), _as_pattern(meta, name), None)
                limits = {}
                try:
                    while rs.next():
                        if rs.getString("TYPE_NAME").upper() in ("CHAR", "VARCHAR", "NCHAR", "NVARCHAR"):
                            limits[rs.getString("COLUMN_NAME")] = int(rs.getInt("COLUMN_SIZE"))
                finally:
                    rs.close()
                if limits:
                    return limits
            return {}
        return self._execute(read)

    def drop(self, table: TableName) -> None:
        if self.exists(table):
            self._execute(lambda c: c.createStatement().execute(f"DROP TABLE {table.qualified()}"))

    def delete_all(self, table: TableName) -> int:
        def delete(conn):
            conn.setAutoCommit(False)
            n = conn.createStatement().executeUpdate(f"DELETE FROM {table.qualified()}")
            conn.commit()
            return int(n)
        return self._execute(delete)

    def schema(self, table: TableName) -> StructType:
        return self.spark.read.format("jdbc").options(
            **self.read_options(query=f"SELECT * FROM {table.qualified()} WHERE 1 = 0")).load().schema

    def count(self, table: TableName) -> int:
        return self.spark.read.format("jdbc").options(
            **self.read_options(query=f"SELECT COUNT(*) AS n FROM {table.qualified()}")).load().first()[0]

    def append(self, df: DataFrame, table: TableName, *, writers: int | None = None,
               insert_method: str | None = None, options: dict[str, str] | None = None) -> None:
        opts = merge_options(self.write_options(table, writers, insert_method), options)
        self.dealt(df, writers).write.format("jdbc").options(**opts).mode("append").save()

    def replace_with(self, df: DataFrame, table: TableName, *, writers: int | None = None,
                     insert_method: str | None = None) -> int:
        """K2 then K1: delete every row (committed, counted), then append."""
        n = self.delete_all(table)
        self.append(df, table, writers=writers, insert_method=insert_method)
        return n

    def create(self, df: DataFrame, table: TableName, *, fmt: str | None = None,
               writers: int | None = None) -> None:
        """A new table from ``df``, through at most ``writers`` connections."""
        self.dealt(df, writers).write.format("jdbc").options(**self.write_options(table, writers)).mode("errorifexists").save()

    @staticmethod
    def dealt(df: DataFrame, writers: int | None) -> DataFrame:
        """The rows dealt to the connections by a shuffle.  Without it Spark's writer would coalesce, and the
        scan and conversion of the whole source would run in as few tasks as there are connections."""
        return df.repartition(writers) if writers else df

    # -- split reads -------------------------------------------------------------
    def quoted(self, column: str) -> str:
        """A column name as Spark's dialect writes it in the tables it creates."""
        return '"' + column.replace('"', '""') + '"'

    def split_predicates(self, columns, splits: int, *, is_expression: bool = False) -> list[str]:
        """One predicate per bucket: every row in exactly one, rows whose value is NULL in the first.

        ``columns`` are integer columns, all of them weighed in, so that no value of the first one makes a hot
        split; or, with ``is_expression``, one integer-valued SQL expression of the warehouse, such as its own
        hash of a text key.  ``MOD(MOD(c, n) + n, n)`` is never negative and, unlike ``ABS``, cannot overflow on
        the smallest integer; remainders are added up below n * 31^k, so the sum cannot overflow either."""
        names = [columns] if isinstance(columns, str) else list(columns)
        terms = names if is_expression else [self.quoted(c) for c in names]
        part = [f"MOD(MOD({t}, {splits}) + {splits}, {splits})" for t in terms]
        total = part[0]
        for p in part[1:]:
            total = f"MOD({total} * 31 + {p}, {splits})"
        null = " OR ".join(f"{t} IS NULL" for t in terms)
        return [f"({total} = 0 OR {null})"] + [f"{total} = {i}" for i in range(1, splits)]

    def _bounds(self, source_sql: str, column: str) -> tuple:
        row = self.spark.read.format("jdbc").options(**self.read_options(
            query=f"SELECT MIN({self.quoted(column)}) AS lo, MAX({self.quoted(column)}) AS hi FROM {source_sql}")).load().first()
        return row[0], row[1]

    def read_table(self, table: TableName, *, splits: int | None = 8,
                   method: str | None = None, split_column: str | None = None) -> DataFrame:
        """Without a split column, all columns of the table's key are used: the warehouse spreads a table over
        its units by a hash of that key.  A table without one, or with a key of another type than integers,
        needs ``split_column`` (a column, or with a parenthesis in it an integer-valued expression, such as a
        hash of the key); reading it through one connection takes ``splits=1``."""
        if method == RANGE_METHOD and splits and splits > 1:
            return self._range_read(table, splits, split_columns(self.schema(table), split_column))
        if splits and splits > 1 and not split_column:
            schema = self.schema(table)
            types = {f.name.lower(): f.dataType for f in schema.fields}
            split_column = self.primary_key(table)
            if not split_column:
                raise ValueError(f"{table.qualified()} has no key to split by: give a split column or hash expression, or splits=1.")
            other = [c for c in split_column if not isinstance(types.get(c.lower()), IntegralType)]
            if other:
                raise ValueError(f"Key columns {other} of {table.qualified()} are not integers: give a hash expression "
                                 "of the warehouse as the split column, or splits=1.")
        return self._split_read(table.qualified(), splits, method, split_column)

    def _by_predicates(self, source_sql: str, predicates: list[str]) -> DataFrame:
        opts = self.read_options(dbtable=source_sql)
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return self.spark.read.jdbc(self.url, source_sql, predicates=predicates, properties=props)

    def _integer_key(self, table: TableName) -> list[str]:
        types = {f.name.lower(): f.dataType for f in self.schema(table).fields}
        key = list(self.primary_key(table))
        return key if key and all(isinstance(types.get(c.lower()), IntegralType) for c in key) else []

    def _keys_only(self, table: TableName, columns: list[str]) -> DataFrame:
        """The columns alone, through several connections where an integer key tells how to share them out."""
        names = ", ".join(self.quoted(c) for c in columns)
        key = self._integer_key(table)
        if not key:
            return self.spark.read.format("jdbc").options(**self.read_options(query=f"SELECT {names} FROM {table.qualified()}")).load()
        more = "".join(f", {self.quoted(c)}" for c in key if c not in columns)
        return self._by_predicates(f"(SELECT {names}{more} FROM {table.qualified()}) src", self.split_predicates(key, 8)).select(*cols(columns))

    def _range_read(self, table: TableName, splits: int, columns: list[str]) -> DataFrame:
        """Ranges of equal numbers of rows over any orderable columns: their quantiles are taken first, over the
        columns alone.  A hot value is parted further by the table's integer key, if it has one."""
        sketch = key_sketch(self._keys_only(table, columns), columns, max(1024, 16 * splits))
        key = self._integer_key(table)
        return self._by_predicates(table.qualified(), sql_predicates(
            plan_splits(sketch, columns, splits), [self.quoted(c) for c in columns], self.quoted(key[-1]) if key else None))

    def held_keys(self, table: TableName, key: list[str], incoming: DataFrame, *, splits: int | None = None,
                  split_column: str | None = None) -> DataFrame:
        """The target's keys.  Numbers and dates are read within the incoming range.  A key of text, or a part of
        one, is read whole: the database may order text by another rule, under which a range of Spark's would leave
        rows out.  Its splits come from the quantiles of the incoming keys, which cost the database nothing."""
        schema = self.schema(table)
        theirs = {c.lower(): c for c in schema.fieldNames()}
        names = [theirs[c.lower()] for c in key]
        if split_column or not splits or splits <= 1 or self._integer_key(table):
            held = self.read_table(table, splits=splits, split_column=split_column)
        else:
            plan = plan_splits(key_sketch(incoming, key), key, splits)
            held = self._by_predicates(table.qualified(), sql_predicates(plan, [self.quoted(c) for c in names]))
        held = held.select(*[c.alias(k) for c, k in zip(cols(names), key)])
        return held if isinstance(schema[names[0]].dataType, StringType) else in_range(held, key[0], key_range(incoming, key[0]))

    def read_query(self, sql: str, *, splits: int | None = None,
                   split_column: str | None = None) -> DataFrame:
        if not split_column or not splits or splits <= 1:
            return self.spark.read.format("jdbc").options(**self.read_options(query=sql)).load()
        return self._split_read(f"({sql}) src", splits, "split.by.partition", split_column)

    def _split_read(self, source_sql: str, splits, method, column) -> DataFrame:
        reader = self.spark.read.format("jdbc")
        if not splits or splits <= 1:
            return reader.options(**self.read_options(dbtable=source_sql)).load()
        method = method or "split.by.amp"
        if method in ("split.by.partition", "split.by.value"):
            column = column if isinstance(column, str) else column[0]
            lo, hi = self._bounds(source_sql, column)
            if lo is None:
                return reader.options(**self.read_options(dbtable=source_sql)).load()
            return reader.options(**self.read_options(
                dbtable=source_sql, partitionColumn=column, lowerBound=lo, upperBound=hi,
                numPartitions=splits)).load()
        # split.by.hash and split.by.amp: rows grouped by a hash of the key,
        # which is how the warehouse spreads a table over its units.
        expression = isinstance(column, str) and "(" in column
        return self._by_predicates(source_sql, self.split_predicates(column, splits, is_expression=expression))
