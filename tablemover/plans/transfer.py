"""Whole transfers, each a composition of sources, rejects and sinks.

Load (F1 files -> table, F2 catalog table -> table):
    read -> R1 conversion rejects -> R2 duplicate rejects (within the rows, and
    against keys the target already holds unless it is replaced) -> R3 drop
    leftovers -> write both reject tables -> K2 + K1: replace (a catalog target
    in one INSERT OVERWRITE job; JDBC: DELETE, then append) or append.
The rejects are written before the target is touched, so a failure while
computing them leaves the target as it was.

Extract (F3 table -> files, F4 query -> files):
    S5 split read or S6 query -> K4 overwrite -> K3 write.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import Digest, Unreconciled, digest
from ..operators.rejects import (checked_key, conversion_split, converted_rows, converted_sides, held_rows, matched_columns,
                                 plain, prepare_reject_tables, repeated_rows, split_rows, stage_out, staged_conversion,
                                 staged_rows, with_addresses, without_rows)
from ..sinks.files import extract_files
from ..sinks.tables import load_table, replace_and_load
from ..sources.files import ADDRESS_COLUMN, line_bases, read_avro_schema_file, read_files, spark_format
from ..sources.tables import read_catalog_table, read_query, read_table_split
from ..functions.protect import decrypt_columns, read_passphrase
from ..spec import CRYPTO_KEY_PATH_KEY, ENCRYPTED_CREDENTIAL_KEY, Direction, TableName, TransferSpec
from ..warehouse import CatalogWarehouse, JdbcWarehouse
from ..workspace import discard, exists, new_run_dir, stage
from .journal import Entry, Interrupted, Journal, spec_digest


@dataclass
class LoadReport:
    target: str
    deleted: int | None = None
    dropped: list[str] = field(default_factory=list)
    error_tables: tuple[str, ...] = ()
    rejected: dict[str, int] = field(default_factory=dict)  # rows per error table
    loaded: int | None = None  # rows the target gained (or holds, after a replace)
    resumed: str | None = None  # the journal's phase from which the load went on
    proof: dict[str, Digest] | None = None  # digests that were found to agree (reconcile)


def decrypt_value(spark: SparkSession, envelope: str, key_path: str) -> str:
    """Open one secret (a connection password) with the pass phrase of a
    0400 key file; both stay on the driver and out of every plan."""
    passphrase = read_passphrase(key_path, spark)
    row = decrypt_columns(spark.createDataFrame([(envelope,)], "v string"), ["v"], passphrase).first()
    if row is None or row[0] is None:
        raise ValueError("Was not able to decrypt")
    return row[0]


def spec_from_properties(spark: SparkSession, props, **overrides) -> TransferSpec:
    """Job properties to a spec; an encrypted password is opened only when both
    the envelope and the key file path are given."""
    envelope, key_path = props.get(ENCRYPTED_CREDENTIAL_KEY), props.get(CRYPTO_KEY_PATH_KEY)
    password = decrypt_value(spark, envelope, key_path) if envelope and key_path else None
    return TransferSpec.from_properties(props, password=password, **overrides)


def warehouse_for(spark: SparkSession, spec: TransferSpec):
    if spec.warehouse == "catalog":
        return CatalogWarehouse(spark)
    return JdbcWarehouse(spark, spec.url, driver=spec.driver, user=spec.user,
                         password=spec.password, extra_options=spec.extra_options)


@contextmanager
def _settings(spark: SparkSession, spec: TransferSpec):
    """The spec's free settings hold for this transfer only, ahead of the rest."""
    before = {k: spark.conf.get(k, None) for k in spec.spark_settings}
    for key, value in spec.spark_settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def load_source(spark: SparkSession, spec: TransferSpec, target_schema) -> DataFrame:
    if spec.direction == Direction.LOAD_CATALOG:
        return read_catalog_table(spark, spec.hive_database, spec.hive_table)
    return read_files(spark, spec.source_path, spec.file_format, columns=target_schema,
                      separator=spec.separator, avro_schema_inline=spec.avro_schema_inline,
                      avro_schema_path=spec.avro_schema_path, options=spec.source_options,
                      addresses=spec.reject_addresses)


def load(spark: SparkSession, spec: TransferSpec, *, warehouse=None,
         source: DataFrame | None = None, stop_after: str | None = None) -> LoadReport:
    """F1/F2.  ``source`` overrides the spec's source (e.g. a protected frame).

    With ``spec.journal`` the load can be cut short anywhere and run again (plans/journal.py); ``stop_after``
    names a phase after which a drill stops it."""
    if spec.direction not in (Direction.LOAD_FILES, Direction.LOAD_CATALOG):
        raise ValueError("This spec is not a load.")
    if stop_after and not spec.journal:
        raise ValueError("Only a journaled load can be stopped.")
    with _settings(spark, spec):
        return _Load(spark, spec, warehouse or warehouse_for(spark, spec), source, stop_after).run()


class _Load:
    """One load, in steps; each step works from what the steps before it staged, so that a later run of the
    same load can take up any of them."""

    def __init__(self, spark: SparkSession, spec: TransferSpec, wh, source: DataFrame | None, stop_after: str | None):
        self.spark, self.spec, self.wh, self.source, self.stop_after = spark, spec, wh, source, stop_after
        self.target = spec.target
        self.journal = Journal(spark, spec.journal, self.target.qualified()) if spec.journal else None

    def run(self) -> LoadReport:
        if not self.wh.exists(self.target):
            raise ValueError(f"Target table {self.target.qualified()} does not exist; create it first.")
        if self.journal:
            entry, digest = self.journal.unfinished(), spec_digest(self.spec)
            if entry and entry.digest != digest:
                self._settle(entry)
            elif entry:
                return self._go_on(entry, resumed=entry.phase)
        run_dir = new_run_dir(self.spark, "load")
        if not self.journal:
            try:
                state = self._staged(run_dir)
                self._write_rejects(state)
                self._look_before(state)
                self._change(state)
                return self._report(state)
            finally:
                discard(self.spark, run_dir)  # no reader of the staged rows is left, or none will come
        try:
            state = self._staged(run_dir)
        except Exception:
            discard(self.spark, run_dir)
            raise
        return self._go_on(self._enter(self.journal.begin(digest), "staged", **state))

    # -- steps ---------------------------------------------------------------------
    def _staged(self, run_dir: str) -> dict:
        """Convert the source and find the rows that would break the key; nothing outside ``run_dir`` changes."""
        spec, wh, schema = self.spec, self.wh, self.wh.schema(self.target)
        rows = self.source if self.source is not None else load_source(self.spark, spec, schema)
        rows = matched_columns(rows, schema, spec.column_mapping, spec.allow_unmatched)
        limits = wh.text_limits(self.target)
        if not spec.drop_error_tables:  # refused before any work is done
            prepare_reject_tables(wh, spec.error_tables, drop=False)
        state = {"run_dir": run_dir, "key": [], "dropped": [], "replace": spec.replace_target, "proof": {},
                 "error_tables": [t.qualified() for t in spec.error_tables]}
        key = tuple(spec.key_columns) or wh.primary_key(self.target)
        if not key and not self.journal and not spec.reconcile:
            self.direct = conversion_split(rows, schema, limits)  # read twice, staged never
            return state
        proof = staged_conversion(rows, schema, limits, f"{run_dir}/converted", prove=spec.reconcile)
        state["proof"] = {n: [d.rows, *map(str, d.sums)] for n, d in proof.items()}
        if key:
            placed, _ = converted_rows(self.spark, f"{run_dir}/converted")
            good = plain(placed)
            state["key"] = key = checked_key(good, key)
            if not spec.replace_target:  # rows whose key the target already holds would break it as well
                held = wh.held_keys(self.target, key, good, splits=spec.writers, split_column=spec.split_column)
                if held is not None:
                    stage_out(held_rows(placed, key, held), f"{run_dir}/out")
                    placed, _ = split_rows(placed, self.spark.read.parquet(f"{run_dir}/out"))
            stage_out(repeated_rows(placed, key, run_dir), f"{run_dir}/out")
        return state

    def _sides(self, state: dict) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """(rows for the target, conversion rejects, key rejects or None for a load without a key)."""
        folder = f"{state['run_dir']}/converted"
        if not state["key"] and not exists(self.spark, folder):
            return *self.direct, None
        if not state["key"]:
            return *converted_sides(self.spark, folder), None
        placed, rejects = converted_rows(self.spark, folder)
        out = f"{state['run_dir']}/out"
        stays, goes = without_rows(placed, self.spark.read.parquet(out) if exists(self.spark, out) else None)
        return stays, rejects, goes

    def _write_rejects(self, state: dict, again: bool = False) -> None:
        """Both error tables.  ``again``: tables found there are this load's own, half written."""
        tables = [TableName.parse(t) for t in state["error_tables"]]
        dropped = prepare_reject_tables(self.wh, tables, drop=again or self.spec.drop_error_tables)
        state["dropped"] = state["dropped"] if again else dropped
        _, rejects, goes = self._sides(state)
        if ADDRESS_COLUMN in rejects.columns:
            text = spark_format(self.spec.file_format) == "csv"
            bases = stage(line_bases(self.spark, self.spec.source_path), f"{state['run_dir']}/lines-{uuid.uuid4().hex[:8]}") if text else None
            rejects = with_addresses(rejects, self.wh.schema(self.target), self.wh.text_limits(self.target), bases)
        self.wh.create(rejects, tables[0], writers=self.spec.writers)
        if goes is not None:
            self.wh.create(goes, tables[1], writers=self.spec.writers)

    def _look_before(self, state: dict) -> None:
        """What an append needs to know of the target as it was: its rows, and for a journal or a proof its files
        (of a target without files, its digest)."""
        if state["replace"]:
            return
        state["before"] = self.wh.count(self.target)
        if not self.journal and not state["proof"]:
            return
        files = self.wh.files(self.target) if self.wh.kind == "catalog" else None
        if files is not None:
            discard(self.spark, self._listing(state))  # of a run that was cut short
            stage(files.select("file"), self._listing(state))
        elif state["proof"]:
            held = digest(self.wh.read_table(self.target, splits=1), self.wh.schema(self.target).fieldNames())
            state["proof"]["held"] = [held.rows, *map(str, held.sums)]

    def _change(self, state: dict, rest: DataFrame | None = None) -> None:
        """Replace the target's rows, or append (``rest`` of) them."""
        wh, spec = self.wh, self.spec
        kept = self._sides(state)[0] if rest is None else rest
        if state["replace"]:
            state["deleted"] = replace_and_load(kept, wh, self.target, writers=spec.writers, insert_method=spec.insert_method)
        else:
            load_table(kept, wh, self.target, writers=spec.writers, insert_method=spec.insert_method)

    def _listing(self, state: dict) -> str:
        return f"{state['run_dir']}/files"

    def _new_files(self, state: dict) -> list[str]:
        """The target's files that came after the listing."""
        before = self.spark.read.parquet(self._listing(state))
        return [r.file for r in self.wh.files(self.target).select("file").join(before, "file", "left_anti").collect()]

    def _prove(self, state: dict) -> dict[str, Digest] | None:
        """Digests of the source, the rejects and the target's gain as they can be read now; an error if they differ
        from what was staged."""
        if not state["proof"]:
            return None
        proof = {n: Digest(d[0], tuple(map(int, d[1:]))) for n, d in state["proof"].items()}
        err_1, err_2 = (TableName.parse(t) for t in state["error_tables"])
        both = self.spark.read.parquet(f"{state['run_dir']}/converted").schema
        source, row = (both[c].dataType.fieldNames() for c in ("source", "row"))
        proof["error_1"] = digest(self.wh.read_table(err_1, splits=1), [c for c in source if c != ADDRESS_COLUMN])
        proof["error_2"] = digest(self.wh.read_table(err_2, splits=1), row) if state["key"] else Digest()
        listed = exists(self.spark, self._listing(state))
        gained = self.wh.read_files(self.target, self._new_files(state)) if listed else self.wh.read_table(self.target, splits=1)
        proof["gained"] = digest(gained, row)
        if "held" in proof:
            proof["gained"] = proof["gained"] - proof.pop("held")
        wrong = [what for what, fits in (
            ("source rows are not the converted and the rejected ones", proof["source"].rows == proof["converted"].rows + proof["rejected"].rows),
            (f"{err_1.qualified()} does not hold the rejected source rows", proof["error_1"] == proof["rejected"]),
            (f"{self.target.qualified()} and {err_2.qualified()} do not hold the converted rows",
             proof["gained"] + proof["error_2"] == proof["converted"])) if not fits]
        if wrong:
            raise Unreconciled("; ".join(wrong))
        return proof

    def _report(self, state: dict, resumed: str | None = None) -> LoadReport:
        wh, spec = self.wh, self.spec
        n = wh.count(self.target)
        proof = self._prove(state)
        if state["key"] and not state["replace"] and wh.kind == "catalog":
            wh.keep_key_index(self.target, state["key"])
        # counts of the tables just written: file footers (or one COUNT(*)), no scan of rows
        names = state["error_tables"][:2 if state["key"] else 1]
        return LoadReport(target=self.target.qualified(), deleted=state.get("deleted"), dropped=state["dropped"],
                          error_tables=tuple(names), rejected={t: wh.count(TableName.parse(t)) for t in names},
                          loaded=n if state["replace"] else n - state["before"], resumed=resumed, proof=proof)

    # -- journaled ----------------------------------------------------------------------
    def _enter(self, entry: Entry, phase: str, **detail) -> Entry:
        entry = self.journal.enter(entry, phase, **detail)
        if self.stop_after == phase:
            raise Interrupted(f"Stopped after {phase!r}, as asked.")
        return entry

    def _go_on(self, entry: Entry, resumed: str | None = None) -> LoadReport:
        """From the entry's phase to the end.  Each step may have been cut short and is safe to take again."""
        state = entry.detail
        if entry.phase == "staged":
            self._write_rejects(state, again=resumed is not None)
            entry = self._enter(entry, "rejects", **state)
        rest = None
        if entry.phase == "rejects":
            self._look_before(state)
            entry = self._enter(entry, "changing", **state)
        elif entry.phase == "changing":
            rest = self._take_back(state)
        if entry.phase == "changing":
            self._change(state, rest)
            entry = self._enter(entry, "changed", **state)
        report = self._report(state, resumed)
        self._enter(entry, "done")
        discard(self.spark, state["run_dir"])
        return report

    def _take_back(self, state: dict) -> DataFrame | None:
        """Make a change that was cut short safe to take again.  A replacement is; of an append to files the new
        files go; an append to a database keeps what arrived, if a key tells which rows these are, and the rest of
        the rows is returned."""
        if state["replace"]:
            return None
        if exists(self.spark, self._listing(state)):
            for file in self._new_files(state):
                discard(self.spark, file)
            self.spark.catalog.refreshTable(self.wh.name(self.target))
            return None
        if not state["key"]:
            raise RuntimeError(f"The append to {self.target.qualified()} was cut short, and without a key the rows that "
                               "arrived cannot be told: clear them by hand, and end the load in its journal.")
        folder = new_run_dir(self.spark, f"load-{state['run_dir'].rsplit('/', 1)[-1]}-rest")
        rows = staged_rows(self._sides(state)[0], f"{folder}/rows")
        held = self.wh.held_keys(self.target, state["key"], plain(rows), splits=self.spec.writers, split_column=self.spec.split_column)
        return without_rows(rows, stage(held_rows(rows, state["key"], held), f"{folder}/arrived"))[0]

    def _settle(self, entry: Entry) -> None:
        """Undo or finish another load that was cut short."""
        state = entry.detail
        begun = entry.phase in ("changing", "changed")
        if begun and (state["replace"] or entry.phase == "changed" or not exists(self.spark, self._listing(state))):
            self._go_on(entry, resumed=entry.phase)
            return
        if begun:
            self._take_back(state)
        for table in map(TableName.parse, state["error_tables"]):
            if entry.phase != "staged" and self.wh.exists(table):
                self.wh.drop(table)
        self.journal.enter(entry, "undone")
        discard(self.spark, state["run_dir"])


def extract_source(spec: TransferSpec, warehouse) -> DataFrame:
    if spec.source_table:
        return read_table_split(warehouse, TableName.parse(spec.source_table), splits=spec.writers,
                                method=spec.retrieve, split_column=spec.split_column)
    return read_query(warehouse, spec.source_query, splits=spec.writers,
                      split_column=spec.split_column)


def extract(spark: SparkSession, spec: TransferSpec, *, warehouse=None) -> str:
    """write the table or query result to ``spec.target_path``."""
    if spec.direction != Direction.EXTRACT:
        raise ValueError("This spec is not an extract.")
    with _settings(spark, spec):
        wh = warehouse or warehouse_for(spark, spec)
        options = {}
        if spark_format(spec.file_format) == "avro" and (spec.avro_schema_inline or spec.avro_schema_path):
            options["avroSchema"] = (spec.avro_schema_inline
                                     or read_avro_schema_file(spark, spec.avro_schema_path))
        return extract_files(extract_source(spec, wh), spec.target_path, spec.file_format,
                             separator=spec.separator, overwrite=spec.force_overwrite, options=options)
