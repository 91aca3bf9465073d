"""A journal of loads: phases per load in a table, so that a later run finishes or undoes one that was cut short.

A journaled load stages all that it needs (converted rows, rejects, the addresses of key rejects) before it
touches anything, and writes a row to the journal as each phase ends:

    staged    inputs are staged; nothing else has changed
    rejects   the error tables are written
    changing  the target is about to change; its files as they were are listed beside the staged rows
    changed   the target holds the new rows
    done      counted and reported; the staged rows are gone
    undone    as if the load had not been

The next load of the same target that names the journal reads its last phase.  The same load (equal digest of its
spec) goes on from there and never reads its source again.  Before another load, one that had not begun to change
its target is undone, as is a catalog append; what had begun to replace a target, or append to a database, is
finished first.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import exists

PHASES = ("staged", "rejects", "changing", "changed", "done", "undone")
SCHEMA = "load string, seq int, phase string, at timestamp, digest string, detail string"


class Interrupted(RuntimeError):
    """A drill stopped the load after a phase."""


def spec_digest(spec) -> str:
    """Tells loads apart by what they move, not by secrets or settings."""
    parts = (spec.target_table, spec.source_path, spec.hive_database, spec.hive_table, spec.file_format, spec.separator,
             sorted((spec.source_options or {}).items()), spec.replace_target, tuple(spec.key_columns), sorted((spec.column_mapping or {}).items()))
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


@dataclass
class Entry:
    load: str
    seq: int
    phase: str
    digest: str
    detail: dict = field(default_factory=dict)

    @property
    def run_dir(self) -> str:
        return self.detail["run_dir"]


class Journal:
    """The journal of one target in ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str, target: str):
        self.spark = spark
        self.path = f"{folder.rstrip('/')}/{re.sub('[^A-Za-z0-9_]', '_', target)}-{hashlib.sha256(target.encode()).hexdigest()[:8]}"

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def unfinished(self) -> Entry | None:
        """The last entry of the last load if it was neither done nor undone."""
        if not exists(self.spark, self.path):
            return None
        last = self.table().orderBy(F.desc("at"), F.desc("seq")).first()
        if last is None or last.phase in ("done", "undone"):
            return None
        return Entry(last.load, last.seq, last.phase, last.digest, json.loads(last.detail))

    def begin(self, digest: str) -> Entry:
        return Entry(uuid.uuid4().hex[:12], 0, "", digest)

    def enter(self, entry: Entry, phase: str, **detail) -> Entry:
        """Write that ``phase`` has ended; one file, seen whole or not at all."""
        after = Entry(entry.load, entry.seq + 1, phase, entry.digest, entry.detail | detail)
        row = [(after.load, after.seq, phase, after.digest, json.dumps(after.detail))]
        self.spark.createDataFrame(row, "load string, seq int, phase string, digest string, detail string").select(
            "load", "seq", "phase", F.current_timestamp().alias("at"), "digest", "detail").coalesce(1).write.mode("append").parquet(self.path)
        return after
