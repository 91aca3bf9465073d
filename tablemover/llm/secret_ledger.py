"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed: its blob id is the SHA-256 of its text.  A ledger table
holds a row for each (blob, rule, rule version) that has been scanned, with the spans found.  A run scans
only the pairs that the ledger lacks, each blob once however many paths and versions carry it, appends them,
and joins the findings back to all paths.  Raising a rule's version scans its pairs anew.

All steps are DataFrame functions.  Spans come from cutting the text at the matches: the lengths of the
pieces between matches and of the matches themselves give the offsets, in code points.

Defined cases.  A null text is the empty blob.  Null paths are paths like any other.  Repeated rows give
repeated findings but one scan.  Spans of several rules at one start (ties) come in the rules' order.  A very long text is
one row's scan.  An empty table scans nothing and still leaves a ledger.  The input row comes back packed, so its
columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_run_dir, stage
from .common import field, packed

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,stop:int>>"
SPANS = "array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` whose ``group`` has at least ``least`` characters.  ``hint`` is a
    cheaper pattern found in every text that has such a match."""

    name: str
    pattern: str
    group: int
    least: int
    hint: str
    version: int = 1


# The kinds of secrets that the base scan names, in their order.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    # A match of [0-9a-f]+ is a whole run, so runs of 16 and more are the matches that pass.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
# Kinds beyond the base.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ"),
)
RULES = BASE_RULES + MORE_RULES


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in ``text`` as SPANS, in code points, the stop exclusive."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    group = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    steps = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("whole"), group.alias("group"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

    def step(acc, m):
        here = acc["at"] + m["gap"]
        span = F.array(F.struct(here.alias("start"), (here + m["whole"]).alias("stop")))
        found = F.when(m["group"] >= rule.least, F.concat(acc["found"], span)).otherwise(acc["found"])
        return F.struct((here + m["whole"]).alias("at"), found.alias("found"))

    found = F.aggregate(steps, start, step, lambda acc: acc["found"])
    return F.when(F.rlike(text, F.lit(rule.hint)), found).otherwise(F.array().cast(SPANS))


def _tag(rule: Rule) -> str:
    return f"{rule.name}:{rule.version}"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(folder)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """Ledger rows for the (blob, rule version) pairs of ``versions`` (blob, path, text) that ``ledger`` lacks."""
    carriers = versions.groupBy("blob").agg(F.min("path").alias("carrier"))
    every = F.array(*[F.lit(_tag(r)) for r in rules])
    if ledger is None:
        carriers = carriers.withColumn("missing", every)
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("done"))
        missing = F.when(F.col("done").isNull(), every).otherwise(F.array_except(every, F.col("done")))
        carriers = carriers.join(done, "blob", "left").select("blob", "carrier", missing.alias("missing")).where(F.size("missing") > 0)
    carriers = carriers.select(F.col("blob").alias("c_blob"), "carrier", "missing")
    # One row carries the text of each unseen blob; ids and paths together deal copies of a blob evenly.
    texts = versions.join(carriers, (F.col("blob") == F.col("c_blob")) & F.col("path").eqNullSafe(F.col("carrier")))
    found = texts.select("blob", *[
        F.when(F.array_contains("missing", _tag(r)), spans_of(F.col("text"), r)).alias(r.name) for r in rules])
    once = found.groupBy("blob").agg(*[F.first(r.name).alias(r.name) for r in rules])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.col(r.name).alias("spans"))
                     for r in rules])
    return once.select("blob", F.inline(rows)).where(F.col("spans").isNotNull())


def findings(docs: DataFrame, path: str, text: str, folder: str, rules=RULES, seen: bool = False, carry=None) -> DataFrame:
    """(row, blob, found): every input row, packed, with its blob id and the spans found by the current rules as
    array<struct<start, kind number, stop, kind>> in order of start and then of kind.  The ledger in ``folder`` is
    read if ``seen``, and gets the pairs scanned now.  ``carry`` names the columns of the row where not all are
    wanted."""
    spark = docs.sparkSession
    rows = packed(docs).withColumn("text", F.coalesce(field("row", text), F.lit("")))
    rows = rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    ledger = read_ledger(spark, folder) if seen else None
    scan_unseen(rows.select("blob", field("row", path).alias("path"), "text"), ledger, rules).write.mode("append").parquet(folder)
    current = F.concat_ws(":", "rule", "version").isin([_tag(r) for r in rules])
    number = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule")).cast("int")
    hits = (read_ledger(spark, folder).where(current & (F.size("spans") > 0)).select("blob", "rule", number.alias("kind"), F.explode("spans").alias("s"))
            .groupBy(F.col("blob").alias("h_blob"))
            .agg(F.array_sort(F.collect_set(F.struct("s.start", "kind", "s.stop", "rule"))).alias("found")))
    # Written and read anew, the findings need a shuffle of their own, so that the join can split a blob of many paths.
    hits = stage(hits, new_run_dir(spark, "findings"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,rule:string>>")
    kept = docs.columns if carry is None else list(carry)
    light = rows.select(F.struct(*[field("row", c).alias(c) for c in kept]).alias("row"), "blob")
    return light.join(hits, F.col("blob") == F.col("h_blob"), "left").select(
        "row", "blob", F.coalesce("found", none).alias("found"))
