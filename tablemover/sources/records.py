"""Records of text whose quoted values hold line breaks, read in parallel.

A line break ends a record if the quotes before it in its file pair.  So files are read line by line in any
splits, in three steps:

1. Every split's number of quotes, odd or even, is counted; a running sum over the splits of a file tells whether
   a split begins within a quoted value.
2. Each task goes through the lines of its splits in order and joins them to records.  What a split holds of a
   record that began before it, or goes on after it, is a fragment.
3. Fragments, at most two a split, are joined across splits by file and order.

No task reads a whole file, and no line is shuffled but for fragments.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.spread import in_tasks
from ..workspace import new_run_dir, stage

# Splits up to which what is known of them is broadcast (about 150 bytes each); beyond, lines are shuffled to it.
MOST_SPLITS = 200_000
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def line_address() -> Column:
    """Where a line was read: its file, the split of it, and a mark that rises line by line in the split."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("mark"))


def addressed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(a, value): the lines of text files with their addresses, in the session's splits.  The marks are those
    of the splits, however these are dealt to tasks."""
    return in_tasks(spark.read.option("lineSep", "\n").text(path).select(line_address().alias("a"), "value"))


def odd_quotes(line: Column, quote: str, escape: str) -> Column:
    """Whether the line has an odd number of quotes that are not escaped.  A quote that doubles as its own escape
    comes in pairs."""
    own = line
    if escape and escape != quote:
        for pair in (escape + escape, escape + quote):
            own = F.replace(own, F.lit(pair), F.lit(""))
    return (F.char_length(own) - F.char_length(F.replace(own, F.lit(quote), F.lit("")))) % 2 == 1


def _joined(batches):
    """Rows (file, split, open, line, odd) in the order of the lines, to (file, split, kind, text)."""
    place, within, first, held = None, False, False, []

    def fragment(done: bool):
        kind = (HEAD if first else WHOLE) if done else (MIDDLE if first else TAIL)
        return (*place, kind, "\n".join(held))

    def batch_of(rows):
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["file", "split", "kind", "text"])

    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            file, split, begins_within, line, odd = row
            if (file, split) != place:
                if held:
                    out.append(fragment(False))
                place, within, first, held = (file, split), begins_within, begins_within, []
            held.append(line)
            within ^= odd
            if not within:
                if first or held != [""]:  # an empty line is no record
                    out.append(fragment(True))
                first, held = False, []
        yield batch_of(out)
    if held:
        yield batch_of([fragment(False)])


def read_records(spark: SparkSession, path: str, quote: str, escape: str) -> DataFrame:
    """(record, closed): the text of every record, and whether its quotes pair."""
    odd = odd_quotes(F.col("value"), quote, escape)
    lines = addressed_lines(spark, path).select("a.*", "value", odd.alias("odd"))
    folder = new_run_dir(spark, "records")
    counted = lines.groupBy("file", "split").agg((F.sum(F.col("odd").cast("long")) % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    open_at = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("open")
    splits = stage(counted.select(F.col("file").alias("s_file"), F.col("split").alias("s_split"), open_at), f"{folder}/splits")
    on = (F.col("file") == F.col("s_file")) & (F.col("split") == F.col("s_split"))
    if splits.count() <= MOST_SPLITS:
        known = lines.join(F.broadcast(splits), on)  # lines stay where they were read, in their order
    else:
        known = lines.join(splits.hint("shuffle_merge"), on).sortWithinPartitions("file", "split", "mark")
    parts = in_tasks(stage(known.select("file", "split", "open", "value", "odd").mapInArrow(_joined, "file string, split long, kind int, text string"),
                           f"{folder}/parts"))
    whole = parts.where(F.col("kind") == WHOLE).select(F.col("text").alias("record"), F.lit(True).alias("closed"))
    # A record begins with a tail; heads and middles belong to the tail before them.
    torn = parts.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = torn.withColumn("number", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    mended = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("split", "kind", "text"))).alias("f"), (F.max(F.col("kind") == HEAD)).alias("closed"))
    mended = mended.select(F.array_join(F.transform("f", lambda x: x["text"]), "\n").alias("record"), "closed")
    return whole.unionByName(mended)
