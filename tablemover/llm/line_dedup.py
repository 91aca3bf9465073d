"""Line dedup: drop lines that several documents share, except in one document.

Every line is exploded with its position, normalised and hashed; per hash the documents that hold it are
counted and the smallest document id is kept; occurrences of a shared line in other documents are dropped,
and each text is put together again from the positions that stay.

Defined cases.  A null or empty text is one empty line and comes back as it was.  A text that loses all its
lines becomes the empty text.  A document without an id neither loses lines nor takes them from others.
Rows with the same id count as one document; each row is put together from its own text.  An empty table
gives an empty table.  Of equal lines in one document (ties) all go or all stay.  A very long text is split and put
together as rows of lines; a very long line is one value.  Any other columns come back untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import new_run_dir, stage
from .common import BLANKS, ascii_lower, field, packed


def line_key(line: Column) -> Column:
    """The line with blanks stripped at both ends and A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dropped_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """(id, text_hash, pos list) of the lines that go, from (id, text).

    A line goes when its key has ``min_chars`` code points or more, ``min_docs`` documents hold it, and
    this is not the one with the smallest id.  Keys travel as two independent 64-bit hashes.  A key that a
    third of all documents hold is reduced map-side before the count, and its occurrences are the splittable
    side of the join."""
    lines = (docs.where(F.col("id").isNotNull())
             .select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(7), F.col("key")).alias("h2")))
    if min_docs == 2:  # two distinct ids exactly when the least differs from the greatest: no distinct count
        held = lines.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        shared = held.where("last_id > first_id")
    else:
        held = lines.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.count_distinct("id").alias("n_docs"))
        shared = held.where(F.col("n_docs") >= min_docs)
    # Written and read anew, the shared keys need a shuffle of their own, so that the join can split a hot key.
    shared = stage(shared.select("h1", "h2", "first_id"), new_run_dir(docs.sparkSession, "lines"))
    return (lines.join(shared, ["h1", "h2"])
            .where("id > first_id")
            .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone")))


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10, doc_id: str = "doc_id",
                text: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with shared lines removed from ``text``.  ``counts`` names two more columns: the number
    of lines before, and the number dropped."""
    rows, content = packed(docs).withColumn("id", field("row", doc_id)), field("row", text)
    gone = dropped_lines(rows.select("id", content.alias("text")), min_docs, min_chars)
    gone = gone.withColumnsRenamed({"id": "gone_id", "text_hash": "gone_hash"})
    joined = rows.withColumn("text_hash", F.xxhash64(content)).join(
        gone, (F.col("id") == F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")
    joined = joined.withColumn("lines", _lines(content))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda p: F.get(F.col("lines"), p)), "\n")
    new_text = F.when(F.col("gone").isNull(), content).otherwise(kept)
    out = [(new_text if c == text else field("row", c)).alias(c) for c in docs.columns]
    if counts:
        n_gone = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
        out += [F.size("lines").cast("long").alias(counts[0]), n_gone.cast("long").alias(counts[1])]
    return joined.select(*out)
