"""A cleaning pipeline over ``documents``: each stage calls one operator of ``tablemover.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared
folder and rereads as the next stage's documents.  All stages but the last return the columns of documents;
each works on all rows that its predecessor kept.

Defined cases.  A null or empty text has too few words and goes in the first stage.  A null id is in no group of near
copies and loses no lines.  Of equal texts (ties) the least id stays; rows that repeat an id and a text stay together.
Very long texts are a row's work in every stage.  Columns of documents beyond those used are carried along, whatever
their names, but those that the last stage adds replace theirs.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemover.llm.decontaminate import drop_contaminated
from tablemover.llm.line_dedup import dedup_lines
from tablemover.llm.minmax import drop_near_duplicates
from tablemover.llm.quality import keep_good
from tablemover.llm.queries import SENTENCEPIECE_MODEL
from tablemover.llm.sentencepiece_fst import encode_decode
from tablemover.workspace import new_run_dir, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's adaptive thresholds go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 characters or more that several documents share stay only in the smallest doc_id.
    ``n_chars`` follows the text."""
    shorter = dedup_lines(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage within its edit budget go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with their pieces, and whether these decode to the text."""
    return encode_decode(docs, SENTENCEPIECE_MODEL, decoded=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# Quantile sketches and similarity search have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), new_run_dir(spark, "pipeline")
    for k, (name, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
