"""The registered query of each operator: the operator over its whole table, and the digest columns."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_run_dir
from .decontaminate import contamination
from .filter_audit import audit
from .license_scan import labelled
from .line_dedup import dedup_lines
from .minmax import near_duplicates
from .pitman_yor import score_texts
from .quality import judge
from .secret_ledger import BASE_RULES, RULES, Rule, findings
from .sentencepiece_fst import encode_decode
from .sharding import shard_rows
from .tokenizer_alignment import linked_counts
from .toxicity import scored, train
from .warc import read_warc, records_of, write_warc

# The folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
SENTENCEPIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTE_BPE_MODEL = f"{TOKENIZERS}/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode_decode(docs, SENTENCEPIECE_MODEL)
    return done.select("doc_id", "n_pieces", "pieces", "round_trip",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A document without an id is not held out, and no label is its own.
    seen = table(spark, sf_dir, "labels").where(F.pmod(crc32_of_id(), F.lit(3)) != 1)
    models = train(docs.where(F.pmod(crc32_of_id(), F.lit(3)) != 1), seen.select("doc_id", "toxic"))
    return scored(docs, models).select(
        "doc_id", F.coalesce(F.pmod(crc32_of_id(), F.lit(3)) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    light = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(light, 24, ["doc_id", "size", "text_crc32"]).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs, counts=("n_lines", "n_dropped"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > s.first_id, false) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = F.coalesce(F.pmod(crc32_of_id(), F.lit(10)) != 0, F.lit(True))
    scored, tokens = score_texts(docs.select(F.col("doc_id").alias("id"), "text", train.alias("train")))
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return marked.select("row.doc_id", (F.size("items") > 0).alias("contaminated"), "items", "edits")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = write_warc(pages, new_run_dir(spark, "warc"), "page_id", "url", "html")
    records = records_of(read_warc(manifest))
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS newest FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM r
"""

def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, width=4)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s),
places AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
pairs AS (
  SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS n
  FROM places a JOIN places b ON a.shingle = b.shingle AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
links AS (SELECT x, y FROM pairs WHERE 100 * n >= 80 * (nx + ny - n) UNION SELECT y, x FROM pairs WHERE 100 * n >= 80 * (nx + ny - n)),
reach(node, root) AS (
  SELECT rep, rep FROM classes
  UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node AND r.root < l.y),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, coalesce(r.root, t.doc_id) AS component_id,
       coalesce(t.doc_id = coalesce(r.root, t.doc_id), true) AS kept
FROM sets t LEFT JOIN classes c ON t.s = c.s AND t.doc_id IS NOT NULL LEFT JOIN roots r ON r.node = c.rep
"""


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = new_run_dir(spark, "ledger")
    # The base rules go into the ledger first; the run with all rules reads it and scans the pairs that it lacks.
    findings(docs, "doc_id", "text", ledger, rules=BASE_RULES, carry=["doc_id"])
    scanned = findings(docs, "doc_id", "text", ledger, seen=True, carry=["doc_id"])
    base = F.filter("found", lambda s: s["kind"] <= len(BASE_RULES))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["stop"])), ",")

    def count(k):
        return F.size(F.filter("found", lambda s: s["kind"] == k + 1)).cast("long")

    return scanned.select("row.doc_id", *[count(k).alias(f"n_{r.name}") for k, r in enumerate(BASE_RULES)],
                          F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
                          written(F.col("found")).alias("spans"))


def _spans_sql(kind: int, rule: Rule) -> str:
    """The rule's spans of every text: it is cut at the matches, whose lengths and those between add up to places."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {kind} AS kind, '{rule.name}' AS name, list_sum(gap[1:i]) + coalesce(list_sum(whole[1:i - 1]), 0) AS start, whole[i] AS n
  FROM (SELECT doc_id, gap, whole, own, unnest(range(1, len(whole) + 1)) AS i
        FROM (SELECT doc_id, list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x)) AS gap,
                     list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x)) AS whole,
                     list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x)) AS own
              FROM texts) m) p
  WHERE own[i] >= {rule.least}"""


OP6_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(_spans_sql(k, r) for k, r in enumerate(RULES))}),
written AS (
  SELECT doc_id, kind, CAST(start AS BIGINT) AS start, name || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS span FROM spans),
told AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (kind = {k}) AS n_{r.name}" for k, r in enumerate(BASE_RULES))},
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {len(BASE_RULES)}) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM written GROUP BY doc_id)
SELECT t.doc_id, {', '.join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN told USING (doc_id)
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("row.doc_id", "counts.n_words", "counts.word_chars", "counts.n_symbols",
                              "counts.n_dup_lines", "counts.n_repeat_words", "base_failed", "kept")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linked_counts(docs, BYTE_BPE_MODEL, SENTENCEPIECE_MODEL, carry=["doc_id"]).select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return labelled(docs, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
judged AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM w),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
groups AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, g.bit,
         (SELECT coalesce(sum(h.bit), 0) FROM f h WHERE strpos(filter_order, h.letter) < step) AS before
  FROM orders, range(1, 6) r(step), f g WHERE g.letter = substr(filter_order, CAST(step AS INTEGER), 1)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (CAST(before AS INTEGER) | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & CAST(before AS INTEGER) > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM groups, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_sharding": op3_sharding,
    "op4_line_dedup": op4_line_dedup,
    "op5_minmax_dedup": op5_minmax_dedup,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_quality_rules": op7_quality_rules,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op4_line_dedup": OP4_SQL,
    "op5_minmax_dedup": OP5_SQL,
    "op6_secret_ledger": OP6_SQL,
    "op10_warc": OP10_SQL,
    "op13_filter_audit": OP13_SQL,
}
