"""Quality rules with adaptive thresholds: quantile sketches per language and source in place of fixed cutoffs.

Each text gives signals (share of symbols, of repeated lines, of repeated words, letters per word).  A
mergeable quantile sketch (KLL) of every signal is built per language and source, in map-side parts; the
sketches of a language's sources are merged into one for the language, and these into one for all.  A group is
shrunk towards the next wider one: its distribution is mixed with ``min_group`` documents' worth of its
language's, and that with as many of all.  So a small source of mostly junk is judged against its language,
and a source of many more documents than that by what is usual in it.

A signal may lie ``SPREADS`` spreads beyond the group's lower and upper quartile.  A spread is the quartile's
distance from the median, or what chance alone gives a text of that size if larger: events that come at the
group's median rate, and one more, over the text's letters, lines or words.  No limit has a fixed floor.
Documents are then filtered by a join with the groups' quartiles.

Two rules stay fixed, as base rules: at least 50 words, and at most half of the words in repeated windows.

Defined cases.  A null or empty text has no words and fails.  Null languages and sources are groups of
their own.  Repeated rows count each.  A signal at just its limit (a tie) passes.  A very long text is one row's
work.  The input row comes back packed, so its columns may have any names.  An empty table gives an empty table.  Sketches are approximate, so a
document within their rank error (about 1 %) of a threshold may fall on either side, and two runs may differ there:
the sketch draws at random which values it drops.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import new_run_dir, stage
from .common import arrow_batches, field, packed, release, remembered, ship_by_value

MIN_WORDS = 50
MAX_REPEATED = 0.5
SYMBOLS = "#*$%&|<>"
WINDOW = 3
# So many documents' worth of the next wider group are mixed into a group.
MIN_GROUP = 200
SPREADS = 8.0
# Signal -> what its events fall on.  Words repeat by the line.
SIGNALS = {"symbol_share": "word_chars", "line_share": "n_lines", "repeat_share": "n_lines", "word_length": "n_words"}
QUARTILES = {"low": 0.25, "mid": 0.5, "high": 0.75}
# A sketch is mixed as this many equally likely values.
GRID = 100
# Threshold rows up to this number are broadcast (about 100 bytes each); beyond it the join shuffles.
MAX_BROADCAST_ROWS = 100_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def text_counts(text: str) -> tuple[int, ...]:
    """COUNTS of one text.  Words are separated by [\\x20\\x09-\\x0D], which is what bytes.split() takes."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines, seen, repeated_lines = raw.split(b"\n"), set(), 0
    for line in lines:
        if line in seen:
            repeated_lines += 1
        elif line.strip():
            seen.add(line)
    repeated = 0
    if n >= WINDOW:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        w = (h[:-2] * _MIX[0] + h[1:-1]) * _MIX[1] + h[2:]
        order = np.sort(w)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            found = np.isin(w, twice)
            covered = np.zeros(n, bool)
            for k in range(WINDOW):
                covered[k:n - WINDOW + 1 + k] |= found
            repeated = int(covered.sum())
    return n, len(text) - blanks, sum(map(text.count, SYMBOLS)), repeated_lines, repeated, len(lines)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    remembered(None)
    release()
    return pd.DataFrame([text_counts(t or "") for t in texts], columns=list(COUNTS), dtype="int64")


def _ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(f"counts.{a}").cast("double"), F.col(f"counts.{b}").cast("double"))


def _with_signals(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"symbol_share": _ratio("n_symbols", "word_chars"),
                             "line_share": _ratio("n_dup_lines", "n_lines"),
                             "repeat_share": _ratio("n_repeat_words", "n_words"),
                             "word_length": _ratio("word_chars", "n_words")})


def base_failed() -> Column:
    return (F.col("counts.n_words") < MIN_WORDS) | (
        F.col("counts.n_repeat_words") > MAX_REPEATED * F.col("counts.n_words"))


def _mixed(parts: list[tuple[str, Column]], q: float) -> Column:
    """Quantile q of a mixture of (array of equally likely values, weight)."""
    def weighed(values, weight):
        return F.transform(F.coalesce(values, F.array().cast("array<double>")),
                           lambda v: F.struct(v.alias("v"), (weight / GRID).alias("w")))
    ordered = F.array_sort(F.concat(*[weighed(F.col(v), w) for v, w in parts]))
    least = q * sum((w for _, w in parts), F.lit(0.0))
    start = F.struct(F.lit(0.0).alias("below"), F.lit(None).cast("double").alias("v"))
    step = lambda s, x: F.struct((s["below"] + x["w"]).alias("below"),
                                 F.when(s["below"] < least, x["v"]).otherwise(s["v"]).alias("v"))
    return F.aggregate(ordered, start, step, lambda s: s["v"])


def thresholds(signals: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, <signal>_low, _mid, _high ...) from rows of (lang, source, signals): the quartiles of each
    group as mixed with the wider ones."""
    def widened(df, keys, merge):
        aggs = [(F.kll_merge_agg_double(f"{s}_sketch") if merge else F.kll_sketch_agg_double(s)).alias(f"{s}_sketch")
                for s in SIGNALS]
        return df.groupBy(*keys).agg(F.sum("n").alias("n"), *aggs)

    def values(df, name):
        ranks = F.array(*[F.lit((k + 0.5) / GRID) for k in range(GRID)])
        return df.select(*[F.col(c).alias(c if name == "own" else f"{name}_{c}") for c in ("lang", "source") if c in df.columns],
                         F.col("n").cast("double").alias(f"{name}_n"),
                         *[F.kll_sketch_get_quantile_double(f"{s}_sketch", ranks).alias(f"{name}_{s}") for s in SIGNALS])

    known = signals.where(" AND ".join(f"{s} IS NOT NULL" for s in SIGNALS)).withColumn("n", F.lit(1))
    own = stage(widened(known, ["lang", "source"], False), new_run_dir(signals.sparkSession, "sketches"))
    per_lang = widened(own, ["lang"], True)
    overall = values(widened(per_lang, [], True).where("n > 0"), "all")
    joined = (values(own, "own").join(values(per_lang, "wide"), F.col("lang").eqNullSafe(F.col("wide_lang")), "left")
              .join(F.broadcast(overall), F.lit(True), "left"))
    k, share = F.lit(float(min_group)), F.col("wide_n") / (F.col("wide_n") + min_group)
    out = [_mixed([(f"own_{s}", F.col("own_n")), (f"wide_{s}", k * share), (f"all_{s}", k * (1 - share))], q).alias(f"{s}_{name}")
           for s in SIGNALS for name, q in QUARTILES.items()]
    return joined.select("lang", "source", *out)


def unusual(signal: str, size: str) -> Column:
    """Whether a text's signal lies beyond its group's limits; null without a signal or a group."""
    low, mid, high = (F.col(f"{signal}_{q}") for q in QUARTILES)
    n = F.col(f"counts.{size}").cast("double")
    chance = F.sqrt(F.try_divide(mid + F.try_divide(F.lit(1.0), n), n))
    return ((F.col(signal) > high + SPREADS * F.greatest(high - mid, chance))
            | (F.col(signal) < low - SPREADS * F.greatest(mid - low, chance)))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_group: int = MIN_GROUP) -> DataFrame:
    """(row, counts, base_failed, kept) for every document: the packed input row, the counts of its text and
    the verdict.  The thresholds are written once, so that every later task applies the same ones."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = packed(docs).withColumn("counts", _counts(field("row", text)))
    groups = [field("row", lang).alias("lang"), field("row", source).alias("source")]
    seen = _with_signals(packed(docs.select(text, lang, source)).withColumn("counts", _counts(field("row", text)))
                         .where(~base_failed()).select(*groups, "counts"))
    table = stage(thresholds(seen.drop("counts"), min_group), new_run_dir(spark, "thresholds"))
    table = table.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    small = F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table
    on = field("row", lang).eqNullSafe(F.col("t_lang")) & field("row", source).eqNullSafe(F.col("t_source"))
    judged = _with_signals(rows).join(small, on, "left")
    passes = F.lit(True)
    for s, size in SIGNALS.items():
        passes = passes & ~F.coalesce(unusual(s, size), F.lit(False))
    failed = F.coalesce(base_failed(), F.lit(True))
    return judged.select("row", "counts", failed.alias("base_failed"), (~failed & passes).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass."""
    return judge(docs, **options).where("kept").select(*[field("row", c).alias(c) for c in docs.columns])


ship_by_value(__name__)
