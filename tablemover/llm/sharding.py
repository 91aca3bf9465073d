"""Sharding: a uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

1. Rows are counted per block; a block is a hash class of the id, so a lost task recomputes the same one.
2. The communication matrix (how many rows go from each block to each shard) is drawn: one multivariate
   hypergeometric row per block, given the room that the shards have left.  Its column sums are the exact
   shard sizes, its row sums the block sizes.  Only the counts, blocks x shards numbers, pass the driver.
3. Each block is permuted: rows are ranked by a random key.  The matrix row cuts the ranks into shards.
4. Rows are exchanged, and permuted again within their shard, which gives the slot.

The law is ``rows``: shard counts are at most one apart.  All steps over rows are DataFrame operations.

Defined cases.  Null ids and null texts are rows like any other.  Rows equal in every given column take
ranks that are interchangeable.  With fewer rows than shards, the last shards stay empty.  An empty table
gives an empty table.  Texts are not read, so their length does not matter.  The input row comes back packed, so
its columns may have any names.  A table whose rows are all equal in the given columns is one block, whose ranks one
task deals: give columns that tell rows apart.
"""

from __future__ import annotations

import json
import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workspace import new_run_dir, stage
from .common import packed

ROWS_PER_BLOCK = 1_000_000
MIN_BLOCKS = 64
# The matrix has at most so many entries (8 bytes each, and one driver draw each).
MAX_ENTRIES = 1 << 20


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """One exact draw: how many of ``n`` rows taken from good + bad are good.  The cumulative distribution
    is summed outwards over 40 standard deviations around the mean, beyond which doubles hold no mass."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mean = n * good / total
    sd = math.sqrt(max(mean * (bad / total) * (total - n) / max(total - 1, 1), 0.0))
    low, high = max(low, int(mean - 40 * sd) - 40), min(high, int(mean + 40 * sd) + 40)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logp = np.concatenate(([0.0], np.cumsum(steps)))
    cdf = np.cumsum(np.exp(logp - logp.max()))
    return low + min(int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right")), len(cdf) - 1)


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each block to each shard, uniform over all ways to deal the rows."""
    rng, room, matrix = random.Random(seed), list(shard_sizes), []
    for size in block_sizes:
        row, rest, others = [], size, sum(room)
        for s, free in enumerate(room):
            others -= free
            take = hypergeometric(rng, free, others, rest)
            row.append(take)
            rest -= take
        room = [a - b for a, b in zip(room, row, strict=True)]
        matrix.append(row)
    return matrix


def _key(seed: int, stream: str, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(stream), *cols)


def shard_rows(df: DataFrame, shards: int, key_columns: list[str], seed: int = 17,
               rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard), as columns beside
    the input packed in ``row``.  ``key_columns`` should tell rows apart: rows that agree in all of them
    share a random key and keep their order arbitrary.

    The rows are staged once, after the exchange, since both the shard's sub-block sizes and the slots
    derive from them."""
    spark = df.sparkSession
    keys = [F.col(f"row.`{c}`") for c in key_columns]
    rows = packed(df)
    n = df.count()
    blocks = max(1, min(max(MIN_BLOCKS, math.ceil(n / rows_per_block)), MAX_ENTRIES // shards))
    block = F.pmod(_key(seed, "block", *keys), F.lit(blocks)).cast("int")
    rows = rows.withColumn("block", block)
    sizes = {r["block"]: r["n"] for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect()}
    sizes = [sizes.get(b, 0) for b in range(blocks)]
    wanted = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix(sizes, wanted, seed)
    cuts = [{"b": b, "cuts": np.cumsum(m).tolist()} for b, m in enumerate(matrix)]
    plan = (spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(cuts)), "array<struct<b:int,cuts:array<bigint>>>"))))
    local = Window.partitionBy("block").orderBy(_key(seed, "local", *keys), *keys)
    dealt = (rows.withColumn("rank", F.row_number().over(local) - 1)
             .join(plan, F.col("block") == F.col("b"))
             .select("row", F.size(F.filter("cuts", lambda c: c <= F.col("rank"))).alias("shard")))
    # The second permutation: sub-blocks of a shard by the random key's high part, then ranks in them, so
    # that no task sorts a whole shard.
    second = _key(seed, "slot", *keys)
    subs = max(1, math.ceil(n / shards / rows_per_block), MIN_BLOCKS // shards)
    dealt = stage(dealt.withColumn("sub", F.pmod(second, F.lit(subs)).cast("int")),
                  new_run_dir(spark, "shards"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("shard", "sub").agg(F.count("*").alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .select(F.col("shard").alias("s"), F.col("sub").alias("u"), "offset"))
    inner = Window.partitionBy("shard", "sub").orderBy(second, *keys)
    return (dealt.withColumn("in_sub", F.row_number().over(inner) - 1)
            .join(offsets, (F.col("shard") == F.col("s")) & (F.col("sub") == F.col("u")))
            .select("row", "shard", (F.col("offset") + F.col("in_sub")).cast("long").alias("slot")))
