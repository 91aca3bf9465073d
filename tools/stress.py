"""Stress the exactness of text, encryption and dedup with awkward values.

    python tools/stress.py [n] [seed]

Text: values made of quotes, separators, NUL and line breaks go out through
an extract and back in through both the typed read and the load path.
Encryption: the same kind of values through 1.1 and 2.0.  Dedup: NaN, -0.0,
NULL keys and tiny chunks; kept + rejects must be the input multiset.
"""

from __future__ import annotations

import os
import random
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tablemover.functions.protect import decrypt_columns, encrypt_columns  # noqa: E402
from tablemover.operators.rejects import conversion_split, duplicate_split  # noqa: E402
from tablemover.sinks.files import extract_files  # noqa: E402
from tablemover.sources.files import read_delimited  # noqa: E402

ALPHABET = ['"', '|', ',', '\n', '\r', '\\', ' ', '\t', '\x00', '\x10', 'n', 'a', 'Z', 'é', '✓', '#', "'", '\x01', '𝄞']


def awkward(rnd: random.Random, n: int, longest: int) -> list:
    vals = [None if rnd.random() < 0.05 else "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, longest)))
            for _ in range(n)]
    return vals


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3000
    rnd = random.Random(int(sys.argv[2]) if len(sys.argv) > 2 else 7)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="tablemover-stress-")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])

    vals = awkward(rnd, n, 12)
    want = dict(enumerate(vals))
    df = spark.createDataFrame(list(enumerate(vals)), schema).repartition(6)
    extract_files(df, f"{scratch}/text", "textfile", separator="|")
    good, bad = conversion_split(read_delimited(spark, f"{scratch}/text", schema, "|"), schema)
    print("text load exact:", dict((r.id, r.v) for r in good.collect()) == want and bad.count() == 0)

    vals = [v for v in awkward(rnd, n // 2, 300) if v != ""]  # empty plaintext is refused
    df = spark.createDataFrame(list(enumerate(vals)), schema)
    for version in ("2.0", "1.1"):
        path = f"{scratch}/sealed-{version}"
        encrypt_columns(df, ["v"], "stress pass phrase", version=version).write.parquet(path)
        opened = decrypt_columns(spark.read.parquet(path), ["v"], "stress pass phrase")
        print(f"encryption {version} exact:", dict((r.id, r.v) for r in opened.collect()) == dict(enumerate(vals)))

    def dval():
        return rnd.choice([None, float("nan"), 0.0, -0.0, 1.5, 2.0])
    rows = [(rnd.choice([None, 1, 2, 3]), dval(), rnd.choice([None, "a", "b", ""])) for _ in range(n)]
    kept, rejects = duplicate_split(spark.createDataFrame(rows, "k long, d double, s string"), ["k"])
    # repr tells -0.0 from 0.0
    same = Counter(repr(tuple(r)) for r in kept.unionByName(rejects).collect()) == Counter(map(repr, rows))
    keys = [r.k for r in kept.collect()]
    print("dedup multiset kept:", same, "one row per key:", len(keys) == len(set(keys)))
    spark.stop()


if __name__ == "__main__":
    main()
