"""Write PLANS.md: the physical plans of the core operators at sf0.01.

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tablemover.functions.protect import decrypt_columns, encrypt_columns  # noqa: E402
from tablemover.operators.rejects import conversion_split, duplicate_split  # noqa: E402
from tablemover.operators.splits import in_splits  # noqa: E402
from tablemover.sinks.files import extract_files  # noqa: E402
from tablemover.sources.files import read_delimited  # noqa: E402
from tablemover.plans.registry import REVENUE_SQL, source_database  # noqa: E402


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = re.sub(r"#\d+L?", "", out.getvalue())           # attribute ids
    text = re.sub(r"file:/[^\]]*", "<path>", text)          # scratch paths
    text = re.sub(r"tm_\w+_[0-9a-f]{10}", "<db>", text)     # per-run databases
    return text.strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    narrow = T.StructType([T.StructField(f.name, T.ByteType() if f.name == "l_orderkey" else f.dataType)
                           for f in li.schema.fields])
    good, bad = conversion_split(li, narrow)
    kept, rejects = duplicate_split(li, ["l_orderkey", "l_linenumber"])
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    sealed = encrypt_columns(customer, ["c_name"], "pass phrase")
    staged = f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/plans-sealed"
    sealed.write.mode("overwrite").parquet(staged)
    opened = decrypt_columns(spark.read.parquet(staged), ["c_name"], "pass phrase")
    db = source_database(spark, sf, ["lineitem", "orders"])
    revenue = spark.sql(REVENUE_SQL.format(db=f"`{db}`."))
    lines = f"{staged}-lines"
    extract_files(spark.read.parquet(f"{sf}/customer.parquet"), lines, "textfile", overwrite=True)
    parsed = conversion_split(read_delimited(spark, lines, customer.schema), customer.schema)[0]
    ranges = in_splits(spark.read.parquet(f"{sf}/orders.parquet"), ["o_orderpriority", "o_orderdate"], 4)
    sections = [
        ("S2 text lines, converted (one from_csv, behind a generator)", parsed),
        ("S5 split.by.range (a partition for each split)", ranges),
        ("R1 conversion split, rejected rows (one narrow pass, range test)", bad),
        ("R2 kept rows (staged rows not at the addresses of those that go)", kept),
        ("R2 rejected rows (staged rows at these addresses)", rejects),
        ("C1 encrypt 2.0 (table of 1024 keys, broadcast hash join)", sealed),
        ("C2 decrypt (one pass; keys derived in the tasks)", opened),
        ("S6/F4 extract query (pruned scans; Catalyst picks the join)", revenue),
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("# Physical plans of the core operators\n\n"
                 "Generated by `tools/show_plans.py` on sf0.01 with automatic broadcast off, so the plans\n"
                 "show what a large input gets. Attribute ids and paths are blanked.\n")
        for title, df in sections:
            fh.write(f"\n## {title}\n\n```\n{plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
