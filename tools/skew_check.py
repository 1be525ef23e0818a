"""Run the skew-sensitive operators on lineitem with one key holding a third
of all rows, and report the largest share of shuffled records read by any
single task (per operator).  Uses Spark's event log in a scratch folder.

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerline.operators import dedupe, incremental  # noqa: E402
from ledgerline.operators.fill import group_fill  # noqa: E402
from ledgerline.operators.joins import spread_join  # noqa: E402
from ledgerline.operators.numbering import number_rows  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from tools.stage_report import _lines  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    # Coalescing is switched off so every stage shows its natural spread over
    # the shuffle partitions (AQE would otherwise merge small outputs into one
    # task, which is not skew).  Broadcasts are off so joins do shuffle.
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                 # Equal rows of a few KB pack into nothing; at scale they do not.
                                 "spark.shuffle.compress": "false",
                                 # Adaptive execution's limits for cutting a partition, scaled
                                 # down to this data size (defaults: 256 MB, 5x the median).
                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
                                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # One key ('HOT') holds every third row; the rest spread over orders.
    df = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT"))
                    .otherwise(F.col("l_orderkey").cast("string")).alias("k"),
                   "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
                   F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("v"))
    df = df.repartition(24)  # as if read from many files: partitions are cut where map tasks meet
    names = df.select("k").distinct().withColumn("name", F.upper("k"))
    nulls = df.withColumn("k", F.when(F.col("k") != "HOT", F.col("k")))
    equal = df.select("k").withColumn("k", F.when(F.col("k") == "HOT", "11").otherwise(F.col("k")))
    hot = df.filter(F.col("k") == "HOT").count() / df.count()
    runs = {
        "keep_first": lambda: dedupe.keep_first(df, ["k"], ["l_shipdate", "l_partkey"]),
        "duplicate_flag": lambda: dedupe.duplicate_flag(df, ["k"], "dup"),
        # num_partitions forces the distributed paths (small inputs would
        # otherwise take the proven-small window shortcut).
        "number_rows (per key)": lambda: number_rows(df, ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"],
                                                      group=["k"], name="n", num_partitions=16),
        "group_fill": lambda: group_fill(df, "k", ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], ["v"],
                                         distinct=False, num_partitions=16),
        "new_rows (history with hot key)": lambda: incremental.new_rows(
            df.filter(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")), df, ["k", "l_partkey"]),
        "new_rows (batch with hot key)": lambda: incremental.new_rows(
            df, df.filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")), ["k"]),
        "lookup (a third of the keys null)": lambda: spread_join(nulls, names, ["k"], "left"),
        "lookup (a third of the rows equal, key 11)": lambda: spread_join(
            equal, names.unionByName(names.limit(1).withColumn("k", F.lit("11"))), ["k"], "left"),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    desc: dict[int, str] = {}
    for f in glob.glob(os.path.join(logdir, "*")):
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                for sid in ev.get("Stage IDs", []):
                    desc[sid] = (ev.get("Properties") or {}).get("spark.job.description", "")
            elif ev.get("Event") == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                per_stage.setdefault(ev["Stage ID"], []).append(m.get("Total Records Read", 0))
    print(f"hot key share of rows: {hot:.1%}")
    worst: dict[str, tuple[float, int]] = {}
    for sid, recs in per_stage.items():
        total = sum(recs)
        if total < 1000:
            continue
        share = max(recs) / total
        name = desc.get(sid, "")
        if share > worst.get(name, (0, 0))[0]:
            worst[name] = (share, total)
    print("| operator | largest single-task share of a shuffle read | records in that stage |")
    print("| --- | --- | --- |")
    for name in runs:
        share, total = worst.get(name, (0.0, 0))
        print(f"| {name} | {share:.1%} | {total} |")


if __name__ == "__main__":
    main()
