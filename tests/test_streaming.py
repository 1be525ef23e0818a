"""Landing-folder stream: files are loaded once; replays append nothing twice."""

import os

from pyspark.sql import functions as F

from ledgerline.jobs import order_loader as g1
from ledgerline.plans.catalog import Tables
from ledgerline.streaming.landing import start_landing_loader
from tests.conftest import SF001


def test_available_now_loads_new_files_once(spark, tmp_dir):
    li = Tables(spark, SF001).lineitem
    landed = g1.demo_landed(li)
    landing = os.path.join(tmp_dir, "landing")
    target = os.path.join(tmp_dir, "target")
    ckpt = os.path.join(tmp_dir, "ckpt")
    first = landed.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    first.write.parquet(os.path.join(landing, "f1"))
    cfg = g1.DEMO_CONFIG
    q = start_landing_loader(spark, landing + "/*", landed.schema, cfg, target, checkpoint_location=ckpt)
    q.awaitTermination()
    n1 = spark.read.parquet(target).count()
    pos = F.coalesce(F.col("valor"), F.lit(0.0)) > 0
    # duplicates inside one batch are kept; only keys already loaded are dropped
    assert n1 == first.filter(pos).count()

    # second file overlaps the first: only unseen keys are appended
    second = landed.filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    second.write.parquet(os.path.join(landing, "f2"))
    q = start_landing_loader(spark, landing + "/*", landed.schema, cfg, target, checkpoint_location=ckpt)
    q.awaitTermination()
    k = ["l_orderkey", "l_linenumber", "l_returnflag"]
    fresh = second.filter(pos).join(first.filter(pos).select(*k).distinct(), k, "left_anti").count()
    total = n1 + fresh
    assert spark.read.parquet(target).count() == total

    # a fresh checkpoint replays every file: the anti-join makes it a no-op
    q = start_landing_loader(spark, landing + "/*", landed.schema, cfg, target,
                             checkpoint_location=os.path.join(tmp_dir, "ckpt2"))
    q.awaitTermination()
    assert spark.read.parquet(target).count() == total


def test_a_restarted_stream_reads_no_file_again(spark, tmp_dir):
    landing, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "target", "ckpt"))
    landed = g1.demo_landed(Tables(spark, SF001).lineitem).limit(40)
    landed.write.parquet(os.path.join(landing, "f1"))
    seen = []
    for session in (spark, spark.newSession()):
        q = start_landing_loader(session, landing + "/*", landed.schema, g1.DEMO_CONFIG, target, checkpoint_location=ckpt)
        q.awaitTermination()
        seen.append(sum(p["numInputRows"] for p in q.recentProgress))
    assert seen == [40, 0]
