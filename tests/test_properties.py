"""Load properties on the driver tables."""

from pyspark.sql import functions as F

from ledgerline.operators import incremental, lifecycle
from ledgerline.operators.fill import group_fill
from ledgerline.operators.numbering import number_rows
from ledgerline.plans.catalog import Tables
from tests.conftest import SF001


def test_second_load_of_same_batch_adds_nothing(spark):
    li = Tables(spark, SF001).lineitem
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    batch = li.filter(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    history = li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    first = incremental.new_rows(batch, history, keys)
    assert first.count() > 0
    assert incremental.new_rows(batch, history.unionByName(first), keys).count() == 0


def test_new_plus_existing_is_the_batch(spark):
    o = Tables(spark, SF001).orders
    batch = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    hist = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    new = incremental.new_rows(batch, hist, ["o_orderkey"])
    old = incremental.existing_rows(batch, hist, ["o_orderkey"])
    assert new.count() + old.count() == batch.count()
    assert new.unionByName(old).exceptAll(batch).count() == 0


def test_group_fill_never_changes_a_non_null_cell(spark):
    e = Tables(spark, SF001).events.select(
        "user_id", "event_id", F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("value")).alias("v"))
    filled = group_fill(e, "user_id", ["event_id"], ["v"], distinct=False).withColumnRenamed("v", "f")
    j = e.join(filled, ["user_id", "event_id"])
    assert j.filter(F.col("v").isNotNull() & (F.col("v") != F.col("f"))).count() == 0
    # every user with any value ends with no nulls
    assert j.filter(F.col("f").isNull()).select("user_id").distinct().join(
        e.filter(F.col("v").isNotNull()).select("user_id").distinct(), "user_id").count() == 0


def test_version_increases_by_one(spark):
    p = Tables(spark, SF001).part.select("p_partkey", F.lit(3).alias("version"))
    assert lifecycle.next_version(p) == 4
    assert lifecycle.next_version(p.limit(0)) == 1


def test_soft_delete_leaves_one_active_load(spark):
    o = Tables(spark, SF001).orders.select("o_orderkey")
    first = o.withColumn("carga", F.lit(1)).withColumn("id_estado", F.lit(1))
    second = lifecycle.soft_delete_append(first, o.withColumn("carga", F.lit(2)))
    third = lifecycle.soft_delete_append(second, o.withColumn("carga", F.lit(3)))
    active = third.filter(F.col("id_estado") == 1).select("carga").distinct().collect()
    assert [r[0] for r in active] == [3]


def test_numbering_is_dense_and_per_group(spark):
    o = Tables(spark, SF001).orders.select("o_orderkey", "o_orderstatus")
    out = number_rows(o, ["o_orderkey"], group=["o_orderstatus"], name="n", num_partitions=5)
    stats = out.groupBy("o_orderstatus").agg(F.min("n"), F.max("n"), F.count("*"), F.countDistinct("n")).collect()
    for _, lo, hi, cnt, dist in stats:
        assert lo == 1 and hi == cnt == dist
    glob = number_rows(o, ["o_orderkey"], name="n", num_partitions=7)
    assert glob.agg(F.min("n"), F.max("n")).first() == (1, o.count())


def test_numbering_spreads_a_hot_group(spark):
    # One group holding every row must not land in a single range.
    o = Tables(spark, SF001).orders.select("o_orderkey", F.lit("HOT").alias("g"))
    out = number_rows(o, ["o_orderkey"], group=["g"], name="n", num_partitions=4)
    assert out.agg(F.max("n")).first()[0] == o.count()


def test_group_fill_hot_key_split_across_chunks_matches_pandas(spark):
    import pandas as pd
    data = []
    for i in range(400):
        key = "HOT" if i % 4 else f"k{i % 5}"          # one key holds 3/4 of the rows
        a = None if (i % 7 and i % 11) else float(i)    # sparse values, gaps across chunks
        b = None if i < 150 or i % 5 else f"b{i}"       # leading nulls: needs back-fill
        data.append((key, i, a, b))
    df = spark.createDataFrame(data, "k string, o int, a double, b string")
    got = group_fill(df, "k", ["o"], ["a", "b"], distinct=False, num_partitions=6)
    got = {r["o"]: (r["a"], r["b"]) for r in got.collect()}
    pdf = pd.DataFrame(data, columns=["k", "o", "a", "b"]).sort_values(["k", "o"])
    exp = pdf.groupby("k", group_keys=False)[["o", "a", "b"]].apply(lambda g: g.ffill().bfill())
    for _, r in exp.iterrows():
        a = None if pd.isna(r["a"]) else r["a"]
        b = None if pd.isna(r["b"]) else r["b"]
        assert got[int(r["o"])] == (a, b)


def test_row_ids_are_unique_also_for_equal_rows(spark):
    import pytest
    df = spark.createDataFrame([("a|b", "c", 1)] * 3 + [("a", "b|c", 1), ("a", None, 1), (None, "a", 1), ("a", "N", 1), ("", None, 1)] * 2,
                               "x string, y string, z int")
    out = lifecycle.with_row_ids(df, "R")
    assert out.count() == df.count() and out.select("id").distinct().count() == df.count()
    assert sorted(map(repr, out.select("x", "y", "z").collect())) == sorted(map(repr, df.collect()))
    again = lifecycle.with_row_ids(df.repartition(5), "R")  # the same ids from other partitions
    assert {r["id"] for r in again.collect()} == {r["id"] for r in out.collect()}
    assert not {r["id"] for r in lifecycle.with_row_ids(df, "R2").collect()} & {r["id"] for r in out.collect()}
    lifecycle.assert_unique(out, ["id"])
    with pytest.raises(ValueError, match="duplicate"):
        lifecycle.assert_unique(out.unionByName(out.limit(1)), ["id"])
    with pytest.raises(TypeError, match="map"):
        lifecycle.with_row_ids(spark.createDataFrame([({"a": 1},)], "m map<string,int>"), "R")


def test_numbers_over_eight_digits_are_not_cut(spark):
    from ledgerline.operators.numbering import number_rows
    df = spark.range(6).withColumn("g", F.lit("x"))
    out = number_rows(df, ["id"], group=["g"], name="n", start=99_999_998)
    texts = [r[0] for r in out.orderBy("id").select(F.format_string("%08d", "n")).collect()]
    assert texts == ["99999998", "99999999", "100000000", "100000001", "100000002", "100000003"]


def test_sized_conf_scales_with_shuffle_bytes():
    from ledgerline.session import sized_conf
    small, big = sized_conf(1), sized_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "1"
    assert int(big["spark.sql.shuffle.partitions"]) > 500_000


def test_targets_load_guard_and_soft_delete(spark):
    import datetime as dt
    from ledgerline.jobs import targets as g15
    from ledgerline.operators.lifecycle import Run
    t = Tables(spark, SF001)
    sheets, org = g15.demo_inputs(t)
    run1 = Run(job="t", run_id="R1", started=dt.datetime(2024, 2, 1))
    first = g15.load(sheets, org, run1, "METAS", already_loaded_today=False)
    assert g15.load(sheets, org, run1, "METAS", already_loaded_today=True) is None
    lifecycle.assert_unique(first, ["id"])  # also where the role join fans out
    run2 = Run(job="t", run_id="R2", started=dt.datetime(2024, 3, 1))
    second = g15.load(sheets, org, run2, "METAS", already_loaded_today=False)
    table = lifecycle.current_state(first.unionByName(second), state_col="id_estado_registro")
    states = {(r["id_ejecucion"], r["id_estado_registro"]) for r in table.select("id_ejecucion", "id_estado_registro").distinct().collect()}
    assert states == {("R1", 4), ("R2", 1)}
