"""Steps whose tasks must not grow with the size of a file's parts."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ledgerline.jobs import warehouse as G9
from ledgerline.operators.lifecycle import with_row_ids
from ledgerline.plans.registry import load_all


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_fanout_rows_are_dealt_out_before_they_multiply(spark, tmp_dir):
    spark.createDataFrame([(1, 10, "F"), (2, 10, "O"), (3, 11, "O"), (4, None, "F"), (None, 11, "O"), (1, 10, "F")],
                          "o_orderkey long, o_custkey long, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(10, "a", 1, 9000.0), (11, "b", 2, 10.0), (None, "c", None, 6000.0)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_dir}/customer.parquet")
    spark.createDataFrame([(100, 1), (101, 1), (102, 3), (103, None)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_dir}/supplier.parquet")
    got = load_all()["left_join_two_keys_fanout"].build(spark, tmp_dir)
    assert "hashpartitioning(o_orderkey" in _plan(got)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    want = [(1, "a", 100), (1, "a", 101)] * 2 + [(2, None, None), (3, "b", None), (None, "b", None), (4, "c", None)]
    assert rows == sorted(want, key=str)


def test_fanout_is_written_in_a_fraction_of_a_byte_a_row(spark, tmp_dir):
    orders = spark.range(0, 600, 1, 1).select(F.col("id").alias("o_orderkey"), (F.col("id") % 60).alias("o_custkey"), F.lit("F").alias("o_orderstatus"))
    names = F.concat(F.lit("name"), F.col("id").cast("string")).alias("c_name")
    customer = spark.range(60).select(F.col("id").alias("c_custkey"), names, (F.col("id") % 3).cast("int").alias("c_nationkey"), F.lit(9000.0).alias("c_acctbal"))
    supplier = spark.range(0, 6000, 1, 1).select(F.col("id").alias("s_suppkey"), (F.col("id") % 3).cast("int").alias("s_nationkey"))
    for name, df in (("orders", orders), ("customer", customer), ("supplier", supplier)):
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    load_all()["left_join_two_keys_fanout"].build(spark, tmp_dir).write.parquet(f"{tmp_dir}/out")
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.count() == got.distinct().count() == 600 * 2000
    of = F.expr("c_name = concat('name', o_orderkey % 60) and s_suppkey % 3 = o_orderkey % 3")
    assert got.filter(~of | of.isNull()).count() == 0
    assert sum(map(os.path.getsize, glob.glob(f"{tmp_dir}/out/*.parquet"))) < 0.5 * 600 * 2000


def test_fan_out_join_is_the_left_join(spark, monkeypatch):
    from ledgerline.operators import joins
    monkeypatch.setattr(joins, "BLOCK", 3)
    monkeypatch.setattr(joins, "CHUNK", 2)
    rows = [(i % 17 or None, f"n{i % 5}" if i % 4 else None, i % 6 or None) for i in range(200)] + [(None, None, None)] * 9 + [(None, None, 2)] * 30
    left = spark.createDataFrame(rows, "a long, b string, k int")
    right = spark.createDataFrame([(k, v if v % 3 else None) for k in (1, 2, 2, 4, 9, None) for v in range(7)], "k int, v long")
    for some in (right, right.filter("k = 2"), right.filter("false")):
        got, want = joins.fan_out_join(left, some, "k", 4), left.join(some, "k", "left")
        assert got.columns == ["k", "a", "b", "v"] == want.columns
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert joins.fan_out_join(left.filter("false"), right, "k", 4).count() == 0


def test_equal_rows_are_dealt_out_before_they_multiply(spark, tmp_dir):
    spark.range(0, 20000, 1, 1).select(F.lit(None).cast("long").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("F").alias("o_orderstatus")).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(1, "a", 5, 9000.0)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_dir}/customer.parquet")
    spark.createDataFrame([(i, 5) for i in range(20)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_dir}/supplier.parquet")
    got = load_all()["left_join_two_keys_fanout"].build(spark, tmp_dir)
    shares = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 20000 * 20 and max(shares) < 0.5 * sum(shares)


def test_rows_are_dealt_out_before_equal_ones_are_counted(spark):
    df = spark.range(0, 3000, 1, 1).select((F.col("id") % 1000).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    same = spark.range(0, 500, 1, 1).select(F.lit(-1).cast("long").alias("a"), F.lit("s").alias("b"))
    out = with_row_ids(df.unionByName(same), "R")
    plan = _plan(out)
    assert plan.count("hashpartitioning(__share") >= 1
    rows = out.collect()
    assert len(rows) == 3500 and len({r["id"] for r in rows}) == 3500 and sum(r["a"] == -1 for r in rows) == 500
    assert out.columns == ["id", "a", "b"]
    again = with_row_ids(same.unionByName(df).repartition(3), "R")
    assert {r["id"] for r in again.collect()} == {r["id"] for r in rows}


def test_ids_are_brought_together_before_they_are_counted(spark):
    from tests.conftest import SF001
    got = load_all()["row_ids"].build(spark, SF001)
    assert _plan(got).split("== Initial Plan ==")[0].count("hashpartitioning(id#") >= 3
    assert all(r["filas"] == r["ids"] for r in got.collect())


def test_plan_changes_leave_out_loaded_keys_before_the_dimensions_join(spark):
    day = dt.datetime(2024, 1, 2)
    fact = spark.createDataFrame(
        [(1, 5, 6, day, 1), (1, 5, 6, day, 1), (1, 5, None, day, 0), (None, 5, 6, day, 0), (2, 5, 6, day, 1), (3, None, 6, day, 0), (4, 5, 7, day, 1), (5, 5, 6, dt.datetime(2020, 1, 1), 1)],
        "co_id long, cod_plan_origen long, cod_plan_destino long, fe_creacion timestamp_ntz, no_ejecutado int")
    keys = {r.fact_key for r in G9.PLAN_CHANGE_ROLES} - set(fact.columns)
    fact = fact.withColumns({k: F.lit(1).cast("long") for k in sorted(keys)}).withColumn("vl_cfm_neto", F.lit(2.5))
    dims = {}
    for name in {r.dimension for r in G9.PLAN_CHANGE_ROLES}:
        cols = sorted({c for r in G9.PLAN_CHANGE_ROLES if r.dimension == name for c in (r.key, *r.columns)})
        # the key 1 twice: the join fans out
        rows = [tuple(v if c in {r.key for r in G9.PLAN_CHANGE_ROLES if r.dimension == name} else "S" if c == "ban_pyme" and v != 7 else f"{c}{v}" for c in cols) for v in (1, 1, 5, 6, 6, 7)]
        kinds = ", ".join(f"{c} {'long' if c in {r.key for r in G9.PLAN_CHANGE_ROLES if r.dimension == name} else 'string'}" for c in cols)
        dims[name] = spark.createDataFrame(rows, kinds)
    loaded = spark.createDataFrame([(2, 5, 6), (None, 5, 6), (9, 9, 9)], "co_id long, cod_plan_origen long, cod_plan_destino long")
    # The dimensions at their full order, then the loaded keys, as the extract reads.
    recent = fact.filter(F.col("fe_creacion") >= F.lit("2023-01-01").cast("timestamp_ntz"))
    whole = G9.extract_new(G9.star(recent, dims, G9.PLAN_CHANGE_ROLES).drop(*G9.PLAN_CHANGE_KEYS), loaded, G9.PLAN_CHANGE_KEY)
    got = G9.plan_changes(fact, dims, "2023-01-01", loaded)
    assert got.columns == [c for c in whole.columns if c != "no_ejecutado"] + ["flag", "estado_tickler"]
    pick = ["co_id", "cod_plan_origen", "cod_plan_destino", "plan_negocios", "ds_plan_destino", "identificacion"]
    a, b = (sorted((tuple(r) for r in x.select(*pick).collect()), key=str) for x in (got, whole))
    assert a == b and a and {r[0] for r in a} == {1, 3}


def test_fill_brings_only_cut_keys_together_again(spark):
    from ledgerline.operators.fill import group_fill
    rows = [("HOT" if i % 3 else f"k{i % 40:02d}", i, float(i) if i % 7 == 0 else None) for i in range(600)]
    got = group_fill(spark.createDataFrame(rows, "k string, o int, v double"), "k", ["o"], ["v"], distinct=False, num_partitions=6)
    assert "SortMergeJoin" not in _plan(got) and "BroadcastHashJoin" in _plan(got)
    want = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        for _, o, _ in own:
            before, after = [r[2] for r in own if r[1] <= o and r[2] is not None], [r[2] for r in own if r[1] > o and r[2] is not None]
            want[o] = before[-1] if before else after[0] if after else None
    assert {r["o"]: r["v"] for r in got.collect()} == want


def test_staff_join_has_no_fixed_number_of_tasks(spark):
    from ledgerline.jobs import segment_report as G13
    rows = [(1, "a", 5), (1, "a", 5), (2, None, None), (3, "b", 6)]
    df = G13._placed(spark.createDataFrame(rows, "ot long, ciudad string, documento_consultor long")).drop("pos")
    staff = spark.createDataFrame([(5, "n1", "c1", "x"), (5, "n2", "c2", None), (5, "n2", "c2", None), (None, "n3", "c3", "y")],
                                  "documento_consultor long, nombre_consultor string, cargo_actual string, ciudad string")
    got = G13.with_staff(df, staff, {"ciudad": "left", "nombre_consultor": "right", "cargo_actual": "left"})
    assert "RoundRobinPartitioning" not in _plan(got)
    out = sorted(((r["ot"], r["ciudad"], r["nombre_consultor"], r["cargo_actual"]) for r in got.collect()), key=str)
    assert out == sorted([(1, "a", "n1", "c1"), (1, "a", "n2", "c2"), (2, None, None, None), (3, "b", None, None)], key=str)
