"""Numbering through a fixed range index (W2, W5, W6), and fills over ranges."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.fill import group_fill
from ledgerline.operators.numbering import number_rows
from ledgerline.operators.range_index import RangeIndex, can_index
from tests.test_plans import formatted


def awkward(spark, n=4000):
    """A hot group, null groups and orders, ties, dates, floats with NaN."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "HOT").when(i % 7 == 1, None).otherwise(F.concat(F.lit("g"), (i % 50).cast("string"))).alias("g"),
        F.when(i % 11 == 0, None).otherwise(F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, 0, id % 97)")).alias("t"),
        F.when(i % 13 == 0, float("nan")).when(i % 17 == 0, None).otherwise((i * 7919 % 1000) / 8).alias("x"), i.alias("id")).repartition(7)


def test_ranges_follow_the_order_and_level_out(spark):
    df = awkward(spark)
    index = RangeIndex(df, ["g"], ["t", "x", "id"], parts=4)
    rows = df.withColumn("r", index.range_of()).orderBy(*[F.col(c).asc_nulls_last() for c in ("g", "t", "x", "id")]).collect()
    at = [r["r"] for r in rows]
    assert at == sorted(at) and at[0] == 0
    sizes = [at.count(k) for k in set(at)]
    assert 10 <= len(sizes) <= index.ranges and max(sizes) < 4000 / 16 * 4
    # A group lies in several ranges only if it is listed as cut.
    cut, names = index.cut_groups()
    listed = {None if r[1] else r[0] for r in cut.select(*names).collect()}
    spread = {}
    for r in rows:
        spread.setdefault(r["g"], set()).add(r["r"])
    assert {g for g, s in spread.items() if len(s) > 1} <= listed and "HOT" in listed


@pytest.mark.parametrize("group", [["g"], [], ["g", "x"]])
def test_numbers_are_those_of_a_plain_window(spark, group):
    from pyspark.sql import Window
    df = awkward(spark)
    order = [c for c in ("t", "x", "id") if c not in group]
    out = number_rows(df, order, group=group, name="n", num_partitions=3)
    w = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    want = {r["id"]: r["n"] for r in df.withColumn("n", F.row_number().over(w)).collect()}
    assert {r["id"]: r["n"] for r in out.collect()} == want
    assert out.columns == [*df.columns, "n"] and dict(out.dtypes)["n"] == "bigint"


def test_output_may_have_any_name(spark):
    for name in ("__n", "__c", "n0", "b"):
        out = number_rows(awkward(spark, 100), ["id"], group=["g"], name=name, start=10)
        assert out.agg(F.min(name)).first()[0] == 10 and out.columns[-1] == name


def test_nothing_is_checkpointed_for_numbers(spark, tmp_dir):
    """Only the sample leaves the tasks; rows are written nowhere."""
    def used():
        root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)
    path = os.path.join(tmp_dir, "t")
    awkward(spark, 20_000).write.parquet(path)
    df = spark.read.parquet(path)
    before = used()
    assert number_rows(df, ["t", "x", "id"], group=["g"], name="n").count() == 20_000
    assert used() == before
    text = formatted(spark, number_rows(df, ["id"], group=["g"], name="n"))
    assert "ExistingRDD" not in text and "Scan parquet" in text


def test_an_order_of_expressions_goes_the_longer_way(spark):
    df = awkward(spark, 500)
    assert not can_index(df, ["g", F.col("id").desc()]) and can_index(df, ["g", "id"])
    out = number_rows(df, [F.col("id").desc()], group=["g"], name="n", num_partitions=3)
    hot = sorted((r["id"], r["n"]) for r in out.filter("g = 'HOT'").collect())
    assert [n for _, n in hot] == list(range(len(hot), 0, -1))


def test_fill_carries_over_ranges(spark):
    """One group over all ranges, with values in its first and last rows only."""
    n = 3000
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.when(F.col("id") == 1500, 7).alias("mid"),
                               F.when(F.col("id") == 0, "first").alias("a"), F.when(F.col("id") == n - 1, dt.date(2024, 1, 1)).alias("z")).repartition(5)
    rows = group_fill(df, "k", ["o"], distinct=False, num_partitions=8).collect()
    assert len(rows) == n and {(r["mid"], r["a"], r["z"]) for r in rows} == {(7, "first", dt.date(2024, 1, 1))}
