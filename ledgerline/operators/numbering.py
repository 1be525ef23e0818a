"""Dense row numbering that does not funnel a group into one task.

``row_number()`` over a window without (or with a coarse) partition key puts
every row of a partition key on one task: a month of sales, or a hot key
holding a third of the data.  Here the order (group, order) is cut into ranges
(``range_index``), so a large group is spread over many tasks; rows are
numbered in their range and group, and the counts of earlier ranges, kept for
the few groups that lie in several, are added.  Nothing is written: what is
read besides the rows themselves are their group and order columns.

An order that is not one of plain ascending columns goes the longer way: rows
are range-partitioned and checkpointed, positions are taken inside each sorted
range, and per-range offsets turn them into global positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.joins import normalised_keys, spread_join
from ledgerline.operators.range_index import RangeIndex, can_index


def _as_sort(c) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def ranges(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Rows dealt out by ranges of ``order``.  Without a number, adaptive
    execution merges small ranges and uses at least the cluster's cores."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *order)
    spark = df.sparkSession
    least = spark.sparkContext.defaultParallelism
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < least:
        return df.repartitionByRange(least, *order)
    return df.repartitionByRange(*order)


def global_positions(df: DataFrame, order: list, num_partitions: int | None = None,
                     pos_col: str = "__pos") -> DataFrame:
    """0-based dense position of every row in the total order ``order``."""
    sort_exprs = [_as_sort(c) for c in order]
    ranged = (ranges(df, sort_exprs, num_partitions)
                .sortWithinPartitions(*sort_exprs)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per range: cumulative offsets, bounded by the number of tasks.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), on="__pid", how="inner")
                  .withColumn(pos_col, F.col("__off") + local)
                  .drop("__pid", "__mid", "__off"))


def number_rows(df: DataFrame, order: list, group: list[str] | None = None,
                name: str = "rn", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` over (partition by group order by order), skew-safe.

    ``df`` is read three times (twice for its group and order columns only):
    stage it first if it is costly to make."""
    group = list(group or [])
    if not can_index(df, [*group, *order]):
        return _numbered_by_position(df, order, group, name, start, num_partitions)
    index = RangeIndex(df, group, order, num_partitions)
    ranged = df.withColumn("__range", index.range_of())
    keyed, names = normalised_keys(ranged, group, "__g")
    within = Window.partitionBy("__range", *names).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    numbered = keyed.withColumn("__within", F.row_number().over(within))
    # Rows of earlier ranges: of all groups cut by a bound, a row a range.
    counted = keyed.select("__range", *names)
    if group:
        cut, _ = index.cut_groups()
        counted = counted.join(F.broadcast(cut), names, "left_semi")
    counts = counted.groupBy("__range", *names).agg(F.count(F.lit(1)).cast("bigint").alias("__c"))
    before = Window.partitionBy(*names).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("__range", *names, F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    out = numbered.join(F.broadcast(carried), ["__range", *names], "left")
    return (out.withColumn(name, F.coalesce(F.col("__before"), F.lit(0)) + F.col("__within") + F.lit(start - 1))
               .drop("__range", "__within", "__before", *names))


def _numbered_by_position(df: DataFrame, order: list, group: list[str], name: str, start: int, num_partitions: int | None) -> DataFrame:
    pos = global_positions(df, [*group, *order], num_partitions, "__pos")
    if not group:
        return pos.withColumn(name, F.col("__pos") + F.lit(start)).drop("__pos")
    keyed, names = normalised_keys(pos, group, "__g")
    firsts = keyed.groupBy(*names).agg(F.min("__pos").alias("__first"))
    return (spread_join(keyed, firsts, names, "inner")
                 .withColumn(name, F.col("__pos") - F.col("__first") + F.lit(start))
                 .drop("__pos", "__first", *names))
