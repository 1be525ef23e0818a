"""A fixed cut of a table into ranges of (group, order) columns.

A group that holds a third of all rows can't be numbered or filled in one task.
Here the table's total order is cut at bounds taken from a sample of its rows
(``PER_RANGE`` a range) and fixed as a literal of the plan.  A row's range then depends on the
row alone: it is the same in every pass over the table and after a lost
executor, so nothing has to be checkpointed for it.

A group lies in one range unless a bound has its value, so all but as many
groups as there are bounds are complete in their range; what the others carry
from range to range are a few rows per bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from ledgerline.operators.joins import normalised_keys

#: Sampled rows for each range, about.
PER_RANGE = 8
#: Ranges for each partition of a shuffle, so that ranges which are hashed to
#: one partition level out.
PER_PARTITION = 4


def can_index(df: DataFrame, names: list) -> bool:
    """Are these plain columns of types that have an order?"""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(n, str) and n in kinds and not isinstance(kinds[n], MapType) for n in names)


class RangeIndex:
    """Ranges of the ascending order (nulls last) of ``group`` and ``order``."""

    def __init__(self, df: DataFrame, group: list[str], order: list[str], parts: int | None = None):
        self.spark, self.group, self.order = df.sparkSession, group, order
        parts = parts or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
        self.ranges = parts * PER_PARTITION
        # Rows whose place in the table hashes low stand for all: as many as are wanted, not more from each task.
        share = min(1.0, PER_RANGE * self.ranges / max(1, df.count()))
        upto = int(min(2 ** 63 - 1, -2 ** 63 + share * 2 ** 64))
        sample = df.select(self.place().alias("p"), F.xxhash64(F.monotonically_increasing_id()).alias("h")).filter(F.col("h") <= F.lit(upto)).select("p")
        sample = sample.agg(F.array_sort(F.collect_list("p")).alias("s"), F.count(F.lit(1)).alias("n"))
        cuts = F.transform(F.sequence(F.lit(1), F.lit(self.ranges - 1)), lambda k: F.get("s", F.floor(k * F.col("n") / self.ranges).cast("int")))
        row = sample.select(F.to_json(F.array_distinct(F.when(F.col("n") > 0, cuts).otherwise(F.slice("s", 1, 0)))).alias("b")).first()
        self.kind = ArrayType(sample.schema["s"].dataType.elementType)
        self.bounds = F.from_json(F.lit(row["b"]), self.kind)

    def place(self) -> Column:
        return F.struct(*[x for i, c in enumerate([*self.group, *self.order]) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])

    def range_of(self) -> Column:
        """The number of bounds at or below a row, by halving."""
        steps = F.array(*[F.lit(1 << k) for k in range(math.ceil(math.log2(self.ranges + 1)), -1, -1)])

        def below(here: Column) -> Column:
            return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(self.bounds, low + step - 1) <= here, low + step).otherwise(low))
        # As the only element of an array, the row's place is made once, not for every step.
        return F.get(F.transform(F.array(self.place()), below), F.lit(0))

    def cut_groups(self) -> tuple[DataFrame, list[str]]:
        """The groups that a bound may cut, as null-safe join columns."""
        each = self.spark.range(1).select(F.explode(self.bounds).alias("b"))
        each = each.select(*[F.col(f"b.v{i}").alias(c) for i, c in enumerate(self.group)])
        keyed, names = normalised_keys(each, self.group, "__g")
        return keyed.select(*names).distinct(), names
