"""Join helpers: null-safe keys, joins that survive hot keys, and a join that multiplies rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, NumericType, StringType,
                               TimestampNTZType, TimestampType)


def _null_placeholder(dt: DataType) -> Column:
    if isinstance(dt, StringType):
        return F.lit("")
    if isinstance(dt, NumericType):
        return F.lit(0).cast(dt)
    if isinstance(dt, BooleanType):
        return F.lit(False)
    if isinstance(dt, DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(None).cast(dt)


def normalised_keys(df: DataFrame, keys: list[str], prefix: str,
                    null_safe: bool = True) -> tuple[DataFrame, list[str]]:
    """Add plain-equality join columns that make ``<=>`` an ordinary equi-join.

    A nullable key ``k`` becomes ``(coalesce(k, placeholder), isnull(k))`` so
    null matches null and never matches the placeholder value.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols, names = {}, []
    for i, k in enumerate(keys):
        v = f"{prefix}{i}"
        if null_safe:
            cols[v] = F.coalesce(F.col(k), _null_placeholder(types[k]))
            cols[f"{v}n"] = F.col(k).isNull()
            names += [v, f"{v}n"]
        else:
            cols[v] = F.col(k)
            names.append(v)
    return df.withColumns(cols), names


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join whose ``left`` side may hold hot keys, null keys or identical rows.

    Spark decides: a ``right`` whose measured size is under the broadcast
    threshold is broadcast, and no row of ``left`` meets another.  Otherwise
    both sides are shuffled and adaptive execution cuts an oversized partition
    of ``left`` into several tasks by map output, which spreads equal rows and
    nulls as well as distinct ones, and needs no counting job.

    It can do so only where both sides come straight from a shuffle made for
    this join.  A ``right`` that was aggregated on the same keys would bring
    its own partitioning along, so a hash of the keys is joined on too (keys of
    unlike types hashed as the type Spark compares them in): the aggregate (one
    row per key) is shuffled once more, ``left`` not more often than before."""
    keyed = []
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        common = a if a == b else left.select(k).unionByName(right.select(k)).schema[k].dataType
        keyed.append(F.col(k).cast(common))
    hashed = F.xxhash64(*keyed)
    return (left.withColumn("__hash", hashed)
                .join(right.withColumn("__hash", hashed), ["__hash", *keys], how)
                .drop("__hash"))


#: Rows of a key on the left, and on the right, that are multiplied at a time.
BLOCK, CHUNK = 128, 256
#: Places of the left side a task, so that few keys meet in one task.
PLACES = 4


def fan_out_join(left: DataFrame, right: DataFrame, key: str, tasks: int) -> DataFrame:
    """Left join on ``key`` whose result is far larger than both sides.

    Each key's rows are multiplied a block of ``left`` by a chunk of ``right`` at
    a time, a left row's matches following each other.  All rows come out, in an
    order in which a column repeats one value or a short run of values: a file
    written from it packs them to a fraction of a byte a row, where rows in the
    order of ``left`` take a value of ``right`` each.

    No task holds a key of ``left``: its rows are cut into blocks, and the blocks
    are dealt out to ``tasks`` by the rows that they make.  Equal rows of ``left``
    are counted and numbered first, so they are dealt out too.  ``right`` is
    broadcast, its rows numbered a key at a time.  Rows of ``left`` without a key
    meet nothing and stay where they are."""
    from ledgerline.operators.lifecycle import numbered_copies

    lefts, rights = ([c for c in df.columns if c != key] for df in (left, right))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*rights)) - 1
    chunked = right.filter(F.col(key).isNotNull()).withColumn("__chunk", F.floor(nth / CHUNK).cast("int"))
    matches = right.groupBy(key).agg(F.count(F.lit(1)).alias("__matches"))
    counted = left.filter(F.col(key).isNotNull()).groupBy(*left.columns).agg(F.count(F.lit(1)).alias("__n"))
    # One row a key: the blocks of its rows, their places, and the chunks that each block meets.
    made = F.col("__rows") * F.col("__matches")
    places = F.ceil(made / F.sum(made).over(Window.partitionBy()) * (PLACES * tasks))
    sizes = (counted.groupBy(key).agg(F.sum("__n").alias("__rows")).join(F.broadcast(matches), key, "left")
                    .withColumn("__matches", F.coalesce("__matches", F.lit(1)))
                    .select(key, places.alias("__places"), F.greatest(F.ceil(F.col("__rows") / BLOCK), places).alias("__blocks"),
                            F.ceil(F.col("__matches") / CHUNK).cast("int").alias("__chunks")))
    blocks = (numbered_copies(counted).join(F.broadcast(sizes), key)
              .withColumn("__block", F.pmod(F.xxhash64(*lefts, "__ordinal"), F.col("__blocks")))
              .withColumn("__place", F.pmod("__block", "__places"))
              .repartition(tasks, key, "__place")
              .groupBy(key, "__place", "__block", "__chunks").agg(F.collect_list(F.struct(*lefts)).alias("__left")))
    dealt = (blocks.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
                   .select(key, "__chunk", F.inline("__left")))
    # A task holds all rows made of one input row of generated code.  The coalesce merges
    # nothing, but ends that code, so a block's matches are not made at once.
    met = dealt.coalesce(tasks).join(F.broadcast(chunked), [key, "__chunk"], "left").select(key, *lefts, *rights)
    alone = left.filter(F.col(key).isNull()).select(key, *lefts, *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rights))
    return met.unionByName(alone)
