"""Record coalescing across sources (W4) and join-twin resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.joins import spread_join


def group_fill(df: DataFrame, key: str, order: list[str], cols: list[str] | None = None,
               distinct: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Per key, forward-fill then back-fill every column (pandas
    ``groupby(key).apply(ffill().bfill())``), then optionally de-duplicate.

    Null keys are dropped first (pandas ``groupby`` drops them).

    Two-level scan, so a key holding a large share of the rows is neither
    funnelled into one task nor rescanned per row:

    1. rows are range-partitioned on (key, order) -- a hot key is cut into
       several ordered chunks -- and checkpointed, so the chunking is fixed
       even if a task is recomputed;
    2. inside each (chunk, key) both fills are running windows (the
       backward fill is a forward fill in reverse order): linear work;
    3. a key lies in several chunks only if it is the least or the greatest of
       each: for these few keys a summary with one row per (key, chunk) holds
       each column's last and first non-null value; a window over those rows
       gives the value carried in from earlier / later chunks, and goes to
       every task (two rows a chunk at most);
    4. filled = coalesce(fill within chunk, carried from before,
       back-fill within chunk, carried from after).
    """
    from ledgerline.operators.numbering import ranges
    cols = cols or [c for c in df.columns if c != key]
    asc = [F.col(c).asc_nulls_last() for c in order]
    desc = [F.col(c).desc_nulls_first() for c in order]
    base = df.filter(F.col(key).isNotNull())
    chunks = (ranges(base, [F.col(key).asc(), *asc], num_partitions)
                  .withColumn("__pid", F.spark_partition_id())
                  .checkpoint(eager=True))
    fwd = Window.partitionBy("__pid", key).orderBy(*asc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rev = Window.partitionBy("__pid", key).orderBy(*desc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunks.withColumns({
        **{f"__f_{i}": F.last(F.col(c), ignorenulls=True).over(fwd) for i, c in enumerate(cols)},
        **{f"__b_{i}": F.last(F.col(c), ignorenulls=True).over(rev) for i, c in enumerate(cols)}})
    # Struct order puts nulls first, the windows last: the null flag leads.
    pos = F.struct(*[x.alias(f"p{i}") for i, x in enumerate(y for c in order for y in (F.col(c).isNull(), F.col(c)))])
    ends = chunks.groupBy("__pid").agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
    cut = (ends.select(F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias(key))
               .groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(key))
    summary = chunks.join(F.broadcast(cut), key, "left_semi").groupBy(key, "__pid").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), pos)).alias(f"__l_{i}") for i, c in enumerate(cols)],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), pos)).alias(f"__h_{i}") for i, c in enumerate(cols)])
    before = Window.partitionBy(key).orderBy(F.col("__pid").asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy(F.col("__pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        key, "__pid",
        *[F.last(F.col(f"__l_{i}"), ignorenulls=True).over(before).alias(f"__cf_{i}") for i in range(len(cols))],
        *[F.last(F.col(f"__h_{i}"), ignorenulls=True).over(after).alias(f"__cb_{i}") for i in range(len(cols))])
    joined = local.join(F.broadcast(carry), [key, "__pid"], "left")
    filled = joined.withColumns({
        c: F.coalesce(F.col(f"__f_{i}"), F.col(f"__cf_{i}"), F.col(f"__b_{i}"), F.col(f"__cb_{i}"))
        for i, c in enumerate(cols)})
    filled = filled.select(*df.columns)
    return filled.distinct() if distinct else filled


def resolve_twins(left: DataFrame, right: DataFrame, on, how: str = "left",
                  prefer: str = "left") -> DataFrame:
    """Join and collapse each shared non-key column into one, taking the
    preferred side first (pandas ``_x``/``_y`` then ``combine_first``)."""
    keys = [on] if isinstance(on, str) else list(on)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    l = left.select(*keys, *[F.col(c).alias(f"{c}__l") if c in shared else F.col(c)
                             for c in left.columns if c not in keys])
    r = right.select(*keys, *[F.col(c).alias(f"{c}__r") if c in shared else F.col(c)
                              for c in right.columns if c not in keys])
    j = spread_join(l, r, keys, how)
    first, second = ("__l", "__r") if prefer == "left" else ("__r", "__l")
    j = j.withColumns({c: F.coalesce(F.col(c + first), F.col(c + second)) for c in shared})
    return j.drop(*[c + s for c in shared for s in ("__l", "__r")])


def fill_across_sources(frames: list[DataFrame], key: str, order_cols: list[str]) -> DataFrame:
    """W4 as used on concatenated sources: union in the given order, drop exact
    duplicate rows (first occurrence wins), fill each key group forward then
    backward in (source, ``order_cols``) order, then de-duplicate.

    ``order_cols`` is the in-source row position (e.g. an ingest position)."""
    from ledgerline.operators.dedupe import keep_first
    from ledgerline.operators.setops import union_all
    tagged = [f.withColumn("__src", F.lit(i)) for i, f in enumerate(frames)]
    allf = union_all(tagged)
    data = [c for c in allf.columns if c not in ("__src", *order_cols)]
    first = keep_first(allf, data, ["__src", *order_cols], total=False)
    filled = group_fill(first, key, ["__src", *order_cols], [c for c in data if c != key], distinct=False)
    return filled.select(*data).distinct()
