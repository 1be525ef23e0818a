"""Targeted state updates without rewriting the table.

An update appends (key, state, unless) rows to a log, one numbered folder per
update; the number is claimed, so updates made at once get an order.  A read
joins the newest state of each key onto the table, and leaves rows whose own
state is the update's ``unless``.  An update of ten keys writes ten rows, and a
read shuffles the table only if the log is too large to be broadcast.

``compact`` folds the log into one folder: it states up to which number it has
read, and updates with higher numbers still count after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import normalised_keys, spread_join
from ledgerline.operators.staging import broadcast_if_small, staged, staged_measured
from ledgerline.sources.commits import claim_version, versions


def log_states(updates: DataFrame, log: str, keys: list[str], new_state, unless=None) -> int:
    """Set the state of the rows whose key is in ``updates``; returns the
    update's number.  Null keys match null keys."""
    rows = updates.select(*keys).distinct().withColumns({
        "new_state": F.lit(new_state).cast("string"), "unless": F.lit(unless).cast("string"), "upto": F.lit(None).cast("bigint")})
    return claim_version(rows, log)


def _live(spark: SparkSession, log: str) -> DataFrame | None:
    """Log rows that count, with the number each takes effect at."""
    if not versions(spark, log):
        return None
    rows = spark.read.option("basePath", log).parquet(*[f"{log}/version={v}" for v in versions(spark, log)])
    rows = rows.withColumn("seq", F.coalesce("upto", F.col("version").cast("bigint")))
    upto = rows.agg(F.max("upto").alias("m")).first()["m"]
    if upto is None:
        return rows
    newest = rows.filter(F.col("upto") == upto).agg(F.max("version").alias("v")).first()["v"]
    return rows.filter((F.col("upto") == upto) & (F.col("version") == newest) | F.col("upto").isNull() & (F.col("version") > upto))


def newest_states(spark: SparkSession, log: str, keys: list[str]) -> DataFrame | None:
    """(keys, new_state, unless, seq): the last update of each key."""
    rows = _live(spark, log)
    if rows is None:
        return None
    last = F.max_by(F.struct("new_state", "unless", "seq"), "seq").alias("s")
    return rows.groupBy(*keys).agg(last).select(*keys, "s.*")


def with_states(table: DataFrame, log: str, keys: list[str], state_col: str = "id_estado") -> DataFrame:
    """The table as its log of updates says; nothing stored is changed."""
    found = newest_states(table.sparkSession, log, keys)
    if found is None:
        return table
    kind = dict(table.dtypes)[state_col]
    keyed, names = normalised_keys(table, keys, "__s")
    marks, _ = normalised_keys(found, keys, "__s")
    marks = marks.select(*names, F.col("new_state").alias("__new"), F.col("unless").alias("__unless"), F.lit(True).alias("__hit"))
    marks, size = staged_measured(marks, "states")
    few, small = broadcast_if_small(marks, size)
    joined = keyed.join(few, names, "left") if small else spread_join(keyed, marks, names, "left")
    stays = F.col("__hit").isNull() | F.col(state_col).cast("string").eqNullSafe(F.col("__unless")) & F.col("__unless").isNotNull()
    return joined.withColumn(state_col, F.when(stays, F.col(state_col)).otherwise(F.col("__new").cast(kind))).select(*table.columns)


def compact(spark: SparkSession, log: str, keys: list[str]) -> int | None:
    """Fold all updates so far into one folder of the newest state of each key."""
    seen = versions(spark, log)
    rows = newest_states(spark, log, keys)
    if rows is None:
        return None
    whole = staged(rows.select(*keys, "new_state", "unless", F.lit(seen[-1]).cast("bigint").alias("upto")), "compacted")
    return claim_version(whole, log)
