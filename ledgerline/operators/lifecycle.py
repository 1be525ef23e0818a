"""Load control: stamping, audit rows, soft delete, versions.

Files are immutable, so "UPDATE ... SET state" becomes a rewrite of the
affected rows into a new snapshot.  Run ids and timestamps are literals
fixed at run start, never ``uuid()`` / ``current_timestamp()`` inside the
plan, so a recomputed task writes exactly what the audit counted.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, MapType, StringType, StructField, StructType,
                               TimestampNTZType)

from ledgerline.functions.constants import STATE_ACTIVE, STATE_INACTIVE
from ledgerline.functions.keys import row_id
from ledgerline.operators.joins import normalised_keys, spread_join


@dataclass(frozen=True)
class Run:
    """One execution of a job: id and start time fixed up front."""
    job: str
    run_id: str = field(default_factory=lambda: str(_uuid.uuid4()).upper())
    started: _dt.datetime = field(default_factory=lambda: _dt.datetime.now().replace(microsecond=0))


#: Equal rows that one task numbers at a time.
CHUNK = 1 << 16


def numbered_copies(counted: DataFrame, count_col: str = "__n", name: str = "__ordinal", chunk: int = CHUNK) -> DataFrame:
    """Each row once per its count, numbered from 1.

    Rows of up to ``chunk`` copies are written out where they are.  Larger
    counts are cut into chunks, and the chunks are dealt out to all tasks and
    written out one by one: no task holds more than a chunk's numbers, however
    many copies a row has."""
    n = F.col(count_col)
    few = counted.filter(n <= chunk).withColumn(name, F.explode(F.sequence(F.lit(1).cast("bigint"), n)))
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The starts of one row are cut in two steps, so that they are bounded too.
    wide = F.sequence(F.lit(1).cast("bigint"), n, F.lit(chunk * chunk).cast("bigint"))
    blocks = counted.filter(n > chunk).withColumn("__wide", F.explode(wide))
    starts = F.sequence(F.col("__wide"), F.least(n, F.col("__wide") + chunk * chunk - 1), F.lit(chunk).cast("bigint"))
    dealt = blocks.withColumn("__start", F.explode(starts)).drop("__wide").repartition(parts)
    many = dealt.withColumn(name, F.explode(F.sequence(F.col("__start"), F.least(n, F.col("__start") + chunk - 1)))).drop("__start")
    return few.unionByName(many)


#: Tasks that rows equal in all their values are dealt to.
SPREAD = 16


def _dealt(df: DataFrame) -> DataFrame:
    """The rows dealt out by their values, equal ones to up to ``SPREAD`` tasks.

    Rows that are all distinct don't shrink when they are counted map-side, and a
    task that reads a large part of a file would hold a table of all its rows.
    Here adaptive execution bounds a task's share by its advisory size, whatever
    the files are."""
    share = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    return df.withColumn("__share", share).repartition("__share", F.xxhash64(*df.columns)).drop("__share")


def with_row_ids(df: DataFrame, run_id: str, name: str = "id", unique: bool = False) -> DataFrame:
    """A unique, deterministic id for every row, also of equal rows.

    The id is taken from all of the row's values and its ordinal among rows
    equal in all of them.  Equal rows are counted (dealt out and combined first:
    a row repeated millions of times is one partial count per task) and written out
    again with 1..n in chunks, so neither a window nor an array gathers them.
    ``unique=True`` says that no two rows are equal (a key was made unique
    before): each has the ordinal 1, and nothing is shuffled to find out.  Map
    columns can't be grouped and are refused."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
    if maps:
        raise TypeError(f"map columns have no row identity: {maps}")
    ident = row_id(*df.columns, "__ordinal", run_id=run_id)
    if unique:
        each = df.withColumn("__ordinal", F.lit(1).cast("bigint"))
    else:
        each = numbered_copies(_dealt(df).groupBy(*[F.col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")))
    return each.select(ident.alias(name), *[c for c in df.columns if c != name])


def stamp(df: DataFrame, run: Run, source: str | None, state: int | str = STATE_ACTIVE,
          processed_col: str = "fecha_procesamiento", unique: bool = False) -> DataFrame:
    """C1 + J10: id, run id, processed-at, source, state; control columns first."""
    out = with_row_ids(df, run.run_id, unique=unique).withColumns({
        "id_ejecucion": F.lit(run.run_id),
        processed_col: F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz"),
        "id_estado": F.lit(str(state)),
    })
    if source is not None:  # None keeps a per-row 'fuente' already present
        out = out.withColumn("fuente", F.lit(source))
    data = [c for c in df.columns if c != "id"]
    control = [c for c in out.columns if c not in ("id", "id_ejecucion", *data)]
    return out.select("id", "id_ejecucion", *data, *control)


AUDIT_SCHEMA = StructType([
    StructField("id_ejecucion", StringType()),
    StructField("proceso", StringType()),
    StructField("fuente", StringType()),
    StructField("cantidad_registros", LongType()),
    StructField("id_estado", IntegerType()),
    StructField("fecha_inicio", TimestampNTZType()),
    StructField("fecha_fin", TimestampNTZType()),
    StructField("duracion_segundos", LongType()),
])

ERROR_SCHEMA = StructType([
    StructField("id_ejecucion", StringType()),
    StructField("proceso", StringType()),
    StructField("fuente", StringType()),
    StructField("funcion", StringType()),
    StructField("descripcion_error", StringType()),
    StructField("fecha_error", TimestampNTZType()),
])


def audit_row(spark: SparkSession, run: Run, source: str, rows: int,
              finished: _dt.datetime | None = None, state: int = STATE_ACTIVE) -> DataFrame:
    """C2 + C3: one summary row written once, after the load, with both times."""
    end = finished or _dt.datetime.now().replace(microsecond=0)
    secs = int((end - run.started).total_seconds())
    return spark.createDataFrame(
        [(run.run_id, run.job, source, int(rows), int(state), run.started, end, secs)], AUDIT_SCHEMA)


def error_row(spark: SparkSession, run: Run, source: str, function: str, exc: BaseException,
              when: _dt.datetime | None = None) -> DataFrame:
    """C4: error row; message cut to 100 characters."""
    at = when or _dt.datetime.now().replace(microsecond=0)
    return spark.createDataFrame(
        [(run.run_id, run.job, source, function, str(exc)[:100], at)], ERROR_SCHEMA)


def audit_counts(df: DataFrame, rows_col: str = "cantidad_registros") -> DataFrame:
    """C2 over a loaded table: rows per run (deterministic part of the audit)."""
    return df.groupBy("id_ejecucion", "fuente").agg(F.count(F.lit(1)).cast("bigint").alias(rows_col))


def current_state(table: DataFrame, load_col: str = "fecha_procesamiento", state_col: str = "id_estado",
                  active=STATE_ACTIVE, inactive=STATE_INACTIVE) -> DataFrame:
    """C5 at read time: rows of the newest load are active, active rows of
    earlier loads read as inactive, other states stay.

    Loads are only ever appended; nothing stored is rewritten.  The newest load
    is one value, found from the footers of the files where they hold it."""
    from ledgerline.operators.incremental import typed_literal
    newest = table.agg(F.max(load_col).alias("m")).first()["m"]
    t = dict(table.dtypes)[state_col]
    old = ~F.col(load_col).eqNullSafe(typed_literal(newest, dict(table.dtypes)[load_col]))
    return table.withColumn(state_col, F.when(old & (F.col(state_col) == F.lit(active).cast(t)), F.lit(inactive).cast(t))
                            .otherwise(F.col(state_col)))


def soft_delete_append(current: DataFrame, new: DataFrame, state_col: str = "id_estado",
                       active=STATE_ACTIVE, inactive=STATE_INACTIVE) -> DataFrame:
    """C5 as one frame: what ``current_state`` reads once ``new`` is appended."""
    t = dict(current.dtypes)[state_col]
    old = current.withColumn(state_col, F.when(F.col(state_col) == F.lit(active).cast(t),
                                               F.lit(inactive).cast(t)).otherwise(F.col(state_col)))
    return old.unionByName(new.withColumn(state_col, F.lit(active).cast(t)), allowMissingColumns=True)


def targeted_state_update(table: DataFrame, updates: DataFrame, keys: list[str],
                          new_state, state_col: str = "id_estado",
                          skip_if: object | None = None) -> DataFrame:
    """Set ``state_col`` for rows whose key is in ``updates`` (set-wise,
    no per-row statements).  Rows already in the target state are untouched."""
    t = dict(table.dtypes)[state_col]
    marks = updates.select(*keys).withColumn("__hit", F.lit(True))
    keyed, names = normalised_keys(table, keys, "__u")
    mk, _ = normalised_keys(marks, keys, "__u")
    mk = mk.select(*names, "__hit").distinct()
    joined = spread_join(keyed, mk, names, "left")
    target = F.lit(new_state).cast(t)
    cond = F.coalesce(F.col("__hit"), F.lit(False))
    if skip_if is not None:
        cond = cond & ~F.col(state_col).eqNullSafe(F.lit(skip_if).cast(t))
    return (joined.withColumn(state_col, F.when(cond, target).otherwise(F.col(state_col)))
                  .drop("__hit", *names))


def next_version(existing: DataFrame, version_col: str = "version") -> int:
    """``max(version) + 1``; 1 for an empty table."""
    m = existing.agg(F.max(version_col).alias("m")).first()["m"]
    return int(m or 0) + 1


def latest_version(df: DataFrame, version_col: str = "version",
                   per: list[str] | None = None) -> DataFrame:
    """Keep rows of the newest version (globally or per source).

    Global: the max is collected as a literal so it prunes partitions of a
    version-partitioned table.  Per source: a combinable max joined back."""
    if not per:
        from ledgerline.operators.incremental import typed_literal
        m = df.agg(F.max(version_col).alias("m")).first()["m"]
        return df.filter(F.col(version_col) == typed_literal(m, dict(df.dtypes)[version_col]))
    keyed, names = normalised_keys(df, per, "__s")
    mx = keyed.groupBy(*names).agg(F.max(version_col).alias("__mv"))
    return (spread_join(keyed, mx, names, "inner")
              .filter(F.col(version_col) == F.col("__mv")).drop("__mv", *names))


def retire(df: DataFrame, state_col: str = "id_estado", inactive=STATE_INACTIVE) -> DataFrame:
    """C11: mark a whole fact variant inactive."""
    t = dict(df.dtypes)[state_col]
    return df.withColumn(state_col, F.lit(inactive).cast(t))


def assert_unique(df: DataFrame, cols: list[str], sample: int = 5) -> DataFrame:
    """Deterministic ids need no repair loop, only a check.  One
    aggregation finds duplicated keys; a few of them are reported."""
    dups = df.groupBy(*cols).count().filter(F.col("count") > 1)
    found = dups.limit(sample).collect()
    if found:
        raise ValueError(f"duplicate values of {cols}: {[tuple(r)[:-1] for r in found]}")
    return df
