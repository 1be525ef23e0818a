"""Incremental loading: keep only rows history does not already hold.

N1-N9 are all the same Spark plan: a left anti (or semi) join on typed key
columns with null-safe equality.  A daily batch is small and history is not,
so the batch's own keys are staged first and measured: where they are few they
are sent to the scan of history, only matching keys leave it, and no row of
history is shuffled (``matched_keys``).  Only a batch of many keys shuffles
history's keys, made distinct map-side so that a key repeated millions of
times costs one row per map task.  A hot batch key is cut by adaptive execution
(``joins.spread_join``).

History that is a small table by nature (domain tables) is better compared as
it is: ``small_history=True`` leaves the choice to Spark and stages nothing.
``key_index`` keeps history's keys in buckets, for history too large to scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.joins import normalised_keys, spread_join
from ledgerline.operators.staging import broadcast_if_small, staged_measured


def matched_keys(history: DataFrame, batch_keys: tuple[DataFrame, int], names: list[str]) -> DataFrame:
    """Distinct keys of ``history`` that the staged, distinct ``batch_keys``
    (with their measured bytes) hold; all of them if the batch has too many."""
    few, small = broadcast_if_small(*batch_keys)
    if small:
        return history.join(few, names, "left_semi").distinct()
    return history.distinct()


def _keyed_join(batch: DataFrame, history: DataFrame, keys, how: str,
                history_keys=None, null_safe: bool = True, small_history: bool = False) -> DataFrame:
    history_keys = list(history_keys or keys)
    if len(history_keys) != len(keys):
        raise ValueError("batch and history key lists differ in length")
    b, names = normalised_keys(batch, list(keys), "__k", null_safe)
    h = history.select(*[F.col(hk).alias(k) for hk, k in zip(history_keys, keys)])
    h, _ = normalised_keys(h, list(keys), "__k", null_safe)
    h = h.select(*names)
    known = h.distinct() if small_history else matched_keys(h, staged_measured(b.select(*names).distinct(), "batch-keys"), names)
    return spread_join(b, known, names, how).drop(*names)


def new_rows(batch: DataFrame, history: DataFrame, keys: list[str], history_keys: list[str] | None = None,
             null_safe: bool = True, small_history: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``history``."""
    return _keyed_join(batch, history, keys, "left_anti", history_keys, null_safe, small_history)


def existing_rows(batch: DataFrame, history: DataFrame, keys: list[str], history_keys: list[str] | None = None,
                  null_safe: bool = True, small_history: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is present in ``history``."""
    return _keyed_join(batch, history, keys, "left_semi", history_keys, null_safe, small_history)


def split_new_existing(batch: DataFrame, history: DataFrame, keys: list[str],
                       label: str = "estado_cruce") -> DataFrame:
    """Batch labelled NUEVO / EXISTENTE in one pass (one left join to the
    distinct history keys instead of an anti join plus a semi join)."""
    return membership_flag(batch, history, keys, label, yes="EXISTENTE", no="NUEVO")


def new_rows_by_day(batch: DataFrame, history: DataFrame, ts_col: str,
                    history_ts_col: str | None = None) -> DataFrame:
    """Drop whole days already present in history.

    Loaded days are made distinct map-side; a day that holds much of the
    batch is cut into several tasks (``spread_join``).
    """
    hcol = history_ts_col or ts_col
    days = history.select(F.to_date(F.col(hcol)).alias("__day")).distinct()
    return spread_join(batch.withColumn("__day", F.to_date(F.col(ts_col))), days, ["__day"], "left_anti").drop("__day")


def membership_flag(df: DataFrame, keys_df: DataFrame, keys: list[str], flag: str,
                    yes="SI", no="NO", key_df_cols: list[str] | None = None) -> DataFrame:
    """Label each row by whether its key appears in ``keys_df``
    (one left join to the distinct keys)."""
    kcols = key_df_cols or keys
    marks = keys_df.select(*[F.col(a).alias(b) for a, b in zip(kcols, keys)])
    b, names = normalised_keys(df, keys, "__m")
    m, _ = normalised_keys(marks, keys, "__m")
    m = matched_keys(m.select(*names), staged_measured(b.select(*names).distinct(), "row-keys"), names).withColumn("__hit", F.lit(True))
    out = spread_join(b, m, names, "left")
    return (out.withColumn(flag, F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no)))
               .drop("__hit", *names))


def max_value(df: DataFrame, col: str):
    """Global max as a Python scalar (one row leaves the cluster)."""
    return df.agg(F.max(col).alias("m")).first()["m"]


def typed_literal(value, data_type: str):
    """A collected scalar back as a literal of the column's own type.

    Date/time values go through ISO text: a naive Python ``datetime`` would
    otherwise be read in the driver's local time zone and shift."""
    import datetime as _dt
    if isinstance(value, (_dt.datetime, _dt.date)):
        text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
        return F.lit(text).cast(data_type)
    return F.lit(value).cast(data_type)


def watermark_increment(source: DataFrame, target: DataFrame, col: str,
                        target_col: str | None = None, inclusive: bool = False) -> DataFrame:
    """Rows of ``source`` newer than the newest row already loaded.

    The watermark is collected as a literal so the filter is pushed into
    the source scan (row-group and partition pruning).  An empty target
    loads everything.
    """
    mark = max_value(target, target_col or col)
    if mark is None:
        return source
    lit = typed_literal(mark, dict(source.dtypes)[col])
    cond = F.col(col) >= lit if inclusive else F.col(col) > lit
    return source.filter(cond)


def already_loaded(history: DataFrame, day, day_col: str = "fecha_carga") -> bool:
    """Has anything been loaded for ``day``?

    ``day_col`` is the date the table is partitioned by (``append_table``), so
    other days' files are not opened; one row of the day's is read at most."""
    return not history.filter(F.col(day_col) == F.lit(str(day)).cast("date")).limit(1).isEmpty()
