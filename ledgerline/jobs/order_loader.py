"""Order-event file loaders.

One function serves every loader of this shape; a loader is a
configuration: rename map, null fills, amount column, business key, date
sentinels, source label.  Steps: S18 -> J1 -> X20 -> F1 -> N1 -> X39 ->
X1 -> C1.  Writing (S11) and the audit row (C2) happen in ``run_loader``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import SENTINEL_DATE, SENTINEL_TIME_BASE
from ledgerline.functions.dates import fill_null_timestamp
from ledgerline.functions.predicates import positive_amount
from ledgerline.functions.text import clean_all_strings, strip_upper
from ledgerline.functions.values import fill_by_map
from ledgerline.operators.columns import rename_map, require_columns
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.key_index import KeyIndex
from ledgerline.operators.lifecycle import Run, stamp


@dataclass
class LoaderConfig:
    source: str                                   # value of the 'fuente' column
    rename: dict[str, str]                        # landed name -> target name
    key: list[str]                                # business key (target names)
    amount: str | None = None                     # F1 positive-amount column
    defaults: dict[str, object] = field(default_factory=dict)   # X20
    time_columns: list[str] = field(default_factory=list)       # null -> 1899-12-30
    date_columns: list[str] = field(default_factory=list)       # bad/null -> 1900-01-01
    required: list[str] | None = None            # S18 contract (landed names)


def transform(batch: DataFrame, history: DataFrame | KeyIndex, cfg: LoaderConfig, run: Run) -> DataFrame:
    """New, cleaned and stamped rows of ``batch``; nothing is written.

    ``history`` is the rows loaded before, or the index of their keys."""
    if cfg.required:
        require_columns(batch, cfg.required, cfg.source)
    df = rename_map(batch, cfg.rename)
    df = fill_by_map(df, cfg.defaults)
    if cfg.amount:
        df = df.filter(positive_amount(cfg.amount))
    # Typed null-safe key; history is pruned to the key columns.
    df = history.new_rows(df, cfg.key) if isinstance(history, KeyIndex) else new_rows(df, history, cfg.key)
    for c in cfg.time_columns:
        df = df.withColumn(c, fill_null_timestamp(c, SENTINEL_TIME_BASE))
    for c in cfg.date_columns:
        df = df.withColumn(c, fill_null_timestamp(c, SENTINEL_DATE))
    df = clean_all_strings(df, strip_upper)
    return stamp(df, run, cfg.source)


def run_loader(batch: DataFrame, history: DataFrame, cfg: LoaderConfig, run: Run,
               target_path: str, audit_path: str, error_path: str | None = None) -> int:
    """Transform, append, then write the audit row (only after success)."""
    from ledgerline.operators.lifecycle import audit_row, error_row
    from ledgerline.sources.sinks import append_table, write_audit
    spark = batch.sparkSession
    try:
        out = transform(batch, history, cfg, run)
        rows = append_table(out, target_path)
    except Exception as exc:
        if error_path:
            write_audit(error_row(spark, run, cfg.source, "transform", exc), error_path)
        raise
    write_audit(audit_row(spark, run, cfg.source, rows), audit_path)
    return rows


# Loader configuration used on the driver's tables: lineitem relabelled as
# the cancelled-orders sheet.
DEMO_RUN = Run(job="order_loader", run_id="RUN-ORDERS-0001",
               started=__import__("datetime").datetime(2024, 1, 1, 0, 0, 0))

DEMO_CONFIG = LoaderConfig(
    source="CANCELADAS CORREOS",
    rename={"l_orderkey": "cuenta", "l_linenumber": "ot", "l_returnflag": "codigo_servicio",
            "valor": "valor_servicio", "l_linestatus": "estado", "nombre": "nombres",
            "l_shipdate": "fecha_creacion", "hora": "hora_creacion", "permanencia": "fecha_permanencia"},
    key=["cuenta", "ot", "codigo_servicio"],
    amount="valor_servicio",
    defaults={"nombres": "NO REGISTRA", "estado": "NO REGISTRA", "valor_servicio": 0},
    time_columns=["hora_creacion"],
    date_columns=["fecha_permanencia"],
    required=["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"],
)


def demo_landed(lineitem: DataFrame) -> DataFrame:
    """lineitem shaped like a landed sheet: nulls, odd spacing, bad dates."""
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate",
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("valor"),
        F.concat(F.lit("\t"), F.lower(F.col("l_linestatus")), F.lit("  \n")).alias("l_linestatus"),
        F.when(F.col("l_quantity") > 40, F.lit(None))
         .otherwise(F.concat(F.lit(" cliente "), F.col("l_suppkey").cast("string"))).alias("nombre"),
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_shipdate")).alias("hora"),
        F.when(F.col("l_quantity") < 10, F.lit("31/02/2001"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("permanencia"))


def demo_history(lineitem: DataFrame) -> DataFrame:
    """Rows loaded by earlier runs, in target names."""
    return lineitem.filter(F.col("l_shipdate") < F.lit("2000-06-01").cast("timestamp_ntz")).select(
        F.col("l_orderkey").alias("cuenta"), F.col("l_linenumber").alias("ot"),
        F.col("l_returnflag").alias("codigo_servicio"))
