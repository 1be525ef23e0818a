"""Transfers consolidation (incremental union of several raw tables).

One plan: a watermark probe on the target (one scalar), one filtered scan
per source with the watermark pushed into it, per-source mapping, one
``unionByName``, a keep-first on the process key and one stamp.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ledgerline.functions.keys import concat_strict
from ledgerline.functions.text import clean_all_strings, remove_special
from ledgerline.functions.values import net_value, recode_category
from ledgerline.operators.columns import rename_map
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.incremental import max_value, typed_literal
from ledgerline.operators.lifecycle import Run, stamp
from ledgerline.operators.setops import align_to_schema, union_all


@dataclass
class TransferSource:
    name: str                                  # 'fuente' value
    table: DataFrame                           # raw table with fecha_procesamiento
    rename: dict[str, str]
    int_columns: list[str] = field(default_factory=list)
    constants: dict[str, object] = field(default_factory=dict)
    #: how the net value is made: by the category of the sale (X27), as the
    #: difference of two charges (X31), or zero
    net: str | tuple[str, str] = "category"
    copies: dict[str, str] = field(default_factory=dict)      # new column -> column


# --- fixed values: what each kind of source writes into its rows ----------------------
INSTALLED = {"estado_2": "INSTALADA", "tipo_v": "ALTAS_F", "tipo": "ALTAS_F", "base": "FIJO"}
KEYED = {"estado_2": "DIGITADA", "tipo_v": "VENTAS_F", "tipo": "DIGITADO", "base": "FIJO"}
CANCELLED = {"estado_2": "CANCELADA", "tipo_v": "CANCELADAS_F", "tipo": "CANCELADAS_F", "base": "FIJO",
             "val_dif_service": 0, "renta_wo_anterior": 0, "renta_wo_actual": 0, "diferencia_renta": 0}
ORDER_INTS = ["val_dif_service", "valor_servicio", "renta_wo_anterior", "renta_wo_actual", "diferencia_renta"]
UPSELL_INTS = ["monthly_rental_charge", "renta_mes_anterior"]


def order_source(name: str, table: DataFrame, rename: dict[str, str], installed: bool) -> TransferSource:
    """Installed or keyed orders: net value by category."""
    extra = {"adicional_inf1": ""} if installed else {}
    return TransferSource(name, table, rename, ORDER_INTS, {**(INSTALLED if installed else KEYED), **extra})


def upsell_source(name: str, table: DataFrame, rename: dict[str, str], installed: bool) -> TransferSource:
    """Up-sell orders: net value is the charge less the previous one."""
    return TransferSource(name, table, rename, UPSELL_INTS, INSTALLED if installed else KEYED, ("monthly_rental_charge", "renta_mes_anterior"),
                          {"renta_wo_actual": "monthly_rental_charge", "renta_wo_anterior": "renta_mes_anterior"})


def cancelled_source(name: str, table: DataFrame, rename: dict[str, str]) -> TransferSource:
    """Cancelled orders: no difference, no rent, no net value."""
    return TransferSource(name, table, rename, ["valor_servicio"], CANCELLED, "zero")


def consolidate(sources: list[TransferSource], target: DataFrame | None, schema: StructType,
                run: Run, inclusive: bool = False, processed_col: str = "fecha_procesamiento") -> DataFrame:
    mark = max_value(target, processed_col) if target is not None else None   # C9
    frames = []
    for rank, src in enumerate(sources):
        df = src.table
        if mark is not None:                                                    # F17
            lit = typed_literal(mark, dict(df.dtypes)[processed_col])
            cond = F.col(processed_col) >= lit if inclusive else F.col(processed_col) > lit
            df = df.filter(cond)
        df = rename_map(df.drop(processed_col), src.rename)
        df = df.withColumns({c: F.coalesce(F.col(c).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
                             for c in src.int_columns if c in df.columns})
        df = df.withColumns({k: F.lit(v) for k, v in src.constants.items()})
        df = df.withColumns({k: F.col(c) for k, c in src.copies.items()})
        if src.net == "category" and "origen_datos" in df.columns:
            df = df.withColumn("valor_neto", net_value("origen_datos", "valor_servicio", "val_dif_service"))
        elif src.net == "zero":
            df = df.withColumn("valor_neto", F.lit(0).cast("bigint"))
        elif src.net != "category":
            df = df.withColumn("valor_neto", F.col(src.net[0]) - F.col(src.net[1]))
        if "origen_datos" in df.columns:
            df = df.withColumn("origen_datos", recode_category("origen_datos"))
        df = df.withColumn("fuente", F.lit(src.name)).withColumn("__src", F.lit(rank))
        df = clean_all_strings(df, remove_special)                              # X3
        frames.append(df)
    full = StructType(list(schema.fields) + [StructField("__src", IntegerType())])
    aligned = [align_to_schema(f, full) for f in frames]                                   # J8
    out = union_all(aligned).withColumn(
        "llave_proceso", concat_strict("orden_trabajo", "codigo_servicio", "tipo_v"))     # X41
    out = keep_first(out, ["llave_proceso"], ["__src", "orden_trabajo", "codigo_servicio"]).drop("__src")
    return stamp(out, run, None)


# --- demo configuration on the driver's lineitem table -------------------
TRANSFERS_SCHEMA = StructType([
    StructField("cuenta", StringType()), StructField("orden_trabajo", StringType()), StructField("codigo_servicio", StringType()),
    StructField("origen_datos", StringType()), StructField("valor_servicio", LongType()),
    StructField("val_dif_service", LongType()), StructField("renta_wo_anterior", LongType()),
    StructField("renta_wo_actual", LongType()), StructField("valor_neto", LongType()), StructField("estado_2", StringType()),
    StructField("tipo_v", StringType()), StructField("tipo", StringType()), StructField("base", StringType()),
    StructField("fuente", StringType())])

DEMO_RUN = Run(job="transfers", run_id="RUN-TRANSFERS-0001",
               started=__import__("datetime").datetime(2024, 1, 2, 0, 0, 0))

_RENAME = {"cta": "cuenta", "ot": "orden_trabajo", "cod_serv": "codigo_servicio", "origen": "origen_datos",
           "valor": "valor_servicio", "dif": "val_dif_service", "cargo": "monthly_rental_charge", "previo": "renta_mes_anterior"}


def demo_sources(lineitem: DataFrame) -> list[TransferSource]:
    """Seven sources: lineitem by its line number, shaped as each raw table."""
    money = F.col("l_extendedprice")
    part = lambda n: lineitem.filter(F.col("l_linenumber") == n)
    ids = [F.col("l_suppkey").cast("string").alias("cta"), F.col("l_orderkey").cast("string").alias("ot"),
           F.col("l_partkey").cast("string").alias("cod_serv"), F.col("l_shipdate").alias("fecha_procesamiento")]
    kind = (F.when(F.col("l_returnflag") == "R", F.lit("A")).when(F.col("l_returnflag") == "A", F.lit("NEW"))
            .when(F.col("l_linestatus") == "O", F.lit("UP SELLING")))
    orders = lambda n: part(n).select(*ids, kind.alias("origen"), money.alias("valor"), (money * F.col("l_discount")).alias("dif"),
                                      F.col("l_quantity").alias("renta_wo_anterior"), (F.col("l_quantity") + 1).alias("renta_wo_actual"),
                                      F.lit(1).alias("diferencia_renta"))
    upsell = lambda n: part(n).select(*ids, money.alias("cargo"), F.when(F.col("l_tax") != 0, money * F.col("l_tax")).alias("previo"))
    cancelled = lambda n: part(n).select(*ids, F.when(F.col("l_quantity") > 5, money).alias("valor"))
    return [
        order_source("INSTALADAS", orders(1), _RENAME, True), order_source("INSTALADAS 999", orders(2), _RENAME, True),
        upsell_source("INSTALADAS UP", upsell(3), _RENAME, True), order_source("DIGITADAS", orders(4), _RENAME, False),
        upsell_source("DIGITADAS UP", upsell(5), _RENAME, False), cancelled_source("CANCELADAS", cancelled(6), _RENAME),
        cancelled_source("CANCELADAS 999", cancelled(7), _RENAME)]


def demo_target(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz")) \
                   .select(F.col("l_shipdate").alias("fecha_procesamiento"))
