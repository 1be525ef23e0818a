"""Fixed-line sales curation for the business-day window."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.constants import (MANAGER_UNASSIGNED, MOJIBAKE_REPAIRS, NOT_APPLICABLE,
                                            NOT_RECORDED, OTHERS, UNASSIGNED_SPELLINGS)
from ledgerline.functions.dates import business_day_window, month_label, month_number
from ledgerline.functions.predicates import exclude_all, not_equal_keep_null
from ledgerline.functions.text import replace_map
from ledgerline.functions.values import fill_by_map, normalise_unassigned, replace_list
from ledgerline.operators.lifecycle import Run, stamp
from ledgerline.operators.profile import count_before_after

DROP = ["sector_economico", "trm"]
NEG_P_COLUMNS = ["tipo_v", "tipo_venta", "ito_mx", "num_contrato", "estado_contrato"]
FILLS = {"direccion": NOT_RECORDED, "fecha_legalizacion": "1900-01-01 00:00:00"}


def window(sales: DataFrame, run_date: _dt.date, col: str = "fecha_estado") -> DataFrame:
    """rows whose state date falls in the business-day window; the
    bounds are literals, so the filter reaches the scan."""
    start, end = business_day_window(F.lit(run_date))
    return sales.filter(F.col(col).cast("date").between(start, end))


def exclusions(df: DataFrame) -> list:
    conds = [not_equal_keep_null("red", "NP")]
    conds += [not_equal_keep_null(c, "NEG_P") for c in NEG_P_COLUMNS if c in df.columns]   # F8
    return conds


def curate(sales: DataFrame, run: Run, source: str) -> DataFrame:
    df = sales.drop(*DROP)                                                            # J6
    df = df.filter(exclude_all(exclusions(df)))
    df = df.withColumn("jefe", replace_list("jefe", MANAGER_UNASSIGNED, OTHERS))        # X22
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    df = df.withColumns({c: replace_map(c, MOJIBAKE_REPAIRS) for c in text_cols})      # X12
    df = df.withColumns({
        "linea_1_pyme": replace_list("linea_1_pyme", [NOT_RECORDED], OTHERS),
        "coordinador": replace_list("coordinador", [NOT_APPLICABLE], OTHERS),
        **{c: normalise_unassigned(c, UNASSIGNED_SPELLINGS) for c in ("gerencia", "jefatura", "consultor")},  # X23
        "mes_gestion_numero": month_label(month_number("mes_gestion")),                # X32
    })
    df = fill_by_map(df, FILLS)                                                        # X20
    return stamp(df, run, source)                               # C1


def exclusion_counts(sales: DataFrame) -> DataFrame:
    """Rows before the exclusions and rows they keep, one pass."""
    return count_before_after(sales, exclude_all(exclusions(sales)))


DEMO_RUN = Run(job="fixed_sales", run_id="RUN-FIJO-0001", started=_dt.datetime(1998, 3, 16, 6, 0, 0))
DEMO_RUN_DATE = _dt.date(1998, 3, 16)   # a Monday: Friday .. Sunday


def demo_sales(orders: DataFrame) -> DataFrame:
    from ledgerline.functions.constants import MONTH_NAMES
    names = F.array(*[F.lit(n.upper()) for n in MONTH_NAMES])
    k = F.col("o_custkey") % 5
    return orders.select(
        F.col("o_orderkey").alias("id_venta"), F.col("o_orderdate").alias("fecha_estado"),
        F.nullif(F.when(F.col("o_orderstatus") == "P", F.lit("NP")).otherwise(F.col("o_orderstatus")), F.lit("O"))
         .alias("red"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("NEG_P"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit(None)).otherwise(F.lit("ALTA")).alias("tipo_v"),
        F.when(F.col("o_totalprice") < 30000, F.lit("NEG_P")).otherwise(F.lit("VENTA")).alias("tipo_venta"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("SIN ASIGNACION"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("VENTAS SIN ASIGNAR"))
         .otherwise(F.concat(F.lit("JEFE "), k.cast("string"))).alias("jefe"),
        F.when(k == 0, F.lit(" SIN ASIGNACIÓN\n")).when(k == 1, F.lit("Espa�a"))
         .when(k == 2, F.lit("OTRA")).otherwise(F.lit("GERENCIA NORTE")).alias("gerencia"),
        F.when(k == 3, F.lit("SIN ASIGNACI?N")).otherwise(F.lit("JEFATURA SUR")).alias("jefatura"),
        F.when(k == 4, F.lit("NO APLICA")).otherwise(F.concat(F.lit("CONSULTOR "), k.cast("string"))).alias("consultor"),
        F.when(k == 1, F.lit("NO APLICA")).otherwise(F.lit("COORD")).alias("coordinador"),
        F.when(k == 2, F.lit("NO REGISTRA")).otherwise(F.lit("INTERNET")).alias("linea_1_pyme"),
        F.element_at(names, F.month("o_orderdate")).alias("mes_gestion"),
        F.when(k == 0, F.lit(None)).otherwise(F.lit("CALLE 1")).alias("direccion"),
        F.when(k == 1, F.lit(None)).otherwise(F.col("o_orderdate")).alias("fecha_legalizacion"),
        F.col("o_totalprice").alias("trm"), F.lit("X").alias("sector_economico"))
