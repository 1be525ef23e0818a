"""Monthly targets load (four sheets) with the org-chart role lookup.

Sheets are unioned with their sheet name, month names become numbers,
document numbers are normalised (vacancies -> 11), each row is joined to
the (document, role) pairs of the newest org-chart version (may fan out),
and documents beyond INT32 are clamped as the target column requires.
Loading is guarded (nothing twice a day) and retires the previous load.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import STATE_ACTIVE
from ledgerline.functions.dates import month_number
from ledgerline.functions.numbers import clamp_int32
from ledgerline.functions.values import vacancy_document
from ledgerline.operators.joins import spread_join
from ledgerline.operators.lifecycle import Run, latest_version, with_row_ids
from ledgerline.operators.setops import union_all

# --- fixed values: columns of the monthly targets table ---------------------
COLUMNS = ["id", "id_ejecucion", "identificacion", "nombre", "id_cargo", "anio", "mes", "hoja_fuente", "tipo",
           "couta_mes", "fecha_procesamiento", "fuente", "id_estado_registro", "detalle"]


def build(sheets: dict[str, DataFrame], org_chart: DataFrame, run: Run, source: str) -> DataFrame:
    """``sheets``: name -> frame with (pos, CC, Nombre, Mes, Tipo, Meta[, Detalle])."""
    tagged = union_all([df.withColumn("hoja_fuente", F.lit(name)) for name, df in sheets.items()])   # S2 U1 S17
    doc = vacancy_document("CC", "Nombre")                                                              # X33
    df = tagged.select(
        "pos", F.lit(run.run_id).alias("id_ejecucion"),
        doc.try_cast("bigint").alias("identificacion"),
        F.col("Nombre").alias("nombre"),
        F.lit(run.started.year).alias("anio"),
        month_number("Mes").alias("mes"),                                                               # X32
        "hoja_fuente", F.col("Tipo").alias("tipo"), F.col("Meta").alias("couta_mes"),
        F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz").alias("fecha_procesamiento"),
        F.lit(source).alias("fuente"), F.lit(STATE_ACTIVE).alias("id_estado_registro"),
        (F.col("Detalle") if "Detalle" in tagged.columns else F.lit(None).cast("string")).alias("detalle"))
    roles = (latest_version(org_chart, "version")                                                       # N24
             .filter((F.col("identificacion") != 0) & (F.col("id_cargo") != 0))                       # F19
             .select("identificacion", "id_cargo").distinct())
    df = spread_join(df, roles, ["identificacion"], "left")                                             # N18
    df = df.withColumns({"id_cargo": F.coalesce(F.col("id_cargo"), F.lit(0)).cast("int"),
                         "identificacion": clamp_int32(F.col("identificacion"))})                       # X19
    return with_row_ids(df, run.run_id).select(*COLUMNS)


def load(sheets, org_chart, run: Run, source: str, already_loaded_today: bool) -> DataFrame | None:
    """The rows to append, or None when today's load exists.  Earlier
    loads are retired at read time (C5, ``lifecycle.current_state``)."""
    return None if already_loaded_today else build(sheets, org_chart, run, source)


# --- demo inputs on the driver's tables ----------------------------------
DEMO_RUN = Run(job="targets", run_id="RUN-TARGETS-0001", started=_dt.datetime(2024, 2, 1))
SHEETS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def demo_inputs(t) -> tuple[dict[str, DataFrame], DataFrame]:
    from ledgerline.functions.constants import MONTH_NAMES
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    o = t.orders
    sheets = {}
    for s in SHEETS:
        sheets[s] = o.filter(F.col("o_orderpriority") == s).select(
            F.col("o_orderkey").alias("pos"),
            F.when(F.col("o_totalprice") < 20000, F.lit(None))
             .when(F.col("o_totalprice") < 40000, F.lit("VACANTE"))
             .when(F.col("o_totalprice") > 450000, (F.col("o_custkey") * 10000000).cast("string"))
             .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(" "))).alias("CC"),
            F.when(F.col("o_orderstatus") == "P", F.lit("Vacante comercial"))
             .otherwise(F.concat(F.lit("Consultor "), F.col("o_custkey").cast("string"))).alias("Nombre"),
            F.when(F.col("o_totalprice") > 400000, F.lit("Brumario"))
             .otherwise(F.element_at(names, F.month("o_orderdate"))).alias("Mes"),
            F.col("o_orderstatus").alias("Tipo"), F.col("o_totalprice").alias("Meta"))
    c = t.customer
    org = union_all([
        c.select(F.col("c_custkey").alias("identificacion"), F.col("c_nationkey").alias("id_cargo"),
                 F.lit(1).alias("version")),
        c.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("identificacion"),
                                                (F.col("c_nationkey") + 100).alias("id_cargo"), F.lit(2).alias("version")),
        c.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("identificacion"),
                                                            F.lit(999).alias("id_cargo"), F.lit(2).alias("version")),
        c.filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("identificacion"),
                                                             F.lit(0).alias("id_cargo"), F.lit(2).alias("version")),
    ])
    return sheets, org


# --- fixed values: official-targets sheet header -> column ------------------
OFFICIAL_COLUMNS = {
    "ROL": "rol", "CÉDULA": "identificacion", "COMERCIAL": "nombre", "CARGO": "cargo", "CORREO": "correo",
    "JEFE": "jefe", "CORREO JEFE": "correo_jefe", "RETO ESTRATÉGICO": "reto_estrategico",
    "ALTAS FIJO": "altas_fijo", "BAJAS FIJO": "bajas_fijo", "NETO FIJO": "neto_fijo", "LÍNEAS": "lineas",
    "META MÓVIL": "altas_movil", "BAJAS MÓVIL": "bajas_movil", "NETO MÓVIL": "neto_movil", "CP MÓVIL": "cp_movil",
}


def official(sheet: DataFrame, run: Run, source: str, columns: dict[str, str] = OFFICIAL_COLUMNS,
             key: str = "identificacion") -> DataFrame:
    """Official / company targets: headers normalised (strip + upper), the
    contract columns selected and renamed (S18 J2 J4 J1), text cleaned (X2),
    the document coerced to BIGINT with 0 for bad values (X17), stamped."""
    from ledgerline.functions.numbers import coerce_number
    from ledgerline.functions.text import deep_clean
    from ledgerline.operators.columns import rename_by_rule, rename_map, select_required
    from pyspark.sql.types import StringType
    norm = rename_by_rule(sheet, rule=lambda c: c.strip().upper())
    df = rename_map(select_required(norm, list(columns)), columns)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != key]
    df = df.withColumns({c: deep_clean(c) for c in text})
    df = df.withColumn(key, coerce_number(key, "bigint"))
    return with_row_ids(df.select(*columns.values()), run.run_id).select(
        "id", F.lit(run.run_id).alias("id_ejecucion"), *columns.values(),
        F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz").alias("fecha_procesamiento"),
        F.lit(source).alias("fuente"), F.lit(STATE_ACTIVE).alias("id_estado_registro"))


# --- fixed values: company-targets sheet header -> column -------------------
COMPANY_COLUMNS = {
    "TIPO": "tipo", "CÉDULA": "identificacion", "NOMBRE": "nombre", "CARGO": "cargo", "NOMBRE GERENTE": "nombre_gerente",
    "DIRECTOR": "director", "ALTAS MÓVIL": "altas_movil", "BAJAS MÓVIL": "bajas_movil", "CAMBIO DE PLAN": "cambio_plan",
    "RETO ESTRATÉGICO MÓVIL": "reto_estrategico_movil", "NETO MÓVIL": "neto_movil",
    "INCENTIVO UNIDADES MÓVIL": "incentivo_unidades_movil", "LÍNEAS BAJAS": "lineas_bajas", "LÍNEAS NETAS": "lineas_netas",
}


def company(sheet: DataFrame, run: Run, source: str) -> DataFrame:
    """Company targets: headers normalised (strip + upper), the contract's
    columns selected and renamed (S18 J2 J4 J1); values are loaded as they are."""
    from ledgerline.operators.columns import rename_by_rule, rename_map, select_required
    norm = rename_by_rule(sheet, rule=lambda c: c.strip().upper())
    rows = rename_map(select_required(norm, list(COMPANY_COLUMNS)), COMPANY_COLUMNS)
    return with_row_ids(rows, run.run_id).select(
        "id", F.lit(run.run_id).alias("id_ejecucion"), *COMPANY_COLUMNS.values(),
        F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz").alias("fecha_procesamiento"),
        F.lit(source).alias("fuente"), F.lit(STATE_ACTIVE).alias("id_estado_registro"))
