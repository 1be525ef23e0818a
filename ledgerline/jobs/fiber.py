"""Fiber-order consolidation.

EAV extension rows are resolved (guarded cast join to the parameter
table, caption join, field-name filter) and pivoted to one row per order
(latest value per caption).  Order rows from two layouts are mapped to one
target, cleaned, enriched with the pivot, given state ids (defaults 13 and
6), and only rows history does not hold are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import coerce_number
from ledgerline.functions.text import lstrip_char
from ledgerline.functions.values import null_if_in
from ledgerline.operators.columns import apply_mapping, pad_columns
from ledgerline.operators.dims import lookup
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.lifecycle import Run, with_row_ids
from ledgerline.operators.pivot import eav_pivot, guarded_bigint
from ledgerline.operators.setops import union_all

# --- fixed values: caption -> target column of the pivoted extension data --
CAPTION_COLUMNS = {
    "Proyecto": "proyecto",
    "Dirección Comercial": "direccion_comercial",
    "Familia": "familia_1",
    "Clases Producto": "clase_producto",
    "Servicio/Componente": "servicio_componente",
    "Tipo de Contrato": "tipo_contrato",
}
# Field-name fragments of the extension fields that are read.
FIELD_PATTERNS = ["198", "189", "169", "170", "171", "147"]
# Project codes that mean "none".
PROJECT_SENTINELS = ["0", ".", "NA", "N/A", "NO", "n/a", "00", "N", "..", "N.A", "0."]
# Columns of the target table, in order.
LAYOUT = [
    "id_macrofo", "id_ejecucion", "id", "id_orden_trabajo_padre", "otc_diferida",
    "id_estado_orden_trabajo", "id_estado_venta", "fecha_creacion", "mes_creacion", "fecha_inicio_facturacion", "fecha_estado",
    "mes_estado", "nit", "razon_social", "id_cliente", "consultor_base",
    "usuario_grupo_consultor", "producto", "linea", "tipo_linea", "velocidad",
    "ciudad_incidente", "proceso_tipo_venta", "num_servicios", "monto_moneda_local_activacion",
    "monto_moneda_local_cargo_mensual", "soporte_pc", "monto_moneda_local_arriendo",
    "duracion_contrato", "trm_creacion", "trm_cambio_estado", "monto_moneda_local_otros",
    "variacion_monto_moneda_local_mensual", "variacion_monto_moneda_local_arriendo",
    "variacion_cargo_arriendo", "variacion_total_moneda_local", "variacion_total",
    "nro_contrato", "id_proceso_tipo_venta", "ciudad_destino", "tipo_venta",
    "segmento", "segmento_mercado", "nodo", "descripcion", "id_enlace", "id_tipo",
    "tipo_orden_trabajo", "resolucion1", "resolucion2", "resolucion3",
    "resolucion4", "resolucion_venta", "familia", "ciudad_origen", "grupo_objetivo",
    "nombre_consultor", "cod_proyecto", "clase_producto", "tipo_contrato", "servicio_componente",
    "direccion_comercial", "proyecto", "familia_1", "id_estado", "fecha_inicio_procesamiento",
]
# Columns put in upper case, filled with 0, read as whole numbers (else 0), stripped of "$".
UPPER_COLUMNS = ["estado_orden_trabajo", "estado_venta", "ciudad_incidente", "id_proceso_tipo_venta", "ciudad_destino", "tipo_venta",
                 "segmento_mercado", "descripcion", "resolucion1", "resolucion2", "resolucion3", "resolucion4",
                 "resolucion_venta", "familia", "ciudad_origen", "grupo_objetivo", "cod_proyecto"]
ZERO_COLUMNS = ["monto_moneda_local_activacion", "monto_moneda_local_cargo_mensual", "monto_moneda_local_otros",
                "variacion_monto_moneda_local_mensual", "variacion_monto_moneda_local_arriendo", "variacion_cargo_arriendo"]
WHOLE_COLUMNS = ["variacion_total_moneda_local", "variacion_total"]
DOLLAR_COLUMNS = ["id_tipo", "tipo_orden_trabajo"]
DEFAULT_ORDER_STATE = 13
DEFAULT_SALE_STATE = 6


@dataclass
class FiberInputs:
    eav: DataFrame          # (id_orden_trabajo_padre, chfieldname, vchdatavalue, dtupdatedate, seq)
    params: DataFrame       # (iparameterid BIGINT, vchparameterdesc)
    fields: DataFrame       # (chfieldname, vchfieldcaption)
    layouts: list[tuple[DataFrame, dict[str, str]]]   # (orders, source->target mapping)
    order_states: DataFrame  # (id, estado)
    sale_states: DataFrame   # (id, estado)
    history: DataFrame       # (id, id_orden_trabajo_padre, producto)


def pivot_extension(eav: DataFrame, params: DataFrame, fields: DataFrame) -> DataFrame:
    """N22 + F21 + A9: one row per order with the latest value per caption."""
    cond = F.lit(False)
    for p in FIELD_PATTERNS:
        cond = cond | F.col("chfieldname").like(f"%{p}%")
    e = eav.filter(cond).withColumn("__pid", guarded_bigint("vchdatavalue"))
    p = params.select(F.col("iparameterid").alias("__pid"), F.col("vchparameterdesc").alias("dato_columna"))
    f = fields.select("chfieldname", F.col("vchfieldcaption").alias("nombre_columna"))
    resolved = e.join(p, "__pid", "inner").join(f, "chfieldname", "inner")
    wide = eav_pivot(resolved, "id_orden_trabajo_padre", "nombre_columna", "dato_columna",
                     "dtupdatedate", list(CAPTION_COLUMNS), tiebreak=["seq"])
    wide = wide.withColumnsRenamed(CAPTION_COLUMNS)
    return wide.withColumns({c: F.upper(F.col(c)) for c in CAPTION_COLUMNS.values()})


def _state_lookup(df: DataFrame, col: str, states: DataFrame, out: str, default: int) -> DataFrame:
    # A repeated label keeps the last id; labels are matched upper-case.
    labels = states.select("id", F.upper("estado").alias("estado"))
    j = lookup(df, labels, col, "estado", {"id": out}, {out: default}, order_col="id")
    return j.withColumn(out, F.col(out).cast("int"))


def consolidate(inp: FiberInputs, run: Run) -> DataFrame:
    mapped = union_all([apply_mapping(df, m) for df, m in inp.layouts])            # J9 + U1
    types = {c: "bigint" for c in [*WHOLE_COLUMNS, *ZERO_COLUMNS]}
    state = ["estado_orden_trabajo", "estado_venta"]
    wanted = [c for c in [*LAYOUT, *state] if c not in (*CAPTION_COLUMNS.values(), "id_macrofo", "id_ejecucion", "id_estado",
                                                        "id_estado_orden_trabajo", "id_estado_venta", "fecha_inicio_procesamiento")]
    mapped = pad_columns(mapped, {c: types.get(c, "string") for c in wanted})       # J7
    base = mapped.withColumns({
        "id": F.coalesce(F.col("id"), F.lit(0).cast("bigint")),
        **{c: F.upper(c) for c in UPPER_COLUMNS},                                  # X49
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_COLUMNS},               # X20
        **{c: coerce_number(c, "bigint") for c in WHOLE_COLUMNS},                  # X17
        **{c: lstrip_char(c, "$") for c in DOLLAR_COLUMNS},                        # X6
    })
    base = base.withColumn("cod_proyecto", null_if_in("cod_proyecto", PROJECT_SENTINELS))  # X25
    # Only orders present in the main extract need their extension
    # data; a semi join trims the pivot's input (the left join below would
    # drop the others anyway).
    eav = inp.eav.join(base.select("id_orden_trabajo_padre").distinct(), "id_orden_trabajo_padre", "left_semi")
    ext = pivot_extension(eav, inp.params, inp.fields)
    base = base.join(ext, "id_orden_trabajo_padre", "left")
    base = _state_lookup(base, "estado_orden_trabajo", inp.order_states, "id_estado_orden_trabajo",
                         DEFAULT_ORDER_STATE)                                      # N13
    base = _state_lookup(base, "estado_venta", inp.sale_states, "id_estado_venta", DEFAULT_SALE_STATE)
    fresh = new_rows(base, inp.history, ["id", "id_orden_trabajo_padre", "producto"])   # N1
    fresh = with_row_ids(fresh, run.run_id, "id_macrofo").withColumns({
        "id_ejecucion": F.lit(run.run_id),
        "id_estado": F.lit(1),
        "fecha_inicio_procesamiento": F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz"),
    })
    return fresh.select(*LAYOUT)


# --- demo inputs on the driver's tables ----------------------------------
DEMO_RUN = Run(job="fiber", run_id="RUN-FIBER-0001", started=__import__("datetime").datetime(2024, 1, 3))

FIELD_CODES = {"view": "FLD198", "click": "FLD189", "purchase": "FLD169", "signup": "FLD300", "error": "FLD147"}
FIELD_CAPTIONS = [("FLD198", "Proyecto"), ("FLD189", "Familia"), ("FLD169", "Clases Producto"),
                  ("FLD147", "Tipo de Contrato"), ("FLD300", "Sin uso")]


def demo_inputs(spark, t) -> FiberInputs:
    e = t.events
    code = F.create_map(*[x for k, v in FIELD_CODES.items() for x in (F.lit(k), F.lit(v))])
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    eav = e.select(F.col("user_id").alias("id_orden_trabajo_padre"), code[F.col("event_type")].alias("chfieldname"),
                   F.when(F.col("value") > 90, F.concat(F.lit("x"), k))
                    .when(F.col("value") < 1, F.lit("123456789012345678901")).otherwise(k).alias("vchdatavalue"),
                   F.col("ts").alias("dtupdatedate"), F.col("event_id").alias("seq"))
    params = t.customer.select(F.col("c_custkey").alias("iparameterid"),
                               F.concat_ws(" ", F.col("c_mktsegment"), F.col("c_nationkey").cast("string"))
                                .alias("vchparameterdesc"))
    fields = spark.createDataFrame(FIELD_CAPTIONS, "chfieldname string, vchfieldcaption string")
    o = t.orders
    common = {"o_orderkey": "id", "o_custkey": "id_orden_trabajo_padre", "o_orderdate": "fecha_creacion",
              "o_orderpriority": "producto", "o_totalprice": "monto_moneda_local_arriendo"}
    a = o.filter(F.col("o_orderstatus") == "F").select(
        *common, F.lower("o_orderstatus").alias("est_ot"), F.col("o_orderpriority").alias("est_v"),
        F.concat(F.lit("$$"), F.col("o_orderstatus")).alias("tipo"),
        F.when(F.col("o_totalprice") < 50000, F.lit("n/a")).otherwise(
            F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))).alias("proy"),
        F.concat(F.lit("$$"), F.col("o_orderstatus")).alias("tot"), F.lower("o_orderpriority").alias("res1"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_totalprice")).alias("act"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit("x")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".7"))).alias("var"),
        F.concat(F.lit("rs "), F.col("o_custkey").cast("string")).alias("rs"))
    b = o.filter(F.col("o_orderstatus") != "F").select(
        *common, F.col("o_orderstatus").alias("ESTADO_OT"), F.lower("o_orderpriority").alias("ESTADO_VENTA"),
        F.concat(F.lit("$"), F.col("o_orderstatus")).alias("ID_TIPO"),
        F.when(F.col("o_totalprice") < 100000, F.lit("0")).otherwise(F.lit("PX")).alias("COD_PROYECTO"),
        F.concat(F.lit("$"), F.col("o_orderstatus")).alias("TOT"), F.lower("o_orderpriority").alias("RES1"))
    layouts = [(a, {**common, "est_ot": "estado_orden_trabajo", "est_v": "estado_venta", "tipo": "id_tipo",
                    "proy": "cod_proyecto", "tot": "tipo_orden_trabajo", "res1": "resolucion1",
                    "act": "monto_moneda_local_activacion", "var": "variacion_total", "rs": "razon_social"}),
               (b, {**common, "ESTADO_OT": "estado_orden_trabajo", "ESTADO_VENTA": "estado_venta",
                    "ID_TIPO": "id_tipo", "COD_PROYECTO": "cod_proyecto", "TOT": "tipo_orden_trabajo", "RES1": "resolucion1"})]
    order_states = spark.createDataFrame([(1, "f"), (2, "O"), (3, "o")], "id int, estado string")
    sale_states = spark.createDataFrame([(1, "1-urgent"), (2, "2-HIGH"), (3, "3-MEDIUM")], "id int, estado string")
    hist = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("id_orden_trabajo_padre"),
        F.col("o_orderpriority").alias("producto"))
    return FiberInputs(eav, params, fields, layouts, order_states, sale_states, hist)
