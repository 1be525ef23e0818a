"""Single-source loaders (G2-G8, G16, G17), each a short composition of
operators.  Every loader returns the rows to append; writing and the
audit row are done by the caller (``order_loader.run_loader`` pattern).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions import dates as D
from ledgerline.functions import numbers as N
from ledgerline.functions import predicates as P
from ledgerline.functions import text as T
from ledgerline.functions import values as V
from ledgerline.functions.constants import NOT_RECORDED, VACANCY_DOCUMENT
from ledgerline.operators import columns as C
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.dims import lookup_many
from ledgerline.operators.incremental import new_rows, new_rows_by_day
from ledgerline.operators.lifecycle import Run, stamp
from ledgerline.operators.setops import union_all
from ledgerline.operators.staging import staged
from ledgerline.sources import contracts, readers


# ---- G2: up-sell CSV ------------------------------------------------------
def upsell_csv(spark: SparkSession, path: str, history: DataFrame, run: Run, source: str) -> DataFrame:
    """Headerless latin-1 CSV, first seven positions."""
    width = len(contracts.UPSELL_CSV.fields)
    wide = contracts.positional_schema(max(width, 12), {i: (f.name, f.dataType)
                                                        for i, f in enumerate(contracts.UPSELL_CSV.fields)})
    df = readers.read_headerless_csv(spark, path, wide, keep=width)
    df = df.filter(P.positive_amount("monthly_rental_charge"))
    df = new_rows(df, history, ["cuenta", "ot", "service_code"])
    return stamp(T.clean_all_strings(df), run, source)


# ---- G3: sales / purchase CSV ---------------------------------------------
def sales_csv(spark: SparkSession, path: str, history: DataFrame, run: Run, source: str,
              width: int = 18) -> DataFrame:
    """Positions -> names, day-first date from parts."""
    schema = contracts.positional_schema(width, contracts.SALES_CSV_POSITIONS)
    df = readers.read_headerless_csv(spark, path, schema)
    df = df.select(*[v[0] for _, v in sorted(contracts.SALES_CSV_POSITIONS.items())])
    df = df.withColumn("fecha", D.date_from_parts("dia", "mes", "anio_2"))
    df = df.withColumn("valor", F.col("valor").try_cast("double")).filter(P.positive_amount("valor"))
    df = new_rows(df, history, ["cuenta", "ot", "codigo_servicio_ad"])
    return stamp(df, run, source)


# ---- G4: cloud sales --------------------------------------------------------
# --- fixed values: numeric columns of the cloud sheet ---------------------------
CLOUD_NUMERIC = ["id_cliente", "valor_unitario_sin_iva", "cedula_comercial"]


def cloud_sales(df: DataFrame, history: DataFrame, run: Run, source: str = "CLOUD CORREOS") -> DataFrame:
    """J2 F5 X2 X16 X24 N2 C1.

    The document 0 becomes that of vacancies before the numeric clean, so a
    document that is no number ends as 0, not as a vacancy."""
    df = C.rename_by_rule(df)
    df = df.filter(P.icontains("segmento_de_alta", "negocios")
                   & P.icontains("estado_inicial", "Activo Parallels")
                   & P.icontains("estado_final", "Activo"))
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in CLOUD_NUMERIC]
    df = df.withColumns({c: T.deep_clean(c) for c in text})
    df = df.withColumn("cedula_comercial", F.when(F.col("cedula_comercial").try_cast("double") == 0, F.lit(VACANCY_DOCUMENT))
                       .otherwise(F.col("cedula_comercial")))
    df = df.withColumns({c: N.digits_or_zero(c) for c in CLOUD_NUMERIC if c in df.columns})
    df = df.withColumn("reto_estrategico", V.keep_if_in("reto_estrategico", ["SI", "NO"], "NO"))
    df = df.withColumn("tipo_red", F.lit("CLOUD"))
    df = new_rows(df, history, ["llave"])
    return stamp(df, run, source)


# --- fixed values: columns of the manual cloud sales sheet -------------------
CLOUD_MANUAL_COLUMNS = [
    "fecha de venta", "mes", "año", "razon social", "nit", "customer id", "idsuscription", "producto",
    "no servicios", "valor total iva incluido", "nombres", "gerencia", "jefatura", "cordinación",
    "segmento de alta", "operacion",
]


def cloud_sales_manual(df: DataFrame, history: DataFrame, run: Run, source: str = "VENTAS MANUALES CLOUD") -> DataFrame:
    """The manual variant; a sale is known by its customer,
    sale day (as a sheet serial), subscription and product, compared typed."""
    df = C.select_required(C.rename_by_rule(df, rule=lambda c: c.lower()), CLOUD_MANUAL_COLUMNS)
    df = C.rename_by_rule(df, rule=lambda c: c.replace(" ", "_"))

    def keyed(rows: DataFrame) -> DataFrame:
        sold = F.col("fecha_de_venta").try_cast("timestamp_ntz")
        return rows.withColumn("fecha_de_venta", sold).withColumn("__serie", D.date_to_excel_serial(sold))

    df = new_rows(keyed(df), keyed(history), ["nit", "__serie", "customer_id", "producto"]).drop("__serie")
    return stamp(df, run, source)


# ---- G5: code master and network nodes -------------------------------------
def code_master(df: DataFrame, history: DataFrame, run: Run, source: str) -> DataFrame:
    """J1 X1 X17 X20 X26 N2."""
    df = T.clean_all_strings(df)
    df = V.fill_by_map(df, {"clasificacion": NOT_RECORDED, "clas_planeacion": NOT_RECORDED})
    df = df.withColumns({"capacidad_navegacion": N.coerce_number("capacidad_navegacion", "bigint"),
                         "soporte_pc": V.differs_from("saname", "SOPORTE PC")})
    df = new_rows(df, history, ["saserv"])
    return stamp(df, run, source)


def network_nodes(df: DataFrame, history: DataFrame, run: Run, source: str) -> DataFrame:
    """X7 X17 X21 N2."""
    df = df.withColumns({"departamento": T.truncate("departamento", 2), "codigo": T.truncate("codigo", 10),
                         "nombre_nodo": T.truncate("nombre_nodo", 50),
                         "largo": N.coerce_number("largo", "bigint")})
    df = V.fill_all(df, number=0, text="0")
    df = new_rows(df, history, ["id_nodo"])
    return stamp(df, run, source)


# --- fixed values: national long-distance sheet header -> column -------------
LONG_DISTANCE_COLUMNS = {
    "FECHA": "fecha", "MES DE DIGITACIÓN": "mes_digitacion", "AÑO DIGITACIÓN": "ano_digitacion",
    "TIPO DOCUMENTO": "tipo_documento", "NÚMERO DOCUMENTO": "numero_documento", "RAZÓN SOCIAL": "razon_social",
    "IDENTIFICACIÓN DEL CONSULTOR": "identificacion_consultor", "CONSULTOR": "consultor", "SERVICIO": "servicio",
    "VELOCIDAD/ PLAN": "velocidad_plan", "No LÍNEAS": "no_lineas", "CARGO INSTALACIÓN $": "cargo_instalacion",
    "VALOR DEL SERVICIO $": "valor_servicio", "SOPORTE PC": "soporte_pc", "VALOR RECUPERACIONES": "valor_recuperaciones",
    "ALQUILER EQUIPOS $": "alquiler_equipos", "DURACIÓN CONTRATO": "duracion_contrato", "TRM": "trm",
    "OBSERVACIONES": "observaciones", "ID": "id_ngn", "OT": "ot", "No CONTRATO": "no_contrato",
    "FECHA FIRMA DEL CONTRATO": "fecha_firma_contrato", "TIPO VENTA": "tipo_venta", "CIUDAD INCIDENTE": "ciudad_incidente",
    "DEPARTAMENTO": "departamento", "RED": "red", "CIUDAD DEL CONSULTOR": "ciudad_consultor", "REGIONAL": "regional",
    "CANAL": "canal", "PROVEEDOR": "proveedor", "CARGO": "cargo", "USUARIO": "usuario", "SEGMENTO": "segmento",
    "DIVISIÓN": "division", "MANUAL TARIFAS": "manual_tarifas", "CAMPAÑA / PROMOCIÓN": "campana_promocion", "ITO": "ito",
    "SERVICIO ITO": "servicio_ito", "FAMILIA": "familia", "CLASE": "clase", "COMPONENTE": "componente",
    "COORDINADOR IT": "coodinador_it", "CONSULTOR IT": "consultor_it", "NOTAS DESCRIPCION FO": "notas_descripcion_fo",
    "ID ORACLE": "id_oracle",
}


def long_distance(df: DataFrame, run: Run, source: str = "NGN LARGA DISTANCIA NACIONAL CORREOS") -> DataFrame:
    """The contract's columns, renamed and cleaned; every row is loaded."""
    df = C.rename_map(C.select_required(df, list(LONG_DISTANCE_COLUMNS)), LONG_DISTANCE_COLUMNS)
    return stamp(T.clean_all_strings(df), run, source)


# ---- G6: reference lists ----------------------------------------------------
def reference_list(df: DataFrame, history: DataFrame, run: Run, source: str, key: list[str],
                   serial_date_cols: tuple[str, ...] = ()) -> DataFrame:
    """Rename by rule, keep first per key in file order,
    Excel serials -> dates, new rows on the (typed, multi-column) key."""
    df = C.rename_by_rule(df)
    df = keep_first(df, key, ["_ingest_pos"]).drop("_ingest_pos")
    df = df.withColumns({c: D.excel_serial_to_date(c) for c in serial_date_cols})
    df = new_rows(df, history, key)
    return stamp(df, run, source)


# ---- G7: legalised orders, three layouts ----------------------------------
def legalised(a: DataFrame, b: DataFrame, c: DataFrame, history: DataFrame, run: Run,
              source: str = "LEGALIZADAS") -> DataFrame:
    """Three layouts -> (cuenta, ot, fecha, layout)."""
    la = a.select(F.col("Cuenta").cast("string").alias("cuenta"), F.col("OT").try_cast("bigint").alias("ot"),
                  D.excel_serial_to_date("Fecha Ultimo Estado").alias("fecha"), "_ingest_pos")
    lb = b.select(F.col("ID").cast("string").alias("cuenta"), F.col("OT").try_cast("bigint").alias("ot"),
                  F.try_to_date("FECHA DE LEGALIZACION").alias("fecha"), "_ingest_pos")
    lc = c.select(F.col("Cuenta").cast("string").alias("cuenta"), F.col("`O.T.`").try_cast("bigint").alias("ot"),
                  D.parse_date_text(T.first_token("Fecha último estado"), "dd/MM/yyyy").alias("fecha"),
                  "_ingest_pos")
    rows = union_all([f.withColumn("layout", F.lit(i + 1)) for i, f in enumerate((la, lb, lc))])
    rows = rows.dropna(subset=["ot"])                            # F4: also text that is no number
    rows = staged(keep_first(rows, ["layout", "ot"], ["_ingest_pos"]).drop("_ingest_pos"), "layouts")  # read for its keys and its rows
    return stamp(new_rows(rows, history, ["ot"]), run, source, unique=True)  # one read of history for all layouts


# ---- G8: virtual-database order extracts ------------------------------------
def virtual_db_orders(df: DataFrame, history: DataFrame, run: Run, source: str,
                      rename: dict[str, str], key: list[str]) -> DataFrame:
    """F3 J1 X5 X4 F10 X49 N1."""
    df = df.filter(F.col("aumento") != 0)
    df = C.rename_map(df, rename)
    df = df.withColumns({"email": T.trim_trailing_dots(F.lower("email")),
                         "telefono": T.remove_dots("telefono"),
                         "estado": F.upper("estado")})
    df = df.filter(P.not_matches("observacion", r"\*\*"))
    df = new_rows(df, history, key)
    return stamp(df, run, source)


# ---- G16: value-added services ----------------------------------------------
# --- fixed values: roles named in the value-added sheet ------------------------
VALUE_ADDED_ROLES = ["coordinador", "especialista", "jefe", "director", "gerente"]


def value_added(df: DataFrame, people: dict[str, DataFrame], run: Run, numbers: list[str], dates: list[str],
                source: str = "VALOR AGREGADO") -> DataFrame:
    """Clean text (null -> ''), map each role's name to
    its id (the last of a repeated name; null if nobody has it), null numbers
    to 0, dates as text.

    ``people``: role -> (nombre, id[, orden]).  Earlier loads are retired at
    read time (``lifecycle.current_state``)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    df = df.withColumns({c: F.coalesce(T.deep_clean(c), F.lit("")) for c in text if c not in dates})
    # One dimension of all roles; the last of a repeated name by its order.
    named = union_all([people[r].select(F.lit(r).alias("rol"), "nombre", "id", (F.col("orden") if "orden" in people[r].columns else F.lit(None)).cast("bigint").alias("orden"))
                       for r in VALUE_ADDED_ROLES])
    df = lookup_many(df, named, [(T.remove_vacancy_marker(r), r, f"id_{r}") for r in VALUE_ADDED_ROLES], "rol", "nombre", "id", "orden").drop(*VALUE_ADDED_ROLES)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numbers})
    df = df.withColumns({c: F.date_format(F.col(c).try_cast("date"), "yyyy-MM-dd") for c in dates})
    return stamp(df, run, source)


# ---- G17: dashboard export -----------------------------------------------------
def dashboard_csv(spark: SparkSession, path: str, schema, types: dict[str, str], history: DataFrame,
                  run: Run, source: str = "DASHBOARD") -> tuple[DataFrame, DataFrame]:
    """Good rows of days not yet loaded, plus the rejected lines."""
    good, bad = readers.read_csv_with_rejects(spark, path, schema, sep=";", header=True)
    good = N.coerce_by_type_map(good, types)
    good = good.withColumn("__fecha", F.to_date("fecha", "yyyy-MM-dd"))
    good = new_rows_by_day(good, history, "__fecha", "fecha_dia").drop("__fecha")
    return stamp(good, run, source), bad
