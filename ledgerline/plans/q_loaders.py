"""Single-source loader jobs (G4-G8, G16) on re-labelled driver tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ledgerline.jobs import loaders as L
from ledgerline.operators.lifecycle import Run
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query

RUN = Run(job="loaders", run_id="RUN-LOAD-0001", started=_dt.datetime(2024, 6, 1))
STAMP_SQL = "'RUN-LOAD-0001' AS id_ejecucion"
TS_SQL = "TIMESTAMP '2024-06-01 00:00:00' AS fecha_procesamiento"


def _deep(x: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(upper(replace({x}, 'ß', 'SS')), '^\\s+|\\s+$', '', 'g'), "
            f"'[\\n\\r\\t]', '', 'g'), '  ', '', 'g')")


def _su(x: str) -> str:
    return f"upper(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


CLOUD_BASE_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS llave,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'Negocios Pyme' WHEN o_orderpriority LIKE '2%' THEN 'NEGOCIOS'
       ELSE 'Hogar' END AS segmento_de_alta,
  CASE WHEN o_orderstatus = 'P' THEN 'Pendiente' ELSE 'activo parallels' END AS estado_inicial,
  CASE WHEN o_orderstatus = 'O' THEN 'ACTIVO' ELSE 'Activo final' END AS estado_final,
  CASE WHEN o_totalprice > 300000 THEN 'x' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR)
       ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS valor_unitario_sin_iva,
  CASE WHEN o_custkey % 10 = 0 THEN '0' WHEN o_custkey % 11 = 0 THEN 'n/d' ELSE CAST(o_custkey AS VARCHAR) END AS cedula_comercial,
  CASE o_custkey % 3 WHEN 0 THEN ' si ' WHEN 1 THEN 'NO' ELSE 'tal vez' END AS reto_estrategico,
  '  consultor  ' || CAST(o_custkey AS VARCHAR) || chr(9) AS nombres,
  o_orderdate
FROM orders"""


@query("job_cloud_sales", "G4 J2 F5 X2 X16 X24 N2 C1", sql=f"""
WITH b AS ({CLOUD_BASE_SQL}),
f AS (SELECT * FROM b WHERE contains(lower(segmento_de_alta), 'negocios')
        AND contains(lower(estado_inicial), 'activo parallels') AND contains(lower(estado_final), 'activo')),
c AS (SELECT llave, {_deep('segmento_de_alta')} AS segmento_de_alta, {_deep('estado_inicial')} AS estado_inicial,
        {_deep('estado_final')} AS estado_final,
        CAST(CASE WHEN regexp_full_match(valor_unitario_sin_iva, '[0-9]+') THEN coalesce(TRY_CAST(valor_unitario_sin_iva AS BIGINT), 0) ELSE 0 END AS BIGINT) AS valor_unitario_sin_iva,
        CAST(CASE WHEN cedula_comercial = '0' THEN 11 WHEN regexp_full_match(cedula_comercial, '[0-9]+')
                  THEN coalesce(TRY_CAST(cedula_comercial AS BIGINT), 0) ELSE 0 END AS BIGINT) AS cedula_comercial,
        {_deep('reto_estrategico')} AS reto, {_deep('nombres')} AS nombres, o_orderdate
      FROM f)
SELECT {STAMP_SQL}, llave, segmento_de_alta, estado_inicial, estado_final, valor_unitario_sin_iva,
       cedula_comercial,
       CASE WHEN reto IN ('SI', 'NO') THEN reto ELSE 'NO' END AS reto_estrategico, nombres, o_orderdate,
       'CLOUD' AS tipo_red, {TS_SQL}, 'CLOUD CORREOS' AS fuente, '1' AS id_estado
FROM c WHERE llave NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
""")
def job_cloud_sales(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k = F.col("o_custkey")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("LLAVE"),
        F.when(F.col("o_orderpriority").like("1%"), "Negocios Pyme").when(F.col("o_orderpriority").like("2%"), "NEGOCIOS")
         .otherwise("Hogar").alias("SEGMENTO DE ALTA"),
        F.when(F.col("o_orderstatus") == "P", "Pendiente").otherwise("activo parallels").alias("ESTADO INICIAL"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVO").otherwise("Activo final").alias("ESTADO FINAL"),
        F.when(F.col("o_totalprice") > 300000, F.concat(F.lit("x"), F.col("o_totalprice").cast("bigint").cast("string")))
         .otherwise(F.col("o_totalprice").cast("bigint").cast("string")).alias("VALOR UNITARIO SIN IVA"),
        F.when(k % 10 == 0, F.lit("0")).when(k % 11 == 0, F.lit("n/d")).otherwise(k.cast("string")).alias("CEDULA COMERCIAL"),
        F.when(k % 3 == 0, " si ").when(k % 3 == 1, "NO").otherwise("tal vez").alias("RETO ESTRATEGICO"),
        F.concat(F.lit("  consultor  "), k.cast("string"), F.lit("\t")).alias("NOMBRES"),
        F.col("o_orderdate").alias("O_ORDERDATE"))
    hist = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")) \
            .select(F.col("o_orderkey").cast("string").alias("llave"))
    return L.cloud_sales(raw, hist, RUN).drop("id")


@query("job_code_master", "G5 J1 X1 X17 X20 X26 N2", sql=f"""
WITH b AS (
  SELECT CAST(p_partkey AS VARCHAR) AS saserv,
         CASE WHEN p_size < 5 THEN ' soporte pc' ELSE lower(p_name) END AS saname,
         nullif(p_type, 'PROMO') AS clasificacion,
         CASE WHEN p_size > 40 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) || '.0' END AS capacidad_navegacion
  FROM part)
SELECT {STAMP_SQL}, saserv, {_su('saname')} AS saname,
       coalesce({_su('clasificacion')}, 'NO REGISTRA') AS clasificacion,
       coalesce(CAST(trunc(TRY_CAST({_su('capacidad_navegacion')} AS DOUBLE)) AS BIGINT), 0) AS capacidad_navegacion,
       {_su('saname')} IS DISTINCT FROM 'SOPORTE PC' AS soporte_pc,
       {TS_SQL}, 'MAESTRO CODIGOS' AS fuente, '1' AS id_estado
FROM b WHERE saserv NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_retailprice < 950)
""")
def job_code_master(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    df = p.select(F.col("p_partkey").cast("string").alias("saserv"),
                  F.when(F.col("p_size") < 5, F.lit(" soporte pc")).otherwise(F.lower("p_name")).alias("saname"),
                  F.nullif(F.col("p_type"), F.lit("PROMO")).alias("clasificacion"),
                  F.when(F.col("p_size") > 40, F.lit("n/a"))
                   .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("capacidad_navegacion"))
    hist = p.filter(F.col("p_retailprice") < 950).select(F.col("p_partkey").cast("string").alias("saserv"))
    return L.code_master(df, hist, RUN, "MAESTRO CODIGOS").drop("id")


@query("job_reference_list", "G6 J2 A2 X34 N3 C1", sql=f"""
WITH b AS (SELECT o_orderpriority AS razon_inicial, o_orderstatus AS tipo, CAST(o_custkey AS VARCHAR) AS td,
                  o_orderkey AS pos, CAST(datediff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) + 2 AS DOUBLE) AS fecha
           FROM orders),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY razon_inicial, tipo, td ORDER BY pos) AS rn FROM b) WHERE rn = 1),
h AS (SELECT DISTINCT o_orderpriority AS razon_inicial, o_orderstatus AS tipo, CAST(o_custkey AS VARCHAR) AS td
      FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT {STAMP_SQL}, razon_inicial, tipo, td,
       CAST(DATE '1899-12-30' + CAST(floor(fecha) AS INTEGER) AS DATE) AS fecha,
       {TS_SQL}, 'CAUSALES' AS fuente, '1' AS id_estado
FROM k WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.razon_inicial = k.razon_inicial AND h.tipo = k.tipo AND h.td = k.td)
""")
def job_reference_list(spark, sf_dir):
    from ledgerline.functions.dates import date_to_excel_serial
    o = Tables(spark, sf_dir).orders
    df = o.select(F.col("o_orderpriority").alias("Razon Inicial"), F.col("o_orderstatus").alias("TIPO"),
                  F.col("o_custkey").cast("string").alias(" Td "), F.col("o_orderkey").alias("_ingest_pos"),
                  date_to_excel_serial("o_orderdate").cast("double").alias("Fecha"))
    hist = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderpriority").alias("razon_inicial"), F.col("o_orderstatus").alias("tipo"),
        F.col("o_custkey").cast("string").alias("td"))
    return L.reference_list(df, hist, RUN, "CAUSALES", ["razon_inicial", "tipo", "td"], ("fecha",)).drop("id")


LEG_SQL = """
la AS (SELECT 'C' || CAST(l_orderkey AS VARCHAR) AS cuenta, l_orderkey * 10 + l_linenumber AS ot,
              CAST(DATE '1899-12-30' + CAST(floor(datediff('day', DATE '1900-01-01', CAST(l_shipdate AS DATE)) + 2 + 0.5) AS INTEGER) AS DATE) AS fecha,
              l_partkey AS pos FROM lineitem WHERE l_returnflag = 'A'),
lb AS (SELECT CAST(l_suppkey AS VARCHAR) AS cuenta, l_orderkey * 10 + l_linenumber AS ot,
              CAST(l_shipdate AS DATE) AS fecha, l_partkey AS pos FROM lineitem WHERE l_returnflag = 'R'),
lc AS (SELECT 'X' || CAST(l_orderkey AS VARCHAR) AS cuenta,
              CASE WHEN l_quantity < 3 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS ot,
              CAST(TRY_STRPTIME(CASE WHEN l_quantity > 48 THEN 'bad' ELSE strftime(l_shipdate, '%d/%m/%Y') END, '%d/%m/%Y') AS DATE) AS fecha,
              l_partkey AS pos FROM lineitem WHERE l_returnflag = 'N'),
h AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS ot FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'),
ka AS (SELECT 1 AS layout, * FROM (SELECT *, row_number() OVER (PARTITION BY ot ORDER BY pos, cuenta, fecha) AS rn FROM la WHERE ot IS NOT NULL) WHERE rn = 1),
kb AS (SELECT 2 AS layout, * FROM (SELECT *, row_number() OVER (PARTITION BY ot ORDER BY pos, cuenta, fecha) AS rn FROM lb WHERE ot IS NOT NULL) WHERE rn = 1),
kc AS (SELECT 3 AS layout, * FROM (SELECT *, row_number() OVER (PARTITION BY ot ORDER BY pos, cuenta, fecha) AS rn FROM lc WHERE ot IS NOT NULL) WHERE rn = 1),
u AS (SELECT * FROM ka UNION ALL SELECT * FROM kb UNION ALL SELECT * FROM kc)"""


@query("job_legalised", "G7 X34 X35 X9 F4 A2 N2 U1", sql=f"""
WITH {LEG_SQL}
SELECT {STAMP_SQL}, cuenta, ot, fecha, layout, {TS_SQL}, 'LEGALIZADAS' AS fuente, '1' AS id_estado
FROM u WHERE ot NOT IN (SELECT ot FROM h)
""")
def job_legalised(spark, sf_dir):
    from ledgerline.functions.dates import date_to_excel_serial
    li = Tables(spark, sf_dir).lineitem
    ot = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    a = li.filter(F.col("l_returnflag") == "A").select(
        F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("Cuenta"), ot.alias("OT"),
        (date_to_excel_serial("l_shipdate").cast("double") + F.lit(0.5)).alias("Fecha Ultimo Estado"),
        F.col("l_partkey").alias("_ingest_pos"))
    b = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").cast("string").alias("ID"), ot.alias("OT"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("FECHA DE LEGALIZACION"), F.col("l_partkey").alias("_ingest_pos"))
    c = li.filter(F.col("l_returnflag") == "N").select(
        F.concat(F.lit("X"), F.col("l_orderkey").cast("string")).alias("Cuenta"),
        F.when(F.col("l_quantity") < 3, F.lit(None)).otherwise(ot).alias("O.T."),
        F.when(F.col("l_quantity") > 48, F.lit("bad"))
         .otherwise(F.concat(F.date_format("l_shipdate", "dd/MM/yyyy"), F.lit(" 10:30"))).alias("Fecha último estado"),
        F.col("l_partkey").alias("_ingest_pos"))
    hist = li.filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(ot.alias("ot"))
    return L.legalised(a, b, c, hist, RUN).drop("id")


@query("job_virtual_db_orders", "G8 F3 J1 X5 X4 F10 X49 N1", sql=f"""
WITH b AS (
  SELECT o_orderkey AS ot, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS aumento,
         'user' || CAST(o_custkey AS VARCHAR) || '@mail.co' || CASE WHEN o_custkey % 4 = 0 THEN '..' ELSE '' END AS email,
         '3.1.' || CAST(o_custkey AS VARCHAR) AS telefono,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'ver ** nota' ELSE 'ok' END AS observacion,
         lower(o_orderstatus) AS estado
  FROM orders)
SELECT {STAMP_SQL}, ot, aumento, regexp_replace(lower(email), '\\.+$', '') AS email,
       regexp_replace(telefono, '\\.+', '', 'g') AS telefono, observacion, upper(estado) AS estado,
       {TS_SQL}, 'RR INSTALADAS' AS fuente, '1' AS id_estado
FROM b WHERE aumento <> 0 AND NOT coalesce(regexp_matches(observacion, '\\*\\*'), false)
  AND ot NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
""")
def job_virtual_db_orders(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    df = o.select(
        F.col("o_orderkey").alias("OT"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("aumento"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@mail.co"),
                 F.when(F.col("o_custkey") % 4 == 0, F.lit("..")).otherwise(F.lit(""))).alias("EMAIL"),
        F.concat(F.lit("3.1."), F.col("o_custkey").cast("string")).alias("telefono"),
        F.when(F.col("o_orderpriority").like("1%"), F.lit("ver ** nota")).otherwise(F.lit("ok")).alias("observacion"),
        F.lower("o_orderstatus").alias("estado"))
    hist = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(F.col("o_orderkey").alias("ot"))
    return L.virtual_db_orders(df, hist, RUN, "RR INSTALADAS", {"OT": "ot", "EMAIL": "email"}, ["ot"]).drop("id")


# The five roles' names as the sheet has them: the supplier o_custkey mod its
# number (some unknown), in any case, blank or with a vacancy marker.
ROLE_MODULI = {"coordinador": 130, "especialista": 90, "jefe": 60, "director": 40, "gerente": 20}


def _role_sql(role: str) -> str:
    name = f"'supplier#' || printf('%09d', o_custkey % {ROLE_MODULI[role]})"
    return f"CASE WHEN o_custkey % 7 = 0 THEN {name} || ' (VACANTE)' WHEN o_custkey % 7 = 1 THEN NULL ELSE ' ' || {name} END AS {role}"


def _role_id_sql(role: str) -> str:
    name = f"regexp_replace(regexp_replace({_deep(role)}, '\\(VACANT[EA]\\)', '', 'g'), '^\\s+|\\s+$', '', 'g')"
    return f"(SELECT max(s_suppkey) FROM supplier WHERE upper(s_name) = {name} AND s_nationkey % 5 <> {len(role) % 5}) AS id_{role}"


@query("job_value_added", "G16 X2 J1 X13 N13 X38 X47 C1", sql=f"""
WITH b AS (
  SELECT o_orderkey, o_orderpriority || '  x' AS producto, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE ' ' || o_orderstatus END AS observaciones,
         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END AS cfm_act, CAST(o_orderdate AS DATE) AS fecha,
         {", ".join(_role_sql(r) for r in ROLE_MODULI)}
  FROM orders)
SELECT {STAMP_SQL}, o_orderkey, {_deep('producto')} AS producto, coalesce({_deep('observaciones')}, '') AS observaciones,
       coalesce(cfm_act, 0) AS cfm_act, strftime(fecha, '%Y-%m-%d') AS fecha_activacion,
       {", ".join(_role_id_sql(r) for r in ROLE_MODULI)},
       {TS_SQL}, 'VALOR AGREGADO' AS fuente, '1' AS id_estado
FROM b
""")
def job_value_added(spark, sf_dir):
    return value_added_rows(Tables(spark, sf_dir)).drop("id")


def value_added_rows(t):
    k = F.col("o_custkey")

    def name(m):
        text = F.concat(F.lit("supplier#"), F.format_string("%09d", k % m))
        return F.when(k % 7 == 0, F.concat(text, F.lit(" (VACANTE)"))).when(k % 7 != 1, F.concat(F.lit(" "), text))

    df = t.orders.select(
        "o_orderkey", F.concat("o_orderpriority", F.lit("  x")).alias("producto"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), "o_orderstatus")).alias("observaciones"),
        F.when(k % 3 != 0, F.col("o_totalprice")).alias("cfm_act"), F.col("o_orderdate").cast("date").alias("fecha_activacion"),
        *[name(m).alias(role) for role, m in ROLE_MODULI.items()])
    people = {role: t.supplier.filter(F.col("s_nationkey") % 5 != len(role) % 5)
              .select(F.upper("s_name").alias("nombre"), F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("orden"))
              for role in ROLE_MODULI}
    return L.value_added(df, people, RUN, ["cfm_act"], ["fecha_activacion"])


@query("job_cloud_sales_manual", "G4 J2 J4 X34 N3 C1", sql=f"""
WITH b AS (
  SELECT o_orderkey % 500 AS id, o_custkey AS nit, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS fecha, o_orderpriority AS producto,
         CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey * 3 AS VARCHAR) END AS customer_id, o_totalprice, o_orderstatus FROM orders),
h AS (SELECT DISTINCT nit, CAST(fecha AS DATE) AS dia, customer_id, producto FROM b WHERE fecha < TIMESTAMP '1998-01-01' OR (fecha IS NULL AND nit % 2 = 0))
SELECT {STAMP_SQL}, fecha AS fecha_de_venta, strftime(fecha, '%m') AS mes, strftime(fecha, '%Y') AS "año", 'RS ' || CAST(nit AS VARCHAR) AS razon_social,
       nit, customer_id, id AS idsuscription, producto, 1 AS no_servicios, o_totalprice AS valor_total_iva_incluido,
       'n' AS nombres, 'g' AS gerencia, 'j' AS jefatura, 'c' AS "cordinación", o_orderstatus AS segmento_de_alta, 'op' AS operacion,
       {TS_SQL}, 'VENTAS MANUALES CLOUD' AS fuente, '1' AS id_estado
FROM b WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.nit = b.nit AND h.dia IS NOT DISTINCT FROM CAST(b.fecha AS DATE)
  AND h.customer_id IS NOT DISTINCT FROM b.customer_id AND h.producto = b.producto)
""")
def job_cloud_sales_manual(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    sold = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    sheet = o.select(
        sold.alias("Fecha de Venta"), F.date_format(sold, "MM").alias("MES"), F.date_format(sold, "yyyy").alias("AÑO"),
        F.concat(F.lit("RS "), F.col("o_custkey").cast("string")).alias("RAZON SOCIAL"), F.col("o_custkey").alias("NIT"),
        F.when(F.col("o_custkey") % 9 != 0, (F.col("o_custkey") * 3).cast("string")).alias("Customer ID"),
        (F.col("o_orderkey") % 500).alias("IdSuscription"), F.col("o_orderpriority").alias("Producto"), F.lit(1).alias("No Servicios"),
        F.col("o_totalprice").alias("Valor Total IVA Incluido"), F.lit("n").alias("Nombres"), F.lit("g").alias("Gerencia"),
        F.lit("j").alias("Jefatura"), F.lit("c").alias("Cordinación"), F.col("o_orderstatus").alias("Segmento de Alta"),
        F.lit("op").alias("Operacion"), F.lit("not asked for").alias("Extra"))
    loaded = sheet.filter((F.col("Fecha de Venta") < F.lit("1998-01-01").cast("timestamp_ntz")) | (F.col("Fecha de Venta").isNull() & (F.col("NIT") % 2 == 0)))
    hist = loaded.select(F.col("Fecha de Venta").alias("fecha_de_venta"), F.col("NIT").alias("nit"),
                         F.col("Customer ID").alias("customer_id"), F.col("Producto").alias("producto"))
    return L.cloud_sales_manual(sheet, hist, RUN).drop("id")


# One value expression a column, in order: text in mixed case with white space
# around it, numbers, dates and nulls.
def _long_distance_values() -> dict[str, str]:
    kinds = ["CAST(o_orderdate AS DATE)", "CAST(month(o_orderdate) AS STRING)", "CAST(year(o_orderdate) AS INT)", "' cc '", "o_custkey",
             "concat('  Razón ', o_orderpriority)", "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE lower(o_orderstatus) END", "o_totalprice"]
    return {header: kinds[i % len(kinds)] for i, header in enumerate(L.LONG_DISTANCE_COLUMNS)}


def _long_distance_sql() -> str:
    cols = [(f"upper(regexp_replace({e}, '^\\s+|\\s+$', '', 'g'))" if e.startswith(("' ", "concat", "CASE", "CAST(month")) else e) + f" AS {c}"
            for e, c in zip(_long_distance_values().values(), L.LONG_DISTANCE_COLUMNS.values())]
    return f"SELECT {STAMP_SQL}, {', '.join(cols)}, {TS_SQL}, 'NGN LARGA DISTANCIA NACIONAL CORREOS' AS fuente, '1' AS id_estado FROM orders"


@query("job_long_distance", "G5 J4 J1 X1 C1", sql=_long_distance_sql())
def job_long_distance(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    sheet = o.select(*[F.expr(e).alias(h) for h, e in _long_distance_values().items()], F.lit(1).alias("DÍA DIGITACIÓN"))
    return L.long_distance(sheet, RUN).drop("id")


@query("job_network_nodes", "G5 X7 X17 X21 N2", sql=f"""
WITH b AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id_nodo,
         CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE upper(n.n_name) END AS departamento,
         'COD-' || printf('%09d', s_suppkey) AS codigo,
         s_name || ' ' || n.n_name || ' ' || s_name || ' ' || n.n_name AS nombre_nodo,
         CASE WHEN s_acctbal < 0 THEN 'n/a' ELSE CAST(s_acctbal AS VARCHAR) END AS largo,
         CASE WHEN s_acctbal > 8000 THEN NULL ELSE s_nationkey END AS hogares
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey)
SELECT {STAMP_SQL}, id_nodo, coalesce(substring(departamento, 1, 2), '0') AS departamento,
       substring(codigo, 1, 10) AS codigo, substring(nombre_nodo, 1, 50) AS nombre_nodo,
       coalesce(CAST(trunc(TRY_CAST(largo AS DOUBLE)) AS BIGINT), 0) AS largo, coalesce(hogares, 0) AS hogares,
       {TS_SQL}, 'RED FTTX' AS fuente, '1' AS id_estado
FROM b WHERE id_nodo NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 9000)
""")
def job_network_nodes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    df = s.select(
        F.col("s_suppkey").cast("string").alias("id_nodo"),
        F.when(F.col("s_nationkey") % 4 == 0, F.lit(None)).otherwise(F.upper("n_name")).alias("departamento"),
        F.concat(F.lit("COD-"), F.format_string("%09d", "s_suppkey")).alias("codigo"),
        F.concat_ws(" ", "s_name", "n_name", "s_name", "n_name").alias("nombre_nodo"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(F.col("s_acctbal").cast("string")).alias("largo"),
        F.when(F.col("s_acctbal") > 8000, F.lit(None)).otherwise(F.col("s_nationkey")).alias("hogares"))
    hist = t.supplier.filter(F.col("s_acctbal") > 9000).select(F.col("s_suppkey").cast("string").alias("id_nodo"))
    return L.network_nodes(df, hist, RUN, "RED FTTX").drop("id")
