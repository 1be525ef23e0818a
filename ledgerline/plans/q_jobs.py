"""End-to-end job queries (G1, G10-G13, G15, G18) on re-labelled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.jobs import order_loader as g1
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query


def _strip_upper_sql(x: str) -> str:
    return f"upper(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


@query("job_order_loader", "G1 S18 J1 X20 F1 N1 X39 X1 C1 X44 J10", sql=f"""
WITH landed AS (
  SELECT l_orderkey AS cuenta, l_linenumber AS ot, l_returnflag AS codigo_servicio, l_shipdate AS fecha_creacion,
         coalesce(CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END, 0) AS valor_servicio,
         coalesce(chr(9) || lower(l_linestatus) || '  ' || chr(10), 'NO REGISTRA') AS estado,
         coalesce(CASE WHEN l_quantity > 40 THEN NULL ELSE ' cliente ' || CAST(l_suppkey AS VARCHAR) END,
                  'NO REGISTRA') AS nombres,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_shipdate END AS hora_creacion,
         CASE WHEN l_quantity < 10 THEN '31/02/2001' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fecha_permanencia
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'),
hist AS (SELECT l_orderkey AS cuenta, l_linenumber AS ot, l_returnflag AS codigo_servicio
         FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-06-01'),
fresh AS (SELECT * FROM landed b WHERE valor_servicio > 0 AND NOT EXISTS (
  SELECT 1 FROM hist h WHERE h.cuenta IS NOT DISTINCT FROM b.cuenta AND h.ot IS NOT DISTINCT FROM b.ot
    AND h.codigo_servicio IS NOT DISTINCT FROM b.codigo_servicio))
SELECT 'RUN-ORDERS-0001' AS id_ejecucion,
       cuenta, ot, {_strip_upper_sql('codigo_servicio')} AS codigo_servicio, fecha_creacion, valor_servicio,
       {_strip_upper_sql('estado')} AS estado, {_strip_upper_sql('nombres')} AS nombres,
       coalesce(hora_creacion, TIMESTAMP '1899-12-30 00:00:00') AS hora_creacion,
       coalesce(TRY_CAST(fecha_permanencia AS TIMESTAMP), TIMESTAMP '1900-01-01 00:00:00') AS fecha_permanencia,
       TIMESTAMP '2024-01-01 00:00:00' AS fecha_procesamiento, 'CANCELADAS CORREOS' AS fuente, '1' AS id_estado
FROM fresh
""")
def job_order_loader(spark, sf_dir):
    return order_loader_rows(Tables(spark, sf_dir)).drop("id")


def order_loader_rows(t):
    batch = g1.demo_landed(t.lineitem.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    return g1.transform(batch, g1.demo_history(t.lineitem), g1.DEMO_CONFIG, g1.DEMO_RUN)


WL_PACKAGES_SQL = """
pk AS (SELECT o_orderkey, o_custkey AS nit, o_custkey AS co_id, o_orderpriority AS tel_num,
         CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE CAST(o_custkey % 7 AS DOUBLE) END AS cod_paq_instalado,
         o_orderpriority AS desc_serv_instalado,
         CAST(floor(o_totalprice / 100000) * 100 + 100 AS DOUBLE) AS valor_paq,
         o_orderdate AS fecha_act_paq,
         CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) END AS fecha_desact_paq,
         strftime(o_orderdate, '%Y-%m') AS anio_mes_act_paq
       FROM orders),
comp AS (SELECT DISTINCT c_custkey AS nit FROM customer WHERE c_mktsegment = 'BUILDING'),
churn_all AS (SELECT * FROM pk WHERE fecha_desact_paq IS NOT NULL AND strftime(fecha_desact_paq, '%Y-%m') = '1998-03'
                AND anio_mes_act_paq IS DISTINCT FROM '1998-03'),
adds_all AS (SELECT * FROM pk WHERE fecha_desact_paq IS NULL AND anio_mes_act_paq = '1998-03'),
sides AS (
  SELECT 'BAJAS' AS tipo, *, CAST(datediff('day', DATE '1900-01-01', CAST(fecha_desact_paq AS DATE)) + 2 AS BIGINT) AS fecha_excel
  FROM churn_all WHERE valor_paq > 150 AND coalesce(desc_serv_instalado NOT IN ('1-URGENT'), true)
  UNION ALL
  SELECT 'ALTAS', *, CAST(datediff('day', DATE '1900-01-01', CAST(fecha_act_paq AS DATE)) + 2 AS BIGINT)
  FROM adds_all WHERE valor_paq > 150 AND coalesce(desc_serv_instalado NOT IN ('1-URGENT'), true)),
ranked AS (SELECT *, count(*) OVER (PARTITION BY tipo, co_id, fecha_excel, valor_paq, desc_serv_instalado) > 1
                       AS duplicado_por_servicio,
                  row_number() OVER (PARTITION BY tipo, co_id, fecha_excel, valor_paq, desc_serv_instalado
                                     ORDER BY co_id, tel_num, cod_paq_instalado NULLS LAST, o_orderkey, nit,
                                              desc_serv_instalado, fecha_act_paq, fecha_desact_paq, anio_mes_act_paq) AS rn
           FROM sides),
keys_other AS (
  SELECT 'BAJAS' AS tipo, nit, tel_num, coalesce(CAST(CAST(trunc(cod_paq_instalado) AS BIGINT) AS VARCHAR), '') AS paq, valor_paq
  FROM adds_all WHERE valor_paq > 0
  UNION ALL
  SELECT 'ALTAS', nit, tel_num, coalesce(CAST(CAST(trunc(cod_paq_instalado) AS BIGINT) AS VARCHAR), ''), valor_paq
  FROM churn_all WHERE valor_paq > 0)"""


@query("churn_vs_additions", "G10 S19 F9 F11 W2 W3 N10 U1 X29 X34 X42", sql=f"""
WITH {WL_PACKAGES_SQL}
SELECT r.tipo, r.o_orderkey, r.nit, r.co_id, r.tel_num, r.cod_paq_instalado, r.valor_paq, r.fecha_excel,
       r.duplicado_por_servicio,
       CASE WHEN r.nit IN (SELECT nit FROM comp) THEN 'EMPRESAS' ELSE 'NEGOCIOS' END AS segmento,
       CASE WHEN EXISTS (SELECT 1 FROM keys_other k WHERE k.tipo = r.tipo AND k.nit = r.nit
                          AND k.tel_num = r.tel_num AND k.valor_paq = r.valor_paq
                          AND k.paq = coalesce(CAST(CAST(trunc(r.cod_paq_instalado) AS BIGINT) AS VARCHAR), ''))
            THEN 'Cruza' ELSE 'No cruza' END AS cruce_bajas_altas,
       CASE WHEN r.tipo = 'ALTAS' THEN r.anio_mes_act_paq ELSE strftime(r.fecha_desact_paq, '%Y-%m') END AS periodo
FROM ranked r WHERE rn = 1
""")
def churn_vs_additions(spark, sf_dir):
    from ledgerline.jobs import white_label as g10
    t = Tables(spark, sf_dir)
    companies = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("nit"))
    out = g10.churn_and_additions(g10.demo_packages(t.orders), g10.DEMO_RULES, companies)
    return out.select("tipo", "o_orderkey", "nit", "co_id", "tel_num", "cod_paq_instalado", "valor_paq",
                      "fecha_excel", "duplicado_por_servicio", "segmento", "cruce_bajas_altas", "periodo")


def _transfer_sql(rank: int, name: str) -> str:
    """One source's rows: ranks 0, 1 and 3 are orders, 2 and 4 up-sells, the rest cancelled."""
    null = "CAST(NULL AS {})"
    whole = lambda x: f"CAST(trunc({x}) AS BIGINT)"
    state, kind, label = (("INSTALADA", "ALTAS_F", "ALTAS_F") if rank < 3 else ("DIGITADA", "VENTAS_F", "DIGITADO") if rank < 5
                          else ("CANCELADA", "CANCELADAS_F", "CANCELADAS_F"))
    price, dif, before = whole("l_extendedprice"), whole("l_extendedprice * l_discount"), f"coalesce({whole('l_extendedprice * l_tax')}, 0)"
    if rank in (0, 1, 3):
        origin = ("CASE WHEN l_returnflag = 'R' THEN 'CROSS SELLING' WHEN l_returnflag = 'A' THEN 'NEW' "
                  "WHEN l_linestatus = 'O' THEN 'UP SELLING' END")
        net = f"CASE WHEN l_returnflag IN ('R', 'A') THEN {price} WHEN l_linestatus = 'O' THEN {dif} END"
        cols = [origin, price, dif, whole("l_quantity"), whole("l_quantity + 1"), net]
    elif rank in (2, 4):
        before = f"CASE WHEN l_tax <> 0 THEN {whole('l_extendedprice * l_tax')} ELSE 0 END"
        cols = [null.format("VARCHAR"), null.format("BIGINT"), null.format("BIGINT"), before, price, f"{price} - {before}"]
    else:
        cols = [null.format("VARCHAR"), f"CASE WHEN l_quantity > 5 THEN {price} ELSE 0 END", "0", "0", "0", "0"]
    names = ["origen_datos", "valor_servicio", "val_dif_service", "renta_wo_anterior", "renta_wo_actual", "valor_neto"]
    body = ", ".join(f"{c} AS {n}" for c, n in zip(cols, names))
    return (f"SELECT {rank} AS r, CAST(l_suppkey AS VARCHAR) AS cuenta, CAST(l_orderkey AS VARCHAR) AS orden_trabajo, CAST(l_partkey AS VARCHAR) AS codigo_servicio, "
            f"{body}, '{state}' AS estado_2, '{kind}' AS tipo_v, '{label}' AS tipo, 'FIJO' AS base, '{name}' AS fuente "
            f"FROM lineitem WHERE l_linenumber = {rank + 1} AND l_shipdate > (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01')")


TRANSFER_NAMES = ["INSTALADAS", "INSTALADAS 999", "INSTALADAS UP", "DIGITADAS", "DIGITADAS UP", "CANCELADAS", "CANCELADAS 999"]


@query("multi_source_consolidation", "G11 C9 F17 X27 X31 X3 J8 U1 X41 C1 A2", sql="""
WITH mapped AS (""" + "\nUNION ALL\n".join(_transfer_sql(i, n) for i, n in enumerate(TRANSFER_NAMES)) + """),
ranked AS (SELECT *, orden_trabajo || codigo_servicio || tipo_v AS llave_proceso,
                  row_number() OVER (PARTITION BY orden_trabajo || codigo_servicio || tipo_v ORDER BY r, orden_trabajo, codigo_servicio, cuenta,
                    origen_datos, valor_servicio, val_dif_service, renta_wo_anterior, renta_wo_actual, valor_neto) AS rn FROM mapped)
SELECT 'RUN-TRANSFERS-0001' AS id_ejecucion, * EXCLUDE (r, rn),
       TIMESTAMP '2024-01-02 00:00:00' AS fecha_procesamiento, '1' AS id_estado
FROM ranked WHERE rn = 1
""")
def multi_source_consolidation(spark, sf_dir):
    from ledgerline.jobs import transfers as g11
    li = Tables(spark, sf_dir).lineitem
    return g11.consolidate(g11.demo_sources(li), g11.demo_target(li), g11.TRANSFERS_SCHEMA, g11.DEMO_RUN).drop("id")


def _fiber_select() -> str:
    """Every column of the target layout: those the demo has, null for the rest."""
    from ledgerline.jobs.fiber import LAYOUT
    have = {
        "id_ejecucion": "'RUN-FIBER-0001'", "id": "b.id", "id_orden_trabajo_padre": "b.id_orden_trabajo_padre",
        "id_estado_orden_trabajo": "CAST(coalesce(ost.id, 13) AS INTEGER)", "id_estado_venta": "CAST(coalesce(vst.id, 6) AS INTEGER)",
        "fecha_creacion": "b.fecha_creacion", "producto": "b.producto", "monto_moneda_local_arriendo": "b.valor", "id_tipo": "b.id_tipo",
        "tipo_orden_trabajo": "b.id_tipo", "resolucion1": "upper(b.producto)", "razon_social": "b.razon",
        "monto_moneda_local_activacion": "coalesce(b.activacion, 0)",
        "variacion_total": "coalesce(CAST(trunc(TRY_CAST(b.variacion AS DOUBLE)) AS BIGINT), 0)",
        "cod_proyecto": "CASE WHEN upper(b.cod) IN ('0', '.', 'NA', 'N/A', 'NO', 'n/a', '00', 'N', '..', 'N.A', '0.') THEN NULL ELSE upper(b.cod) END",
        **{c: f"x.{c}" for c in ("proyecto", "direccion_comercial", "familia_1", "clase_producto", "servicio_componente", "tipo_contrato")},
        "id_estado": "1", "fecha_inicio_procesamiento": "TIMESTAMP '2024-01-03 00:00:00'"}
    zero = {"monto_moneda_local_cargo_mensual", "monto_moneda_local_otros", "variacion_monto_moneda_local_mensual",
            "variacion_monto_moneda_local_arriendo", "variacion_cargo_arriendo", "variacion_total_moneda_local"}
    return ",\n       ".join(f"{have.get(c, 'CAST(0 AS BIGINT)' if c in zero else 'CAST(NULL AS VARCHAR)')} AS {c}" for c in LAYOUT if c != "id_macrofo")


@query("job_fiber", "G12 J9 A9 N22 F21 N9 N13 X6 X25 X49 U1 N1 J5 J7", sql="""
WITH eav AS (
  SELECT user_id AS ot, CASE event_type WHEN 'view' THEN 'FLD198' WHEN 'click' THEN 'FLD189'
           WHEN 'purchase' THEN 'FLD169' WHEN 'signup' THEN 'FLD300' WHEN 'error' THEN 'FLD147' END AS campo,
         CASE WHEN value > 90 THEN 'x' || regexp_extract(props, '"k": (\\d+)', 1)
              WHEN value < 1 THEN '123456789012345678901'
              ELSE regexp_extract(props, '"k": (\\d+)', 1) END AS valor_txt,
         ts, event_id FROM events),
caps AS (SELECT * FROM (VALUES ('FLD198', 'Proyecto'), ('FLD189', 'Familia'), ('FLD169', 'Clases Producto'),
                               ('FLD147', 'Tipo de Contrato'), ('FLD300', 'Sin uso')) v(campo, caption)),
res AS (
  SELECT e.ot, c.caption, p.c_mktsegment || ' ' || CAST(p.c_nationkey AS VARCHAR) AS dato, e.ts, e.event_id
  FROM eav e
  JOIN customer p ON CASE WHEN regexp_full_match(e.valor_txt, '[0-9]{1,19}') THEN TRY_CAST(e.valor_txt AS BIGINT) END = p.c_custkey
  JOIN caps c ON c.campo = e.campo
  WHERE e.campo LIKE '%198%' OR e.campo LIKE '%189%' OR e.campo LIKE '%169%' OR e.campo LIKE '%170%'
     OR e.campo LIKE '%171%' OR e.campo LIKE '%147%'),
ext AS (
  SELECT ot,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Proyecto')) AS proyecto,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Dirección Comercial')) AS direccion_comercial,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Familia')) AS familia_1,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Clases Producto')) AS clase_producto,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Servicio/Componente')) AS servicio_componente,
    upper(arg_max(dato, (ts, event_id)) FILTER (WHERE caption = 'Tipo de Contrato')) AS tipo_contrato
  FROM res GROUP BY ot),
base AS (
  SELECT o_orderkey AS id, o_custkey AS id_orden_trabajo_padre, o_orderdate AS fecha_creacion,
         o_orderpriority AS producto, o_totalprice AS valor, upper(lower(o_orderstatus)) AS estado_orden_trabajo,
         upper(o_orderpriority) AS estado_venta, regexp_replace('$$' || o_orderstatus, '^\\$+', '') AS id_tipo,
         CASE WHEN o_totalprice < 50000 THEN 'n/a' ELSE 'p' || CAST(o_orderkey AS VARCHAR) END AS cod,
         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END AS activacion,
         CASE WHEN o_custkey % 5 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) || '.7' END AS variacion, 'rs ' || CAST(o_custkey AS VARCHAR) AS razon
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice, upper(o_orderstatus),
         upper(lower(o_orderpriority)), regexp_replace('$' || o_orderstatus, '^\\$+', ''),
         CASE WHEN o_totalprice < 100000 THEN '0' ELSE 'PX' END, NULL, NULL, NULL
  FROM orders WHERE o_orderstatus <> 'F'),
ost AS (SELECT upper(estado) AS st, max(id) AS id FROM (VALUES (1, 'f'), (2, 'O'), (3, 'o')) v(id, estado) GROUP BY 1),
vst AS (SELECT upper(estado) AS st, max(id) AS id FROM (VALUES (1, '1-urgent'), (2, '2-HIGH'), (3, '3-MEDIUM')) v(id, estado) GROUP BY 1),
hist AS (SELECT o_orderkey AS id, o_custkey AS ot, o_orderpriority AS producto FROM orders
         WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT """ + _fiber_select() + """
FROM base b
LEFT JOIN ext x ON x.ot = b.id_orden_trabajo_padre
LEFT JOIN ost ON ost.st = b.estado_orden_trabajo
LEFT JOIN vst ON vst.st = b.estado_venta
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.id = b.id AND h.ot = b.id_orden_trabajo_padre
                  AND h.producto = b.producto)
""")
def job_fiber(spark, sf_dir):
    from ledgerline.jobs import fiber as g12
    return g12.consolidate(g12.demo_inputs(spark, Tables(spark, sf_dir)), g12.DEMO_RUN).drop("id_macrofo")


_SEG = ["ot", "fecha", "producto", "valor", "ciudad", "nit", "razon_social", "documento_consultor", "nombre_consultor", "cargo_actual"]
_SEG_TYPES = {"ot": "BIGINT", "valor": "DOUBLE", "nit": "BIGINT", "documento_consultor": "BIGINT"}


def _seg_source(name: str, cols: dict[str, str], rest: str, pos: str | None = None) -> str:
    """A CTE with all data columns and the row's place."""
    data = ", ".join(f"CAST({cols.get(c, 'NULL')} AS {_SEG_TYPES.get(c, 'VARCHAR')}) AS {c}" for c in _SEG)
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _SEG) + ")"
    if pos:
        return f"{name} AS (SELECT {data}, printf('%020d', {pos}) AS pos {rest})"
    return f"{name} AS (SELECT *, {text} AS pos FROM (SELECT DISTINCT {data} {rest}))"


def _seg_stage(name: str, *sources: str) -> str:
    """CTEs that coalesce sources per work order: repeats go, values are
    carried forward, then backward."""
    union = " UNION ALL ".join(f"SELECT {k} AS s, * FROM {x}" for k, x in enumerate(sources))
    fill = ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER f, first_value({c} IGNORE NULLS) OVER b) AS {c}" for c in _SEG[1:])
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _SEG) + ")"
    return f"""{name}_u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {", ".join(_SEG)} ORDER BY s, pos) AS rn FROM ({union})) WHERE rn = 1 AND ot IS NOT NULL),
{name} AS (SELECT *, {text} AS pos FROM (SELECT DISTINCT ot, {fill} FROM {name}_u
  WINDOW f AS (PARTITION BY ot ORDER BY s, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY ot ORDER BY s, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


def _segment_sql() -> str:
    sales = {"ot": "o_custkey", "fecha": "strftime(o_orderdate, '%Y-%m-%d')", "valor": "CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_totalprice END",
             "producto": "o_orderpriority", "nit": "CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 50 END",
             "razon_social": "CASE WHEN o_orderkey % 3 <> 0 THEN 'RS ' || CAST(o_custkey % 50 AS VARCHAR) END"}
    own = {c: f"x.{c}" for c in _SEG}
    parts = [
        _seg_source("nuevas", sales, "FROM orders WHERE o_orderstatus = 'F'", "o_orderkey"),
        _seg_source("up", sales, "FROM orders WHERE o_orderstatus = 'P'", "o_orderkey"),
        _seg_source("nube", {"ot": "c_custkey", "fecha": "'2024-02-02'", "producto": "'CLOUD'", "nit": "c_custkey % 50"}, "FROM customer WHERE c_custkey % 6 = 0", "c_custkey"),
        """equipo AS (SELECT DISTINCT documento, nombre, cargo, ciudad FROM (
  SELECT CAST(s_suppkey // 2 AS BIGINT) AS documento, s_name AS nombre, CASE WHEN s_acctbal < 0 THEN 'CONSULTOR IT' ELSE 'CONSULTOR' END AS cargo,
         CASE WHEN s_acctbal > 5000 THEN 'BOGOTA' END AS ciudad FROM supplier)
  WHERE cargo <> 'CONSULTOR IT' OR nombre = 'Supplier#000000003')""",
        _seg_source("hfc", {"ot": "c_custkey", "ciudad": "coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, e.ciudad)",
                            "documento_consultor": "d", "nombre_consultor": "coalesce(e.nombre, CASE WHEN c_custkey % 5 = 0 THEN 'DE ALTA' END)", "cargo_actual": "e.cargo"},
                    "FROM (SELECT *, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 60 END AS d FROM customer) LEFT JOIN equipo e ON e.documento = d"),
        _seg_source("fibra", {"ot": "ot", "ciudad": "ciudad"}, """FROM (SELECT *, row_number() OVER (PARTITION BY ot
      ORDER BY CASE WHEN ciudad LIKE 'SIN CIUDA%' THEN 2 ELSE 1 END, fecha_inicio DESC, place, ciudad) AS rn
    FROM (SELECT o.o_custkey AS ot, l.l_orderkey * 10 + l.l_linenumber AS place, l.l_shipdate AS fecha_inicio,
                 CASE WHEN l.l_returnflag = 'N' THEN 'SIN CIUDAD' ELSE 'CIUDAD ' || l.l_linestatus END AS ciudad
          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderstatus = 'F')) WHERE rn = 1""", "place"),
        _seg_stage("ventas", "nuevas", "up"), _seg_stage("instaladas", "hfc", "fibra"), _seg_stage("con_nube", "instaladas", "nube"),
        _seg_stage("todas", "ventas", "con_nube"),
        """asignacion AS (SELECT n_nationkey AS nit, 'RS ' || CAST(n_nationkey AS VARCHAR) AS razon_social,
  CASE WHEN n_regionkey <> 1 THEN 'FIJO ' ELSE 'MOVIL ' END || n_name AS nombre, n_nationkey + CASE WHEN n_regionkey <> 1 THEN 20 ELSE 30 END AS cedula FROM nation)""",
        _seg_source("asignadas", {**own, "nombre_consultor": "coalesce(x.nombre_consultor, a.nombre)", "documento_consultor": "coalesce(x.documento_consultor, a.cedula)"},
                    "FROM todas x LEFT JOIN asignacion a ON a.nit = x.nit AND a.razon_social = x.razon_social"),
        _seg_stage("final", "asignadas", "nube"),
        _seg_source("unidas", {**own, "ciudad": "coalesce(x.ciudad, e.ciudad)", "nombre_consultor": "coalesce(x.nombre_consultor, e.nombre)", "cargo_actual": "coalesce(x.cargo_actual, e.cargo)"},
                    "FROM final x LEFT JOIN equipo e ON e.documento = x.documento_consultor"),
        """norm AS (SELECT * REPLACE (CASE WHEN coalesce(nombre_consultor, '') = '' THEN 'SIN ASIGNACION' ELSE nombre_consultor END AS nombre_consultor,
  CAST(round_even(coalesce(valor, 0.0) / 1000.0, 2) AS DOUBLE) AS valor) FROM unidas)"""]
    return "WITH " + ",\n".join(parts) + f"""
SELECT 'ALT-MAR24-' || printf('%08d', row_number() OVER (ORDER BY {", ".join(_SEG)})) AS nuv, {", ".join(_SEG)},
       CASE WHEN contains(nombre_consultor, '(VACANTE)') OR documento_consultor IS NULL THEN 'INACTIVO' ELSE 'ACTIVO' END AS estado_consultor,
       CAST(NULL AS VARCHAR) AS ot_reemplazada
FROM norm"""


@query("job_segment_report", "G13 W4 W1 A2 A1 F14 N17 N18 J12 X22 X18 X28 W5 J7", sql=_segment_sql())
def job_segment_report(spark, sf_dir):
    from ledgerline.jobs import segment_report as g13
    return g13.build(g13.demo_inputs(Tables(spark, sf_dir)), g13.DEMO_PARAMS)


TARGET_SHEET_SQL = """
SELECT '{s}' AS hoja_fuente, o_orderkey AS pos,
  CASE WHEN o_totalprice < 20000 THEN NULL WHEN o_totalprice < 40000 THEN 'VACANTE'
       WHEN o_totalprice > 450000 THEN CAST(o_custkey * 10000000 AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) || ' ' END AS cc,
  CASE WHEN o_orderstatus = 'P' THEN 'Vacante comercial' ELSE 'Consultor ' || CAST(o_custkey AS VARCHAR) END AS nombre,
  CASE WHEN o_totalprice > 400000 THEN 'Brumario' ELSE
    ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(o_orderdate)] END AS mes_txt,
  o_orderstatus AS tipo, o_totalprice AS couta_mes
FROM orders WHERE o_orderpriority = '{s}'"""


@query("job_targets", "G15 S2 U1 S17 X32 X33 N24 F19 N18 X19 C1", sql="""
WITH sheets AS (""" + "\nUNION ALL\n".join(TARGET_SHEET_SQL.format(s=s) for s in
                                            ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + """),
org AS (
  SELECT c_custkey AS identificacion, c_nationkey AS id_cargo, 1 AS version FROM customer
  UNION ALL SELECT c_custkey, c_nationkey + 100, 2 FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT c_custkey, 999, 2 FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, 0, 2 FROM customer WHERE c_mktsegment = 'MACHINERY'),
roles AS (SELECT DISTINCT identificacion, id_cargo FROM org
          WHERE version = (SELECT max(version) FROM org) AND identificacion <> 0 AND id_cargo <> 0),
norm AS (
  SELECT *, replace(coalesce(cc, '11'), ' ', '') AS doc0 FROM sheets),
docs AS (
  SELECT *, TRY_CAST(CASE WHEN contains(lower(doc0), 'vacante') OR contains(lower(nombre), 'vacante') THEN '11'
                          ELSE doc0 END AS BIGINT) AS ident FROM norm)
SELECT 'RUN-TARGETS-0001' AS id_ejecucion,
       CASE WHEN d.ident > 2147483647 THEN -2147483648 ELSE d.ident END AS identificacion,
       d.nombre, CAST(coalesce(r.id_cargo, 0) AS INTEGER) AS id_cargo, 2024 AS anio,
       CAST(list_position(['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE',
                           'OCTUBRE','NOVIEMBRE','DICIEMBRE'], upper(mes_txt)) AS INTEGER) AS mes,
       d.hoja_fuente, d.tipo, d.couta_mes, TIMESTAMP '2024-02-01 00:00:00' AS fecha_procesamiento,
       'METAS' AS fuente, 1 AS id_estado_registro, CAST(NULL AS VARCHAR) AS detalle
FROM docs d LEFT JOIN roles r ON r.identificacion = d.ident
""")
def job_targets(spark, sf_dir):
    return targets_rows(Tables(spark, sf_dir)).drop("id")


def targets_rows(t):
    from ledgerline.jobs import targets as g15
    sheets, org = g15.demo_inputs(t)
    return g15.build(sheets, org, g15.DEMO_RUN, "METAS")


def _g18_sql() -> str:
    """The statement, its spelling list filled in from the constants."""
    import os

    from ledgerline.functions.constants import UNASSIGNED_SPELLINGS
    path = os.path.join(os.path.dirname(__file__), "sql", "job_fixed_sales.sql")
    # White space has been removed where the list is compared: spellings that hold any can't occur.
    spellings = ", ".join(f"'{x}'" for x in UNASSIGNED_SPELLINGS if "\n" not in x)
    with open(path, encoding="utf-8") as f:
        return f.read().replace("{spellings}", spellings)


@query("job_fixed_sales", "G18 F15 J6 F8 X22 X23 X12 X32 X20 C1", sql=_g18_sql())
def job_fixed_sales(spark, sf_dir):
    from ledgerline.jobs import fixed_sales as g18
    sales = g18.window(g18.demo_sales(Tables(spark, sf_dir).orders), g18.DEMO_RUN_DATE)
    return g18.curate(sales, g18.DEMO_RUN, "VENTAS FIJO").drop("id")


def _warehouse(t):
    """The driver's tables relabelled as the plan-change fact and its dimensions."""
    li = t.lineitem
    text = lambda c: F.col(c).cast("string")
    fact = li.select(
        F.col("l_orderkey").alias("co_id"), F.col("l_suppkey").alias("customer_id"), F.col("l_suppkey").alias("cod_agente"),
        F.col("l_linenumber").alias("cod_mercado"), (F.col("l_linenumber") % 7).alias("tipo_identificacion"),
        (F.col("l_linenumber") * 5).alias("cod_ciclo"), (F.col("l_suppkey") % 6).alias("sk_segmento_cliente"),
        F.col("l_partkey").alias("cod_plan_origen"), (F.col("l_partkey") + 1).alias("cod_plan_destino"),
        (F.col("l_partkey") % 5).alias("sk_tipo_grade"), (F.col("l_partkey") % 8).alias("sk_rango_antiguedad"),
        (F.col("l_linenumber") - 1).alias("sk_gama_plan_origen"), F.col("l_linenumber").alias("sk_gama_plan_destino"),
        F.col("l_suppkey").alias("sk_usuario_creacion"), (F.col("l_suppkey") + 1).alias("sk_usuario_cierre"),
        F.col("l_shipdate").alias("fe_creacion"), F.col("l_extendedprice").alias("vl_cfm_neto"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("no_ejecutado"))
    region = lambda key, name: t.region.select(F.col("r_regionkey").alias(key), F.col("r_name").alias(name))
    dims = {
        "agentes": t.supplier.select(F.col("s_suppkey").alias("cod_agente"), F.col("s_name").alias("custcode_agente"),
                                     F.col("s_name").alias("region_comercial"), F.lit("G").alias("gerencia"), text("s_nationkey").alias("canal")),
        "regiones": t.nation.select(F.col("n_nationkey").alias("cod_mercado"), F.col("n_name").alias("region_desc")),
        "identificadores": region("tipo_identificacion", "tipo_identificador_desc"),
        "ciclos": t.nation.select(F.col("n_nationkey").alias("cod_ciclo")),
        "segmentos": t.region.select(F.col("r_regionkey").alias("sk_segmento_cliente"), text("r_regionkey").alias("cd_segmento_cliente"),
                                     F.col("r_name").alias("ds_segmento_cliente"), F.lower("r_name").alias("ds_unidad_negocio")),
        "planes": t.part.select(F.col("p_partkey").alias("cod_plan"), F.col("p_name").alias("plan_desc"), F.col("p_retailprice").alias("vlr_cfm"),
                                F.col("p_type").alias("tipo_plan"), F.col("p_brand").alias("producto"),
                                F.when(F.col("p_size") > 25, "S").otherwise("N").alias("ban_pyme")),
        "grados": region("sk_tipo_grade", "ds_tipo_grade"), "antiguedades": region("sk_rango_antiguedad", "ds_rango_antiguedad"),
        "gamas": region("sk_gama_plan", "ds_gama_plan"),
        "usuarios": t.supplier.select(F.col("s_suppkey").alias("sk_usuario_ubicacion"), text("s_suppkey").alias("cd_usuario_red"),
                                      F.col("s_name").alias("ds_nombre_usuario"), text("s_nationkey").alias("ds_ubicacion_usuario"), F.lit("C").alias("ds_canal_usuario")),
        "clientes": t.customer.select(F.col("c_custkey").alias("co_id"), F.col("c_name").alias("identificacion"), F.col("c_mktsegment").alias("identificacion_mtr")),
    }
    return fact, dims


def _at(column: str, table: str, key: str, value: str) -> str:
    return f"(SELECT {column} FROM {table} WHERE {key} = {value})"


@query("job_warehouse_extracts", "G9 N21 N20 X38 X30 N3", sql=f"""
WITH cambios AS (
  SELECT l.*, d.p_name AS d_name, d.p_retailprice AS d_price, d.p_type AS d_type, d.p_partkey AS d_key
  FROM lineitem l JOIN part d ON d.p_partkey = l.l_partkey + 1 AND d.p_size > 25
  WHERE l.l_shipdate >= TIMESTAMP '1998-01-01'),
cargado AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
SELECT l_orderkey AS co_id, l_suppkey AS customer_id, l_suppkey AS cod_agente,
  {_at('n_nationkey', 'nation', 'n_nationkey', 'l_linenumber * 5')} AS cod_ciclo,
  {_at('p_partkey', 'part', 'p_partkey', 'l_partkey')} AS cod_plan_origen, d_key AS cod_plan_destino,
  strftime(l_shipdate, '%d/%m/%Y') AS fe_creacion, l_extendedprice AS vl_cfm_neto,
  {_at('s_name', 'supplier', 's_suppkey', 'l_suppkey')} AS custcode_agente, {_at('s_name', 'supplier', 's_suppkey', 'l_suppkey')} AS region_comercial,
  CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier) THEN 'G' END AS gerencia,
  CAST({_at('s_nationkey', 'supplier', 's_suppkey', 'l_suppkey')} AS VARCHAR) AS canal,
  {_at('n_name', 'nation', 'n_nationkey', 'l_linenumber')} AS region_geografica,
  {_at('r_name', 'region', 'r_regionkey', 'l_linenumber % 7')} AS tipo_identificador_desc,
  CAST({_at('r_regionkey', 'region', 'r_regionkey', 'l_suppkey % 6')} AS VARCHAR) AS codigo_segmento_cliente,
  {_at('r_name', 'region', 'r_regionkey', 'l_suppkey % 6')} AS segmentacion, lower({_at('r_name', 'region', 'r_regionkey', 'l_suppkey % 6')}) AS ds_unidad_negocio,
  {_at('r_name', 'region', 'r_regionkey', 'l_partkey % 5')} AS ds_tipo_grade, {_at('r_name', 'region', 'r_regionkey', 'l_partkey % 8')} AS ds_rango_antiguedad,
  {_at('r_name', 'region', 'r_regionkey', 'l_linenumber - 1')} AS ds_gama_plan_origen, {_at('r_name', 'region', 'r_regionkey', 'l_linenumber')} AS ds_gama_plan_destino,
  CAST({_at('s_suppkey', 'supplier', 's_suppkey', 'l_suppkey')} AS VARCHAR) AS cd_usuario_red_creacion,
  {_at('s_name', 'supplier', 's_suppkey', 'l_suppkey')} AS ds_nombre_usuario_creacion,
  CAST({_at('s_nationkey', 'supplier', 's_suppkey', 'l_suppkey')} AS VARCHAR) AS ds_ubicacion_usuario_creacion,
  CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier) THEN 'C' END AS ds_canal_usuario_creacion,
  CAST({_at('s_suppkey', 'supplier', 's_suppkey', 'l_suppkey + 1')} AS VARCHAR) AS cd_usuario_red_cierre,
  {_at('s_name', 'supplier', 's_suppkey', 'l_suppkey + 1')} AS ds_nombre_usuario_cierre,
  CAST({_at('s_nationkey', 'supplier', 's_suppkey', 'l_suppkey + 1')} AS VARCHAR) AS ds_ubicacion_usuario_cierre,
  CASE WHEN l_suppkey + 1 IN (SELECT s_suppkey FROM supplier) THEN 'C' END AS ds_canal_usuario_cierre,
  {_at('c_name', 'customer', 'c_custkey', 'l_orderkey')} AS identificacion, {_at('c_mktsegment', 'customer', 'c_custkey', 'l_orderkey')} AS identificacion_mtr,
  {_at('p_name', 'part', 'p_partkey', 'l_partkey')} AS ds_plan_origen, {_at('p_retailprice', 'part', 'p_partkey', 'l_partkey')} AS cfm_plan_origen,
  {_at('p_type', 'part', 'p_partkey', 'l_partkey')} AS tipo_plan_origen, {_at('p_brand', 'part', 'p_partkey', 'l_partkey')} AS tipo_linea,
  d_name AS ds_plan_destino, d_price AS cfm_plan_destino, d_type AS tipo_plan_destino, 'S' AS plan_negocios,
  'NEG_PLANES' AS flag, CASE WHEN l_linestatus = 'F' THEN 'Cerrado' ELSE 'Abierto' END AS estado_tickler
FROM cambios c WHERE NOT EXISTS (SELECT 1 FROM cargado h WHERE h.l_orderkey = c.l_orderkey AND h.l_partkey = c.l_partkey)
""")
def job_warehouse_extracts(spark, sf_dir):
    from ledgerline.jobs import warehouse as g9
    fact, dims = _warehouse(Tables(spark, sf_dir))
    hist = fact.filter(F.col("fe_creacion") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return g9.plan_changes(fact, dims, "1998-01-01", hist)


@query("job_warehouse_activations", "G9 U2 X10 X11 F13", sql="""
WITH ventas AS (
  SELECT o_orderkey AS co_id, o_orderpriority AS plan, o_custkey AS ssn, o_totalprice AS cfm,
         'razon ' || CAST(o_orderkey % 1000 AS VARCHAR) AS razon,
         o_orderpriority || ' - ' || o_orderstatus || 'CICLO' AS texto
  FROM orders)
SELECT DISTINCT 'NEGOCIOS' AS segmento, c.c_mktsegment AS flag, v.ssn, v.co_id, v.plan, v.razon AS razon_inicial, 'final ' || v.razon AS razon_final,
       CAST(trunc(v.cfm) AS INTEGER) AS cfm, substring(v.texto, position(' - ' IN v.texto) + 2, 3) AS ciclo
FROM customer c JOIN ventas v ON v.ssn = c.c_custkey AND c.c_acctbal > 0
WHERE regexp_matches(v.razon, '32|57|267|345|362|118|285|500|202|333|444|555|666|777')
""")
def job_warehouse_activations(spark, sf_dir):
    from ledgerline.jobs import warehouse as g9
    t = Tables(spark, sf_dir)
    reason = F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("razón ")).otherwise(F.lit("razon ")), (F.col("o_orderkey") % 1000).cast("string"))
    sales = t.orders.select(
        F.col("o_orderkey").alias("co_id"), F.col("o_orderpriority").alias("plan"), F.col("o_custkey").alias("ssn"), F.col("o_totalprice").alias("cfm"),
        reason.alias("razon_inicial"), F.concat(F.lit("final "), reason).alias("razon_final"),
        F.concat_ws("", F.col("o_orderpriority"), F.lit(" - "), F.col("o_orderstatus"), F.lit("CICLO")).alias("ciclo"))
    segments = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("identificacion"), F.col("c_mktsegment").alias("segmento"))
    return g9.activations(sales, segments)


@query("job_warehouse_dimensions", "G9 N3", sql="""
SELECT 'agentes' AS extracto, CAST(s_suppkey AS VARCHAR) AS clave, s_name AS direccion, CAST(s_nationkey AS VARCHAR) AS canal_comercial
FROM supplier WHERE s_acctbal <= 5000
UNION ALL SELECT 'planes', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part WHERE p_size > 10
UNION ALL SELECT 'base_segmento', CAST(c_custkey AS VARCHAR), c_mktsegment, '' FROM customer WHERE c_acctbal > 0 AND c_custkey % 7 <> 0
UNION ALL SELECT 'ciudades', CAST(c_custkey AS VARCHAR), c_name, ['D', 'T', 'MAY', 'C', 'X', 'Y'][1 + c_custkey % 6]
FROM customer WHERE c_custkey % 6 < 4 AND c_nationkey <> 3
""")
def job_warehouse_dimensions(spark, sf_dir):
    """The agent, plan, segment and city-code extracts, new rows of each."""
    from ledgerline.jobs import warehouse as g9
    from ledgerline.operators.setops import union_all
    t = Tables(spark, sf_dir)
    agents = t.supplier.select(F.col("s_suppkey").alias("cod_agente"), F.col("s_name").alias("region_comercial"),
                               F.col("s_nationkey").cast("string").alias("canal"), "s_acctbal")
    agents = g9.extract_new(g9.agents(agents), agents.filter("s_acctbal > 5000"), ["cod_agente"])
    plans = g9.extract_new(g9.plans(t.part), t.part.filter("p_size <= 10"), ["p_partkey", "p_name"])
    segments = t.customer.select(F.col("c_custkey").alias("identificacion"), F.col("c_mktsegment").alias("segmento"),
                                 F.when(F.col("c_acctbal") > 0, "1").otherwise("0").alias("cb_esactual"))
    loaded = segments.filter("identificacion % 7 = 0").select(F.col("identificacion").alias("cust_id"), F.col("segmento").alias("flag"))
    base = g9.extract_new(g9.segment_base(segments), loaded, ["cust_id", "flag"])
    kinds = F.array(*[F.lit(x) for x in ("D", "T", "MAY", "C", "X", "Y")])
    shops = t.customer.withColumn("tipo_distribuidor", F.element_at(kinds, (F.col("c_custkey") % 6 + 1).cast("int")))
    cities = g9.extract_new(g9.city_codes(shops), shops.filter("c_nationkey = 3"), ["c_custkey"])
    row = lambda name, key, a, b: [F.lit(name).alias("extracto"), F.col(key).cast("string").alias("clave"), F.col(a).alias("direccion"), F.col(b).alias("canal_comercial")]
    return union_all([agents.select(*row("agentes", "cod_agente", "direccion", "canal_comercial")), plans.select(*row("planes", "p_partkey", "p_name", "p_brand")),
                      base.select(*row("base_segmento", "cust_id", "flag", "usuario")), cities.select(*row("ciudades", "c_custkey", "c_name", "tipo_distribuidor"))])


@query("star_inner", "N20", sql="""
SELECT l.l_orderkey, l.l_linenumber, p.p_brand, s.s_name, n.n_name, o.o_orderstatus
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size > 20
JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0
JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_regionkey <> 2
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F'
""")
def star_inner(spark, sf_dir):
    """Inner roles drop fact rows without a match, the left one keeps them."""
    from ledgerline.jobs.warehouse import Role, star
    t = Tables(spark, sf_dir)
    dims = {"p": t.part.filter("p_size > 20"), "s": t.supplier.filter("s_acctbal > 0"), "n": t.nation.filter("n_regionkey <> 2"),
            "o": t.orders.filter("o_orderstatus = 'F'")}
    roles = [Role("p", "p_partkey", "l_partkey", {"p_brand": "p_brand"}, "inner"),
             Role("s", "s_suppkey", "l_suppkey", {"s_name": "s_name", "s_nationkey": "__nation"}, "inner"),
             Role("n", "n_nationkey", "__nation", {"n_name": "n_name"}, "inner"),
             Role("o", "o_orderkey", "l_orderkey", {"o_orderstatus": "o_orderstatus"})]
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return star(fact, dims, roles).select("l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name", "o_orderstatus")


def _org_sheet(t):
    s, n, r = t.supplier, t.nation, t.region
    sheet = s.join(n.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey") \
             .join(r.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    boss = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("__b"))
    sheet = sheet.join(boss, "s_nationkey")
    return sheet.select(
        F.when(F.col("s_acctbal") < 0, F.concat(F.col("s_name"), F.lit(" (VACANTE)"))).otherwise(F.col("s_name"))
         .alias("NOMBRE"),
        (F.col("s_suppkey") * 1000003 + 10000000000).cast("string").alias("No DOCUMENTO"),
        F.when(F.col("s_suppkey") == F.col("__b"), F.lit("Jefe de Ventas"))
         .otherwise(F.concat(F.lit(" consultor  "), F.col("r_name"))).alias("CARGO ACTUAL"),
        F.col("r_name").alias("SEGMENTO"), F.concat(F.lit("\t"), F.col("n_name")).alias("CANAL"),
        F.concat(F.lit("Supplier#"), F.format_string("%09d", "__b")).alias("NOMBRE JEFE"))


@query("job_org_chart", "G14 A4 N6 W6 N7 X14 X13 A3 C7 N11 N12 X15 X8 C8 C10", sql="""
WITH boss AS (SELECT s_nationkey, min(s_suppkey) AS b FROM supplier GROUP BY 1),
sheet AS (
  SELECT CASE WHEN s.s_acctbal < 0 THEN s.s_name || ' (VACANTE)' ELSE s.s_name END AS nombre_raw,
         CAST(s.s_suppkey * 1000003 + 10000000000 AS VARCHAR) AS doc,
         CASE WHEN s.s_suppkey = b.b THEN 'Jefe de Ventas' ELSE ' consultor  ' || r.r_name END AS cargo,
         r.r_name AS segmento, chr(9) || n.n_name AS canal,
         'Supplier#' || printf('%09d', b.b) AS jefe
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  JOIN boss b ON b.s_nationkey = s.s_nationkey),
clean AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(upper(cargo), '^\\s+|\\s+$', '', 'g'), '[\\n\\r\\t]', '', 'g'), '  ', '', 'g') AS c_cargo,
            regexp_replace(regexp_replace(regexp_replace(upper(segmento), '^\\s+|\\s+$', '', 'g'), '[\\n\\r\\t]', '', 'g'), '  ', '', 'g') AS c_segmento,
            regexp_replace(regexp_replace(regexp_replace(upper(canal), '^\\s+|\\s+$', '', 'g'), '[\\n\\r\\t]', '', 'g'), '  ', '', 'g') AS c_canal
  FROM sheet),
cands AS (SELECT DISTINCT 'cargo' AS dominio, c_cargo AS valor FROM clean
          UNION SELECT 'segmento', c_segmento FROM clean UNION SELECT 'canal', c_canal FROM clean),
existing AS (SELECT dominio, valor, row_number() OVER (PARTITION BY dominio ORDER BY valor) * 10 AS id
             FROM cands WHERE valor < 'M'),
fresh AS (SELECT c.* FROM cands c WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.dominio = c.dominio AND e.valor = c.valor)),
newids AS (SELECT f.dominio, f.valor, coalesce((SELECT max(id) FROM existing e WHERE e.dominio = f.dominio), 0)
                  + row_number() OVER (PARTITION BY f.dominio ORDER BY f.valor) AS id FROM fresh f),
dom AS (SELECT dominio, valor, id FROM existing UNION ALL SELECT * FROM newids),
people AS (SELECT upper(md5('7:PERSONA4:jefe' || CAST(length(nombre) AS VARCHAR) || ':' || nombre)) AS id_persona, nombre
           FROM (SELECT regexp_replace(regexp_replace(nombre_raw, '\\(VACANT[EA]\\)', '', 'g'), '^\\s+|\\s+$', '', 'g') AS nombre
           FROM sheet WHERE contains(lower(cargo), 'jefe'))),
fixed AS (SELECT *, CASE WHEN length(doc) IN (9, 11) AND starts_with(doc, '1') THEN substring(doc, 2) ELSE doc END AS ident
          FROM clean)
SELECT regexp_replace(regexp_replace(f.nombre_raw, '\\(VACANT[EA]\\)', '', 'g'), '^\\s+|\\s+$', '', 'g') AS nombre_completo,
       f.ident AS identificacion, right(f.doc, 8) AS codigo_dealer,
       CAST(dc.id AS BIGINT) AS id_cargo, CAST(ds.id AS BIGINT) AS id_segmento, CAST(dn.id AS BIGINT) AS id_canal,
       p.id_persona AS id_jefe,
       CASE WHEN contains(f.nombre_raw, '(VACANTE)') THEN 4 ELSE 1 END AS id_estado_registro,
       2 AS version, 'PLANTA COMERCIAL' AS fuente
FROM fixed f
LEFT JOIN dom dc ON dc.dominio = 'cargo' AND dc.valor = f.c_cargo
LEFT JOIN dom ds ON ds.dominio = 'segmento' AND ds.valor = f.c_segmento
LEFT JOIN dom dn ON dn.dominio = 'canal' AND dn.valor = f.c_canal
LEFT JOIN people p ON p.nombre = regexp_replace(regexp_replace(f.jefe, '\\(VACANT[EA]\\)', '', 'g'), '^\\s+|\\s+$', '', 'g')
""")
def job_org_chart(spark, sf_dir):
    import datetime as _dt
    from pyspark.sql import Window
    from ledgerline.jobs import org_chart as g14
    from ledgerline.operators.lifecycle import Run
    t = Tables(spark, sf_dir)
    sheet = g14.commit(_org_sheet(t))  # the landed sheet: read once
    run = Run(job="org_chart", run_id="RUN-ORG-0001", started=_dt.datetime(2024, 4, 1))
    # Domain rows and persons already loaded (derived from the data itself).
    cands = g14.domain_candidates(sheet, list(g14.ORG_DOMAINS), clean=g14.deep_clean)
    names = F.create_map(*[x for k, v in g14.ORG_DOMAINS.items() for x in (F.lit(k), F.lit(v))])
    cands = cands.withColumn("dominio", names[F.col("dominio")]).distinct()
    w = Window.partitionBy("dominio").orderBy("valor")
    existing = cands.filter(F.col("valor") < "M").withColumn("id", (F.row_number().over(w) * 10).cast("bigint"))
    fresh = g14.domain_updates(sheet, existing, run)
    domains = g14.commit(existing.unionByName(fresh.select("dominio", "valor", "id")))   # C10
    people_existing = spark.createDataFrame([], "rol string, id_persona string, nombre string, "
                                                "identificacion string, id_estado_registro int")
    new_people, _ = g14.person_updates(sheet, people_existing.drop("rol", "id_persona"), run)
    new_people = g14.commit(new_people)                                                    # C10
    from ledgerline.operators.lifecycle import next_version
    previous_fact = sheet.select(F.lit(1).alias("version"))  # the load before this one
    version = next_version(previous_fact)                   # C8: max + 1
    return g14.build_fact(sheet, domains, new_people, version, "PLANTA COMERCIAL", run).drop("id")


@query("job_white_label", "G10 N4 U1 X29 C1", sql=f"""
WITH {WL_PACKAGES_SQL},
res AS (
  SELECT r.tipo, r.o_orderkey, r.nit, r.co_id, r.tel_num, r.cod_paq_instalado, r.desc_serv_instalado, r.valor_paq,
         r.fecha_excel, r.fecha_act_paq, r.fecha_desact_paq, r.anio_mes_act_paq,
         CASE WHEN r.nit IN (SELECT nit FROM comp) THEN 'EMPRESAS' ELSE 'NEGOCIOS' END AS segmento,
         CASE WHEN EXISTS (SELECT 1 FROM keys_other k WHERE k.tipo = r.tipo AND k.nit = r.nit
                            AND k.tel_num = r.tel_num AND k.valor_paq = r.valor_paq
                            AND k.paq = coalesce(CAST(CAST(trunc(r.cod_paq_instalado) AS BIGINT) AS VARCHAR), ''))
              THEN 'Cruza' ELSE 'No cruza' END AS cruce_bajas_altas,
         CASE WHEN r.tipo = 'ALTAS' THEN r.anio_mes_act_paq ELSE strftime(r.fecha_desact_paq, '%Y-%m') END AS mes_mb
  FROM ranked r WHERE rn = 1),
hist AS (SELECT co_id, fecha_excel, valor_paq, desc_serv_instalado, mes_mb FROM res WHERE valor_paq >= 400)
SELECT 'RUN-WL-0001' AS id_ejecucion, tipo, o_orderkey, nit, co_id, tel_num, cod_paq_instalado, desc_serv_instalado,
       valor_paq, fecha_excel, fecha_act_paq, fecha_desact_paq, anio_mes_act_paq, segmento, mes_mb,
       TIMESTAMP '2024-12-31 00:00:00' AS fecha_procesamiento, 'MARCA BLANCA' AS fuente, '1' AS id_estado,
       1 AS id_estado_registro
FROM res x WHERE cruce_bajas_altas = 'No cruza' AND NOT EXISTS (SELECT 1 FROM hist h
  WHERE h.co_id = x.co_id AND h.fecha_excel = x.fecha_excel AND h.valor_paq = x.valor_paq
    AND h.desc_serv_instalado IS NOT DISTINCT FROM x.desc_serv_instalado AND h.mes_mb = x.mes_mb)
""")
def job_white_label(spark, sf_dir):
    import datetime as _dt
    from ledgerline.jobs import white_label as g10
    from ledgerline.operators.lifecycle import Run
    t = Tables(spark, sf_dir)
    companies = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("nit"))
    # The demo derives its "already loaded" history from this run's own result,
    # so the result is committed once instead of being computed twice.
    res = g10.churn_and_additions(g10.demo_packages(t.orders), g10.DEMO_RULES, companies).checkpoint(eager=True)
    history = res.filter(F.col("valor_paq") >= 400).select(*g10.SERVICE_KEY, F.col("periodo").alias("mes_mb"))
    out = g10.load(res, history, Run(job="white_label", run_id="RUN-WL-0001", started=_dt.datetime(2024, 12, 31)))
    return out.select("id_ejecucion", "tipo", "o_orderkey", "nit", "co_id", "tel_num", "cod_paq_instalado",
                      "desc_serv_instalado", "valor_paq", "fecha_excel", "fecha_act_paq", "fecha_desact_paq",
                      "anio_mes_act_paq", "segmento", "mes_mb", "fecha_procesamiento", "fuente", "id_estado",
                      "id_estado_registro")


def _deep_sql(x: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(upper(replace({x}, 'ß', 'SS')), '^\\s+|\\s+$', '', 'g'), "
            f"'[\\n\\r\\t]', '', 'g'), '  ', '', 'g')")


OFFICIAL_SRC = [  # (header as landed, source expression valid in Spark SQL and DuckDB)
    (" rol ", "c_mktsegment"), ("Cédula", "CASE WHEN c_acctbal < 0 THEN 'n/d' ELSE CAST(c_custkey AS STRING) END"),
    ("COMERCIAL", "lower(c_name) || chr(9)"), ("cargo ", "'  consultor'"), ("Correo", "lower(c_name) || '@x.co'"),
    ("JEFE", "'jefe ' || CAST(c_nationkey AS STRING)"), ("Correo Jefe", "'jefe@x.co'"),
    ("Reto Estratégico", "CASE WHEN c_acctbal > 5000 THEN 'si' ELSE 'no' END"),
    ("ALTAS FIJO", "CAST(c_nationkey AS STRING)"), ("BAJAS FIJO", "'0'"), ("NETO FIJO", "CAST(c_nationkey AS STRING)"),
    ("Líneas", "'1'"), ("META MÓVIL", "CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING)"), ("BAJAS MÓVIL", "'0'"),
    ("NETO MÓVIL", "'1'"), ("CP MÓVIL", "'2'"), ("EXTRA", "'x'")]


def _official_oracle() -> str:
    from ledgerline.jobs.targets import OFFICIAL_COLUMNS
    targets = list(OFFICIAL_COLUMNS.values())
    exprs = dict(zip(targets, [e for _, e in OFFICIAL_SRC[:16]]))
    cols = []
    for c in targets:
        if c == "identificacion":
            cols.append(f"coalesce(CAST(trunc(TRY_CAST({exprs[c]} AS DOUBLE)) AS BIGINT), 0) AS identificacion")
        else:
            cols.append(f"{_deep_sql(exprs[c])} AS {c}")
    base = "SELECT " + ", ".join(cols) + " FROM customer"
    return (f"WITH b AS ({base})\nSELECT 'RUN-OFICIAL-0001' AS id_ejecucion, "
            + ", ".join(targets) + ", TIMESTAMP '2024-03-01 00:00:00' AS fecha_procesamiento, "
            "'METAS OFICIAL' AS fuente, 1 AS id_estado_registro FROM b")


@query("job_targets_official", "G15 S18 J2 J4 J1 X2 X17 C1", sql=_official_oracle())
def job_targets_official(spark, sf_dir):
    import datetime as _dt
    from ledgerline.jobs import targets as g15
    from ledgerline.operators.lifecycle import Run
    c = Tables(spark, sf_dir).customer
    sheet = c.select(*[F.expr(e).alias(h) for h, e in OFFICIAL_SRC])
    run = Run(job="targets_official", run_id="RUN-OFICIAL-0001", started=_dt.datetime(2024, 3, 1))
    return g15.official(sheet, run, "METAS OFICIAL").drop("id")


def _company_values() -> dict[str, str]:
    from ledgerline.jobs.targets import COMPANY_COLUMNS
    kinds = ["c_mktsegment", "CAST(c_custkey AS STRING)", "lower(c_name)", "'  cargo'", "c_nationkey", "c_acctbal",
             "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END"]
    return {header: kinds[i % len(kinds)] for i, header in enumerate(COMPANY_COLUMNS)}


def _company_sql() -> str:
    from ledgerline.jobs.targets import COMPANY_COLUMNS
    cols = ", ".join(f"{e} AS {c}" for e, c in zip(_company_values().values(), COMPANY_COLUMNS.values()))
    return (f"SELECT 'RUN-EMPRESAS-0001' AS id_ejecucion, {cols}, TIMESTAMP '2024-03-01 00:00:00' AS fecha_procesamiento, "
            "'METAS EMPRESAS' AS fuente, 1 AS id_estado_registro FROM customer")


@query("job_targets_company", "G15 S18 J2 J4 J1 C1", sql=_company_sql())
def job_targets_company(spark, sf_dir):
    import datetime as _dt
    from ledgerline.jobs import targets as g15
    from ledgerline.operators.lifecycle import Run
    c = Tables(spark, sf_dir).customer
    sheet = c.select(*[F.expr(e).alias(f" {h.capitalize()} ") for h, e in _company_values().items()], F.lit(0).alias("SOBRA"))
    run = Run(job="targets_company", run_id="RUN-EMPRESAS-0001", started=_dt.datetime(2024, 3, 1))
    return g15.company(sheet, run, "METAS EMPRESAS").drop("id")
