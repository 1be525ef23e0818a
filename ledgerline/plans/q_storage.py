"""Queries through landed files, committed loads, the key index and the state log.

Each builds its storage in the shared scratch folder from the driver's tables,
the way a deployment would over time, and returns what a reader then sees.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ledgerline.jobs import loaders
from ledgerline.operators import state_log
from ledgerline.operators.key_index import KeyIndex
from ledgerline.operators.lifecycle import Run, latest_version
from ledgerline.operators.setops import union_all
from ledgerline.operators.staging import scratch_folder
from ledgerline.plans.catalog import Tables
from ledgerline.plans.q_incremental import LINE_KEY
from ledgerline.plans.registry import query
from ledgerline.sources import commits, ledger, readers, sinks

RUN = Run(job="storage", run_id="RUN-STORE-0001", started=_dt.datetime(2024, 6, 1))


def _before(col: str, day: str):
    return F.col(col) < F.lit(day).cast("timestamp_ntz")


@query("new_rows_key_index", "N1 N8 N9", sql="""
WITH b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'),
     h AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT b.*, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.l_orderkey = b.l_orderkey AND h.l_partkey = b.l_partkey
    AND h.l_suppkey = b.l_suppkey AND h.l_linenumber = b.l_linenumber) THEN 'EXISTENTE' ELSE 'NUEVO' END AS estado_cruce
FROM b
""")
def new_rows_key_index(spark, sf_dir):
    """History comes in two loads; the second one is tried twice."""
    li = Tables(spark, sf_dir).lineitem
    index = KeyIndex(spark, scratch_folder(spark, "key-index"), {k: dict(li.dtypes)[k] for k in LINE_KEY}, buckets=8)
    index.add(li.filter(_before("l_shipdate", "1996-01-01")), "to-1995", RUN)
    later = li.filter(_before("l_shipdate", "1998-01-01") & ~_before("l_shipdate", "1996-01-01"))
    for _ in range(2):
        index.add(later, "to-1997", RUN)
    batch = li.filter(~_before("l_shipdate", "1997-01-01")).select(*LINE_KEY, "l_quantity")
    fresh = index.new_rows(batch).withColumn("estado_cruce", F.lit("NUEVO"))
    return fresh.unionByName(index.existing_rows(batch).withColumn("estado_cruce", F.lit("EXISTENTE")))


@query("committed_append", "S7 S11 C2 C3", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def committed_append(spark, sf_dir):
    """Two yearly loads.  The second is killed after its files were written and
    before its record; its repetition counts once, as does one more."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    table = scratch_folder(spark, "orders")

    def year(y):
        return o.filter(~_before("o_orderdate", f"{y}-01-01") & _before("o_orderdate", f"{y + 1}-01-01")).drop("o_orderdate")
    commits.append_committed(year(1996), table, "1996", RUN, "PEDIDOS", partition_by="o_orderstatus")
    year(1997).write.partitionBy("o_orderstatus").parquet(f"{table}/data/__load=1997-killed")
    for _ in range(2):
        commits.append_committed(year(1997), table, "1997", RUN, "PEDIDOS", partition_by="o_orderstatus")
    return commits.read_committed(spark, table)


@query("committed_audit", "C2 C3", sql="""
SELECT 'RUN-STORE-0001' AS id_ejecucion, 'storage' AS proceso, o_orderstatus AS fuente, count(*) AS cantidad_registros, 1 AS id_estado,
       TIMESTAMP '2024-06-01 00:00:00' AS fecha_inicio
FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus
""")
def committed_audit(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    table = scratch_folder(spark, "orders")
    for status in ("F", "P", "F"):
        commits.append_committed(o.filter(F.col("o_orderstatus") == status), table, f"status-{status}", RUN, status)
    return commits.audit(spark, table).drop("fecha_fin", "duracion_segundos")


@query("claimed_versions", "C8 N24", sql="""
SELECT p_partkey, p_retailprice * 2 AS precio, 2 AS version FROM part WHERE p_size < 25
""")
def claimed_versions(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    path = scratch_folder(spark, "prices")
    sinks.write_snapshot(p.select("p_partkey", F.col("p_retailprice").alias("precio")), path)
    sinks.write_snapshot(p.filter(F.col("p_size") < 25).select("p_partkey", (F.col("p_retailprice") * 2).alias("precio")), path)
    return latest_version(spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in commits.versions(spark, path)]))


@query("state_log_update", "C6 C7", sql="""
SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN 4 WHEN s_suppkey % 7 = 0 THEN 2 WHEN s_acctbal < 1000 THEN 4 ELSE 1 END AS id_estado FROM supplier
""")
def state_log_update(spark, sf_dir):
    """Vacated names are set to 4; later some keys go to 2 wherever they are not
    retired.  The log is compacted between the updates."""
    s = Tables(spark, sf_dir).supplier
    table = s.select("s_suppkey", F.when(F.col("s_nationkey") == 0, 4).otherwise(1).alias("id_estado"), "s_nationkey")
    log = scratch_folder(spark, "states")
    state_log.log_states(s.filter(F.col("s_acctbal") < 1000), log, ["s_suppkey"], 4, unless=4)
    state_log.compact(spark, log, ["s_suppkey"])
    retired = table.filter("id_estado = 4").select("s_suppkey")
    state_log.log_states(s.filter("s_suppkey % 7 = 0").join(retired, "s_suppkey", "left_anti"), log, ["s_suppkey"], 2)
    return state_log.with_states(table, log, ["s_suppkey"]).select("s_suppkey", "id_estado")


@query("file_ledger_load", "S1 S14 S15 S16 S17", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, 'PEDIDOS' AS fuente FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
""")
def file_ledger_load(spark, sf_dir):
    """Files land in two goes, the older rows last; each is loaded once, and a
    run with nothing new loads nothing."""
    o = Tables(spark, sf_dir).orders
    landing, table = scratch_folder(spark, "landing"), scratch_folder(spark, "orders")
    read = lambda paths: union_all([readers.read_landed(spark, p, source_tag="PEDIDOS") for p in paths])

    def land(name, rows):
        rows.select("o_orderkey", "o_orderstatus", "o_totalprice").coalesce(1).write.parquet(f"{landing}/{name}")
    land("b", o.filter(_before("o_orderdate", "1998-01-01") & ~_before("o_orderdate", "1996-01-01")))
    ledger.load_pending(spark, landing, table, read, RUN, "PEDIDOS", pattern="*.parquet")
    land("a", o.filter(_before("o_orderdate", "1996-01-01")))
    for _ in range(2):
        ledger.load_pending(spark, landing, table, read, RUN, "PEDIDOS", pattern="*.parquet")
    return commits.read_committed(spark, table)


@query("newest_landed_file", "S14 S15", sql="""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def newest_landed_file(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    landing, table = scratch_folder(spark, "landing"), scratch_folder(spark, "customers")
    for k, segment in enumerate(("BUILDING", "AUTOMOBILE", "MACHINERY")):
        c.filter(F.col("c_mktsegment") == segment).select("c_custkey", "c_name").coalesce(1).write.parquet(f"{landing}/sheet-{k}")
    ledger.load_pending(spark, landing, table, lambda paths: spark.read.parquet(*paths), RUN, "CLIENTES", pattern="*.parquet", newest_only=True)
    return commits.read_committed(spark, table)


@query("landed_headerless_csv", "S3 S4 J3", sql="""
SELECT CAST(c_custkey AS BIGINT) AS cuenta, c_name AS nombre, c_acctbal AS saldo FROM customer
""")
def landed_headerless_csv(spark, sf_dir):
    """Latin-1, by position; the columns beyond the range are cut."""
    from pyspark.sql.types import DoubleType, LongType, StringType

    from ledgerline.sources.contracts import positional_schema
    c = Tables(spark, sf_dir).customer
    path = scratch_folder(spark, "headerless")
    c.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey").write.option("encoding", "ISO-8859-1").csv(path)
    schema = positional_schema(5, {0: ("cuenta", LongType()), 1: ("nombre", StringType()), 2: ("saldo", DoubleType())})
    return readers.read_headerless_csv(spark, path, schema, keep=3)


@query("landed_csv_with_rejects", "S5 S6 S12 S13", sql="""
SELECT CAST(CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey END AS BIGINT) AS suppkey, s_suppkey % 9 = 0 AS rechazada, count(*) AS filas,
       CASE WHEN s_suppkey % 9 = 0 THEN 'x' || s_suppkey || ';' || s_nationkey END AS linea
FROM supplier GROUP BY ALL
""")
def landed_csv_with_rejects(spark, sf_dir):
    """A ``;`` file with a header, in which every ninth number is none."""
    s = Tables(spark, sf_dir).supplier
    path = scratch_folder(spark, "rejects")
    number = F.when(F.col("s_suppkey") % 9 == 0, F.concat(F.lit("x"), F.col("s_suppkey").cast("string"))).otherwise(F.col("s_suppkey").cast("string"))
    sinks.write_csv_copy(s.select(number.alias("suppkey"), "s_nationkey"), path)
    from pyspark.sql.types import StructType
    good, bad = readers.read_csv_with_rejects(spark, path, StructType.fromDDL("suppkey bigint, nation bigint"))
    headed = readers.read_headered_csv(spark, path)
    if headed.columns != ["suppkey", "s_nationkey"]:
        raise ValueError(f"unexpected header {headed.columns}")
    rows = good.select("suppkey", F.lit(False).alias("rechazada"), F.lit(None).cast("string").alias("linea"))
    lines = bad.select(F.lit(None).cast("bigint").alias("suppkey"), F.lit(True).alias("rechazada"), F.col(readers.CORRUPT).alias("linea"))
    return rows.unionByName(lines).groupBy("suppkey", "rechazada", "linea").agg(F.count(F.lit(1)).alias("filas"))


@query("load_error_rows", "C4 S18 C2", sql="""
SELECT 'RUN-STORE-0001' AS id_ejecucion, 'storage' AS proceso, 'PEDIDOS ' || o_orderstatus AS fuente, 'transform' AS funcion, 100 AS largo,
       count(*) AS filas_leidas, 0 AS filas_cargadas
FROM orders WHERE o_orderstatus = 'P' GROUP BY o_orderstatus
""")
def load_error_rows(spark, sf_dir):
    """A load whose file lacks a required column leaves an error row, its message
    cut to 100 characters, and no rows."""
    from ledgerline.jobs.order_loader import LoaderConfig, run_loader
    from ledgerline.operators.columns import MissingColumnsError
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") == "P")
    folder = scratch_folder(spark, "failed-load")
    wanted = [f"columna_obligatoria_{i:02d}" for i in range(8)]
    cfg = LoaderConfig(source="PEDIDOS P", rename={}, key=["o_orderkey"], required=wanted)
    try:
        run_loader(o, o.select("o_orderkey"), cfg, RUN, f"{folder}/target", f"{folder}/audit", f"{folder}/errors")
    except MissingColumnsError:
        pass
    loaded = readers.read_existing(spark, f"{folder}/target")
    rows = spark.read.parquet(f"{folder}/errors")
    kept = 0 if loaded is None else loaded.count()
    return rows.select("id_ejecucion", "proceso", "fuente", "funcion", F.length("descripcion_error").alias("largo"),
                       F.lit(o.count()).cast("bigint").alias("filas_leidas"), F.lit(kept).alias("filas_cargadas"))


_RUN_SQL = "'RUN-STORE-0001' AS id_ejecucion"
_TS_SQL = "TIMESTAMP '2024-06-01 00:00:00' AS fecha_procesamiento"


@query("job_upsell_csv", "G2 S4 J3 F1 N1 X1 C1", sql=f"""
SELECT {_RUN_SQL}, l_orderkey AS cuenta, CAST(l_linenumber AS BIGINT) AS ot, l_returnflag || l_partkey AS service_code,
       l_discount AS monthly_rental_charge, l_tax AS renta_mes_anterior, l_linestatus AS cod_servicio_anterior, 'UP' AS tipo_cambio,
       {_TS_SQL}, 'UPSELL' AS fuente, '1' AS id_estado
FROM lineitem b WHERE l_discount > 0 AND NOT EXISTS (SELECT 1 FROM lineitem h WHERE h.l_shipdate < TIMESTAMP '1997-01-01'
  AND h.l_orderkey = b.l_orderkey AND h.l_linenumber = b.l_linenumber AND h.l_returnflag = b.l_returnflag AND h.l_partkey = b.l_partkey)
""")
def job_upsell_csv(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    path = scratch_folder(spark, "upsell")
    code = F.concat("l_returnflag", F.col("l_partkey").cast("string"))
    rows = li.select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), F.lower(code), F.lit("  ")).alias("code"), "l_discount", "l_tax", F.lower("l_linestatus"),
                     F.lit("up"), *[F.lit("x").alias(f"x{i}") for i in range(5)], "l_shipdate")
    rows.drop("l_shipdate").write.option("encoding", "ISO-8859-1").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    old = li.filter(_before("l_shipdate", "1997-01-01")).select(
        F.col("l_orderkey").alias("cuenta"), F.col("l_linenumber").cast("bigint").alias("ot"),
        F.concat(F.lit(" "), F.lower(code), F.lit("  ")).alias("service_code"))
    return loaders.upsell_csv(spark, path, old, RUN, "UPSELL").drop("id")


@query("job_sales_csv", "G3 S4 J3 X36 F1 N1 C1", sql=f"""
SELECT {_RUN_SQL}, o_orderkey AS cuenta, CAST(o_custkey AS BIGINT) AS ot, '20' AS anio_1, CAST(year(o_orderdate) AS VARCHAR) AS anio_2,
       CAST(day(o_orderdate) AS VARCHAR) AS dia, CAST(month(o_orderdate) AS VARCHAR) AS mes, o_orderstatus AS codigo_servicio_ad, '1' AS cantidad,
       '12' AS plazo, '0' AS valor_total, o_totalprice AS valor, CAST(o_orderdate AS DATE) AS fecha, {_TS_SQL}, 'VENTAS' AS fuente, '1' AS id_estado
FROM orders WHERE o_totalprice > 0 AND o_orderdate >= TIMESTAMP '1998-01-01'
""")
def job_sales_csv(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = scratch_folder(spark, "sales")
    filler = iter(range(100))

    def x():
        return F.lit("x").alias(f"x{next(filler)}")
    when = F.col("o_orderdate")
    o.select("o_orderkey", "o_custkey", F.lit("20"), F.year(when), F.dayofmonth(when), F.month(when), x(), x(), x(), x(), x(),
             "o_orderstatus", x(), F.lit("1"), x(), F.lit("12"), F.lit("0"), F.col("o_totalprice").cast("string")).toDF(*[f"c{i}" for i in range(18)]).write.csv(path)
    old = o.filter(_before("o_orderdate", "1998-01-01")).select(
        F.col("o_orderkey").alias("cuenta"), F.col("o_custkey").alias("ot"), F.col("o_orderstatus").alias("codigo_servicio_ad"))
    return loaders.sales_csv(spark, path, old, RUN, "VENTAS").drop("id")


@query("job_dashboard_csv", "G17 S6 X46 N5 C1", sql=f"""
SELECT {_RUN_SQL}, CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, event_id AS evento, value AS valor, event_type AS tipo, {_TS_SQL}, 'DASHBOARD' AS fuente, '1' AS id_estado
FROM events WHERE event_id % 11 <> 0 AND CAST(ts AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE ts < TIMESTAMP '2024-01-05')
""")
def job_dashboard_csv(spark, sf_dir):
    """Every eleventh line has one value too many and is rejected."""
    from pyspark.sql.types import StructType
    e = Tables(spark, sf_dir).events
    path = scratch_folder(spark, "dashboard")
    line = F.concat_ws(";", F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"), F.col("value").cast("string"), "event_type")
    rows = e.select(F.when(F.col("event_id") % 11 == 0, F.concat(line, F.lit(";too;many"))).otherwise(line).alias("fecha;evento;valor;tipo"))
    rows.write.option("header", True).option("sep", "\u0001").csv(path)
    old = e.filter(_before("ts", "2024-01-05")).select(F.to_date("ts").alias("fecha_dia"))
    schema = StructType.fromDDL("fecha string, evento string, valor string, tipo string")
    good, _ = loaders.dashboard_csv(spark, path, schema, {"evento": "bigint", "valor": "double"}, old, RUN)
    return good.drop("id")
