"""Join, lookup, pivot and union queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ledgerline.functions.constants import NOT_APPLICABLE
from ledgerline.functions.text import deep_clean, strip_upper
from ledgerline.operators import dims
from ledgerline.operators.fill import resolve_twins
from ledgerline.operators.pivot import eav_pivot, guarded_bigint
from ledgerline.operators.setops import align_to_schema, union_all, union_distinct
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query


@query("star_lookup", "N11 N20", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand, s.s_name, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def star_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = dims.lookup(fact, t.part, "l_partkey", "p_partkey", {"p_brand": "p_brand"})
    out = dims.lookup(out, t.supplier, "l_suppkey", "s_suppkey",
                      {"s_name": "s_name", "s_nationkey": "__snk"})
    out = dims.lookup(out, t.nation, "__snk", "n_nationkey", {"n_name": "n_name", "n_regionkey": "__rk"})
    out = dims.lookup(out, t.region, "__rk", "r_regionkey", {"r_name": "r_name"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name", "n_name", "r_name")


SEGMENT_IDS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


@query("lookup_with_default", "N13 N15", sql="""
WITH rich AS (SELECT DISTINCT c_mktsegment AS seg FROM customer WHERE c_acctbal > 9900)
SELECT c_custkey,
  CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
       WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 13 END AS INTEGER) AS id_segmento,
  CASE WHEN c_mktsegment IN (SELECT seg FROM rich) THEN c_mktsegment ELSE 'NO APLICA' END AS segmento_valido
FROM customer
""")
def lookup_with_default(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    # Configured value -> id map, absent -> default 13.  The map is a
    # job parameter of bounded size, so it is an inline map, not a join.
    m = F.create_map(*[x for k, v in SEGMENT_IDS.items() for x in (F.lit(k), F.lit(v))])
    out = c.select("c_custkey", "c_mktsegment",
                   F.coalesce(m[F.col("c_mktsegment")], F.lit(13)).cast("int").alias("id_segmento"))
    rich = c.filter(F.col("c_acctbal") > 9900).select("c_mktsegment")
    out = dims.keep_if_known(out, "c_mktsegment", rich, "c_mktsegment")
    return out.select("c_custkey", "id_segmento", F.col("c_mktsegment").alias("segmento_valido"))


@query("two_role_dimension", "N21 X30", sql="""
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS nacion_cliente, sn.n_name AS nacion_proveedor,
       CASE WHEN cn.n_nationkey = sn.n_nationkey THEN 'LOCAL' ELSE 'EXTERIOR' END AS tipo
FROM lineitem l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN (SELECT n_nationkey, n_name, n_regionkey FROM nation) sn ON sn.n_nationkey = s.s_nationkey
WHERE sn.n_regionkey = 3
""")
def two_role_dimension(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t.nation
    f = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    f = f.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "left")
    f = f.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    f = f.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey", "left")
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nacion_cliente"))
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nacion_proveedor"),
                       F.col("n_regionkey").alias("sn_region"))
    f = f.join(cn, "c_nationkey", "left").join(sn, "s_nationkey", "left")
    # The WHERE on the second role turns its outer join into an inner one.
    f = f.filter(F.col("sn_region") == 3)
    tipo = F.when(F.col("c_nationkey") == F.col("s_nationkey"), "LOCAL").otherwise("EXTERIOR")
    return f.select("l_orderkey", "l_linenumber", "nacion_cliente", "nacion_proveedor", tipo.alias("tipo"))


@query("guarded_cast_join", "N22", sql="""
WITH e AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'x' || regexp_extract(props, '"k": (\\d+)', 1)
                        WHEN event_type = 'signup' THEN '99999999999999999999'
                        ELSE regexp_extract(props, '"k": (\\d+)', 1) END AS k_text
  FROM events)
SELECT e.event_id, e.k_text, c.c_custkey, c.c_name
FROM e JOIN customer c
  ON CASE WHEN regexp_full_match(e.k_text, '[0-9]{1,19}') THEN TRY_CAST(e.k_text AS BIGINT) END = c.c_custkey
""")
def guarded_cast_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    e = t.events.select("event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("x"), k))
                        .when(F.col("event_type") == "signup", F.lit("99999999999999999999"))
                        .otherwise(k).alias("k_text"))
    e = e.withColumn("__id", guarded_bigint("k_text"))
    c = t.customer.select(F.col("c_custkey").alias("__id"), F.col("c_custkey"), "c_name")
    return e.join(c, "__id", "inner").select("event_id", "k_text", "c_custkey", "c_name")


@query("contains_first_match", "N16", sql="""
WITH probes AS (
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN s_name ELSE 'brand#' || CAST(s_nationkey AS VARCHAR) END AS probe
  FROM supplier),
dim AS (SELECT DISTINCT p_brand FROM part)
SELECT s_suppkey, probe,
  coalesce((SELECT min(p_brand) FROM dim WHERE contains(lower(p_brand), lower(probe))), 'SIN MARCA') AS marca
FROM probes
""")
def contains_first_match(spark, sf_dir):
    t = Tables(spark, sf_dir)
    probes = t.supplier.select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, F.col("s_name"))
         .otherwise(F.concat(F.lit("brand#"), F.col("s_nationkey").cast("string"))).alias("probe"))
    dim = t.part.select("p_brand").distinct()
    return dims.contains_first_match(probes, "probe", dim, "p_brand", ["p_brand"], "marca",
                                     default="SIN MARCA")


EVENT_FIELDS = ["view", "click", "purchase", "signup", "error", "refund"]


@query("eav_pivot_latest", "A9 P15 J7", sql="""
SELECT user_id,
""" + ",\n".join(f"  arg_max(value, ts) FILTER (WHERE event_type = '{f}' AND value IS NOT NULL) AS \"{f}\""
                 for f in EVENT_FIELDS) + """
FROM events WHERE value IS NOT NULL GROUP BY user_id
""")
def eav_pivot_latest(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return eav_pivot(e, "user_id", "event_type", "value", "ts", EVENT_FIELDS, tiebreak=["event_id"])


@query("twin_resolution", "J12 N18", sql="""
WITH l AS (SELECT o_orderkey, o_custkey AS custkey,
                  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS etiqueta FROM orders),
     r AS (SELECT c_custkey AS custkey, c_mktsegment AS etiqueta, c_name FROM customer WHERE c_acctbal > 5000)
SELECT l.custkey, l.o_orderkey, r.c_name, coalesce(r.etiqueta, l.etiqueta) AS etiqueta
FROM l LEFT JOIN r ON l.custkey = r.custkey
""")
def twin_resolution(spark, sf_dir):
    t = Tables(spark, sf_dir)
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"),
                           F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("etiqueta"))
    right = t.customer.filter(F.col("c_acctbal") > 5000).select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("etiqueta"), "c_name")
    out = resolve_twins(left, right, "custkey", how="left", prefer="right")
    return out.select("custkey", "o_orderkey", "c_name", "etiqueta")


TARGET = StructType([
    StructField("id", LongType()), StructField("nombre", StringType()),
    StructField("saldo", DoubleType()), StructField("nacion", IntegerType()),
    StructField("precio", DoubleType()), StructField("fuente", StringType())])


@query("pad_and_align_union", "J8 U1 J7", sql="""
SELECT c_custkey AS id, c_name AS nombre, c_acctbal AS saldo, c_nationkey AS nacion,
       CAST(NULL AS DOUBLE) AS precio, 'CLIENTE' AS fuente FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE), s_nationkey, CAST(NULL AS DOUBLE), 'PROVEEDOR' FROM supplier
UNION ALL
SELECT p_partkey, p_name, CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), p_retailprice, 'PARTE' FROM part
""")
def pad_and_align_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"),
                          F.col("c_acctbal").alias("saldo"), F.col("c_nationkey").alias("nacion"),
                          F.col("c_mktsegment").alias("extra"), F.lit("CLIENTE").alias("fuente"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"),
                          F.col("s_nationkey").alias("nacion"), F.lit("PROVEEDOR").alias("fuente"))
    c = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nombre"),
                      F.col("p_retailprice").alias("precio"), F.lit("PARTE").alias("fuente"))
    return union_all([align_to_schema(x, TARGET) for x in (a, b, c)])


@query("union_distinct", "U2 F13", sql="""
SELECT p_brand, p_type FROM part WHERE p_name LIKE '%ring%'
UNION
SELECT p_brand, p_type FROM part WHERE p_type LIKE 'SMALL%'
""")
def union_distinct_query(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    a = p.filter(F.col("p_name").like("%ring%")).select("p_brand", "p_type")
    b = p.filter(F.col("p_type").like("SMALL%")).select("p_brand", "p_type")
    return union_distinct(a, b)


@query("lookup_chain_people", "N12 X51 A1 X2", sql="""
WITH people AS (SELECT upper(regexp_replace(s_name, '^\\s+|\\s+$', '', 'g')) AS nombre, s_suppkey AS id_persona,
                       s_nationkey FROM supplier WHERE s_acctbal > 0),
     raw AS (SELECT '  supplier#' || printf('%09d', l_suppkey) || '\t' AS nombre_crudo FROM lineitem),
     clean AS (SELECT replace(replace(regexp_replace(regexp_replace(upper(nombre_crudo), '^\\s+|\\s+$', '', 'g'),
                       '[\\n\\r\\t]', '', 'g'), '  ', ''), '  ', '') AS nombre FROM raw)
SELECT DISTINCT c.nombre, p.id_persona, coalesce(n.n_name, 'NO APLICA') AS nacion
FROM clean c LEFT JOIN people p ON p.nombre = c.nombre
LEFT JOIN nation n ON n.n_nationkey = p.s_nationkey
""")
def lookup_chain_people(spark, sf_dir):
    t = Tables(spark, sf_dir)
    people = t.supplier.filter(F.col("s_acctbal") > 0).select(
        strip_upper("s_name").alias("nombre_dim"), F.col("s_suppkey").alias("id_persona"), "s_nationkey")
    raw = t.lineitem.select(F.concat(F.lit("  supplier#"), F.format_string("%09d", "l_suppkey"),
                                     F.lit("\t")).alias("nombre_crudo"))
    clean = raw.select(deep_clean("nombre_crudo").alias("nombre")).distinct()
    out = dims.lookup(clean, people, "nombre", "nombre_dim", {"id_persona": "id_persona", "s_nationkey": "__nk"})
    out = dims.lookup(out, t.nation, "__nk", "n_nationkey", {"n_name": "nacion"},
                      default={"nacion": NOT_APPLICABLE})
    return out.select("nombre", "id_persona", "nacion").distinct()


@query("contains_two_dimensions", "N16", sql="""
WITH probes AS (
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'ECONOM' WHEN s_acctbal < 3000 THEN 'brand#' || CAST(s_nationkey AS VARCHAR)
                         WHEN s_acctbal < 6000 THEN 'small' ELSE 'zz' END AS probe FROM supplier),
brands AS (SELECT DISTINCT p_brand AS name FROM part),
types AS (SELECT DISTINCT p_type AS name FROM part)
SELECT s_suppkey, probe,
  coalesce((SELECT min(name) FROM brands WHERE contains(lower(name), lower(probe))), 'NO APLICA') AS marca,
  coalesce((SELECT min(name) FROM types WHERE contains(lower(name), lower(probe))), 'NO APLICA') AS tipo,
  CASE WHEN EXISTS (SELECT 1 FROM brands WHERE contains(lower(name), lower(probe))) THEN probe ELSE 'NO APLICA' END AS marca_excl,
  CASE WHEN NOT EXISTS (SELECT 1 FROM brands WHERE contains(lower(name), lower(probe)))
        AND EXISTS (SELECT 1 FROM types WHERE contains(lower(name), lower(probe))) THEN probe ELSE 'NO APLICA' END AS tipo_excl
FROM probes
""")
def contains_two_dimensions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier
    probes = s.select("s_suppkey", F.when(F.col("s_acctbal") < 0, F.lit("ECONOM"))
                      .when(F.col("s_acctbal") < 3000, F.concat(F.lit("brand#"), F.col("s_nationkey").cast("string")))
                      .when(F.col("s_acctbal") < 6000, F.lit("small")).otherwise(F.lit("zz")).alias("probe"))
    brands = t.part.select(F.col("p_brand").alias("name")).distinct()
    types = t.part.select(F.col("p_type").alias("name")).distinct()
    ind = dims.contains_match_two(probes, "probe", (brands, "name", ["name"]), (types, "name", ["name"]),
                                  "marca", "tipo", exclusive=False, default=NOT_APPLICABLE)
    exc = dims.contains_match_two(probes, "probe", (brands, "name", ["name"]), (types, "name", ["name"]),
                                  "marca_excl", "tipo_excl", exclusive=True, default=NOT_APPLICABLE,
                                  return_probe=True)
    return ind.join(exc.drop("probe"), "s_suppkey")
