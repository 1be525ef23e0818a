"""Scalar-function queries: text cleaning, values, numbers, CASE.

Oracle note: pandas/Java ``upper`` maps 'ß' to 'SS' while DuckDB keeps
'ß', so the oracles that upper-case free text spell that mapping out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import keys as K
from ledgerline.functions import numbers as N
from ledgerline.functions import text as T
from ledgerline.functions import values as V
from ledgerline.functions.constants import UNASSIGNED_SPELLINGS
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _upper(x: str) -> str:
    return f"upper(replace({x}, 'ß', 'SS'))"


def _deep(x: str) -> str:
    return (f"replace(regexp_replace({_strip(_upper(x))}, '[\\n\\r\\t]', '', 'g'), '  ', '')")


def _deep_sql(x: str) -> str:
    # '  ' -> '' applied left to right once over the string (Java/pandas replace).
    return f"regexp_replace(regexp_replace({_strip(_upper(x))}, '[\\n\\r\\t]', '', 'g'), '  ', '', 'g')"


INJECT_SQL = "chr(9) || ' ' || replace(text, '. ', '.   ') || '  ' || chr(10)"


@query("clean_text_deep", "X2 X3 P7 P8", sql=f"""
WITH d AS (SELECT doc_id, {INJECT_SQL} AS crudo FROM documents)
SELECT doc_id, {_deep_sql('crudo')} AS limpio,
       {_strip(_upper("regexp_replace(crudo, '[|.*}$@]', '', 'g')"))} AS sin_especiales
FROM d
""")
def clean_text_deep(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    crudo = F.concat(F.lit("\t "), F.replace(F.col("text"), F.lit(". "), F.lit(".   ")), F.lit("  \n"))
    d = d.select("doc_id", crudo.alias("crudo"))
    return d.select("doc_id", T.deep_clean("crudo").alias("limpio"),
                    T.remove_special("crudo").alias("sin_especiales"))


@query("strip_upper_all", "X1", sql=f"""
SELECT c_custkey, {_strip(_upper('c_name'))} AS c_name, c_nationkey, c_acctbal,
       {_strip(_upper("lower(c_mktsegment) || chr(9)"))} AS c_mktsegment
FROM customer
""")
def strip_upper_all(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.withColumn(
        "c_mktsegment", F.concat(F.lower("c_mktsegment"), F.lit("\t")))
    return T.clean_all_strings(c, T.strip_upper)


PRIORITY_MAP = {"1-URGENT": "URGENTE", "2-HIGH": "ALTA"}


@query("normalise_values", "X22 X23 X24 X25", sql=f"""
SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENTE' WHEN '2-HIGH' THEN 'ALTA' ELSE o_orderpriority END AS prioridad,
  CASE WHEN regexp_replace({_strip("CASE WHEN o_orderpriority LIKE '4%' THEN 'SIN ASIGNACION' || chr(10) ELSE o_orderpriority END")}, '[\\n\\r\\t]+', '', 'g')
            IN ({", ".join(_sq(s) for s in UNASSIGNED_SPELLINGS)})
       THEN 'OTROS'
       ELSE regexp_replace({_strip("CASE WHEN o_orderpriority LIKE '4%' THEN 'SIN ASIGNACION' || chr(10) ELSE o_orderpriority END")}, '[\\n\\r\\t]+', '', 'g') END AS gerencia,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'NO' END AS estado_valido,
  CASE WHEN o_orderstatus IN ('P') THEN NULL ELSE o_orderstatus END AS estado_sin_centinela
FROM orders
""")
def normalise_values(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = F.when(F.col("o_orderpriority").like("4%"), F.lit("SIN ASIGNACION\n")).otherwise(F.col("o_orderpriority"))
    return o.select(
        "o_orderkey",
        V.replace_values("o_orderpriority", PRIORITY_MAP).alias("prioridad"),
        V.normalise_unassigned(raw, UNASSIGNED_SPELLINGS).alias("gerencia"),
        V.keep_if_in("o_orderstatus", ["F", "O"], "NO").alias("estado_valido"),
        V.null_if_in("o_orderstatus", ["P"]).alias("estado_sin_centinela"))


@query("value_replace", "X22", sql="""
WITH p AS (SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS marca FROM part)
SELECT p_partkey,
  CASE WHEN marca IS NULL THEN 'SIN MARCA' WHEN marca = 'Brand#1' THEN 'MARCA UNO'
       WHEN marca = 'Brand#2' THEN 'MARCA DOS' ELSE marca END AS marca
FROM p
""")
def value_replace(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("marca"))
    return p.select("p_partkey", V.replace_values("marca", {"Brand#1": "MARCA UNO", "Brand#2": "MARCA DOS"},
                                                  null_to="SIN MARCA").alias("marca"))


@query("truncate_and_right", "X7 X8 X9", sql=f"""
SELECT c_custkey, substring(c_name, 1, 10) AS nombre_corto, right(c_name, 8) AS codigo,
       right(CAST(c_custkey * 1000003 AS VARCHAR), 8) AS codigo_id,
       string_split_regex({_strip("chr(9) || c_mktsegment || '  ' || c_name")}, '\\s+')[1] AS primer_token,
       substring(c_mktsegment, 1, 2) AS seg2
FROM customer
""")
def truncate_and_right(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", T.truncate("c_name", 10).alias("nombre_corto"),
                    T.rightmost("c_name", 8).alias("codigo"),
                    T.rightmost(F.col("c_custkey") * 1000003, 8).alias("codigo_id"),
                    T.first_token(F.concat(F.lit("\t"), F.col("c_mktsegment"), F.lit("  "), F.col("c_name")))
                     .alias("primer_token"),
                    T.truncate("c_mktsegment", 2).alias("seg2"))


@query("substr_position_translate", "X10 X11", sql="""
SELECT o_orderkey,
  substring(o_orderpriority || ' - ' || o_orderstatus || 'XY',
            position(' - ' IN o_orderpriority || ' - ' || o_orderstatus || 'XY') + 2, 3) AS codigo,
  substring(o_orderpriority, position(' - ' IN o_orderpriority) + 2, 3) AS sin_guion
FROM orders
""")
def substr_position_translate(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    x = F.concat(F.col("o_orderpriority"), F.lit(" - "), F.col("o_orderstatus"), F.lit("XY"))
    return o.select("o_orderkey", T.after_dash_code(x).alias("codigo"),
                    T.after_dash_code("o_orderpriority").alias("sin_guion"))


@query("translate_accents", "X11", sql="""
SELECT doc_id, translate(text, 'áéíóú', 'aeiou') AS texto FROM documents
""")
def translate_accents(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", T.strip_accents_lower("text").alias("texto"))


@query("document_fixup", "X15 X19", sql="""
WITH k AS (SELECT c_custkey,
             CASE WHEN c_acctbal < 0 THEN CAST(c_custkey + 100000000 AS VARCHAR)
                  WHEN c_acctbal < 5000 THEN CAST(c_custkey * 1000003 + 10000000000 AS VARCHAR)
                  ELSE CAST(c_custkey + 200000000 AS VARCHAR) END AS doc,
             CAST(round(c_acctbal * 1000000) AS BIGINT) AS grande
           FROM customer)
SELECT c_custkey,
  CASE WHEN length(doc) IN (9, 11) AND starts_with(doc, '1') THEN substring(doc, 2) ELSE doc END AS documento,
  CASE WHEN grande > 2147483647 THEN -2147483648 ELSE grande END AS valor_int
FROM k
""")
def document_fixup(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    doc = (F.when(F.col("c_acctbal") < 0, (F.col("c_custkey") + 100000000).cast("string"))
            .when(F.col("c_acctbal") < 5000, (F.col("c_custkey") * 1000003 + 10000000000).cast("string"))
            .otherwise((F.col("c_custkey") + 200000000).cast("string")))
    grande = F.round(F.col("c_acctbal") * 1000000).cast("bigint")
    return c.select("c_custkey", T.fix_document(doc).alias("documento"),
                    N.clamp_int32(grande).alias("valor_int"))


NUM_TEXT_SQL = """CASE l_returnflag WHEN 'R' THEN 'v' || CAST(l_extendedprice AS VARCHAR)
                          WHEN 'A' THEN CAST(CAST(trunc(l_extendedprice) AS BIGINT) AS VARCHAR)
                          ELSE CAST(l_extendedprice AS VARCHAR) END"""


@query("numeric_coerce_scale", "X16 X17 X18", sql=f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {NUM_TEXT_SQL} AS txt FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, txt,
  CAST(CASE WHEN regexp_full_match(txt, '[0-9]+') THEN coalesce(TRY_CAST(txt AS BIGINT), 0) ELSE 0 END AS BIGINT) AS solo_digitos,
  coalesce(CAST(trunc(TRY_CAST(txt AS DOUBLE)) AS BIGINT), 0) AS entero,
  CAST(round_even(coalesce(TRY_CAST(txt AS DOUBLE), 0) / 1000.0, 2) AS DOUBLE) AS miles
FROM t
""")
def numeric_coerce_scale(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    txt = (F.when(F.col("l_returnflag") == "R", F.concat(F.lit("v"), F.col("l_extendedprice").cast("string")))
            .when(F.col("l_returnflag") == "A", F.col("l_extendedprice").cast("bigint").cast("string"))
            .otherwise(F.col("l_extendedprice").cast("string")))
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", txt.alias("txt"))
    return t.select("*", N.digits_or_zero("txt").alias("solo_digitos"),
                    N.coerce_number("txt", "bigint").alias("entero"),
                    N.scale_thousands("txt").alias("miles"))


@query("fill_by_map", "X20 X21", sql="""
WITH n AS (SELECT l_orderkey, l_linenumber,
             nullif(l_returnflag, 'N') AS flag,
             CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS qty,
             CASE WHEN l_tax = 0 THEN NULL ELSE l_linenumber END AS linea,
             CASE WHEN l_discount = 0 THEN NULL ELSE l_shipdate END AS envio
           FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(flag, 'NR') AS flag, coalesce(qty, 0) AS qty,
       coalesce(linea, 0) AS linea, coalesce(envio, TIMESTAMP '1900-01-01 00:00:00') AS envio
FROM n
""")
def fill_by_map_query(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    n = li.select("l_orderkey", "l_linenumber",
                  F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
                  F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.col("l_quantity")).alias("qty"),
                  F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_linenumber")).alias("linea"),
                  F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_shipdate")).alias("envio"))
    n = V.fill_by_map(n, {"flag": "NR", "envio": "1900-01-01 00:00:00"})
    return V.fill_all(n, number=0, text="0")


@query("vacancy_state", "X13 X14", sql=f"""
WITH n AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name || ' (VACANTE)'
                                  WHEN c_acctbal > 9000 THEN '(VACANTA) ' || c_name
                                  ELSE c_name END AS nombre FROM customer)
SELECT c_custkey,
  CASE WHEN contains(nombre, '(VACANTE)') THEN 4 ELSE 1 END AS id_estado,
  {_strip("regexp_replace(nombre, '\\(VACANT[EA]\\)', '', 'g')")} AS nombre
FROM n
""")
def vacancy_state_query(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    nombre = (F.when(F.col("c_acctbal") < 0, F.concat(F.col("c_name"), F.lit(" (VACANTE)")))
               .when(F.col("c_acctbal") > 9000, F.concat(F.lit("(VACANTA) "), F.col("c_name")))
               .otherwise(F.col("c_name")))
    n = c.select("c_custkey", nombre.alias("nombre"))
    # X14 is evaluated before X13 removes the marker.
    return n.select("c_custkey", T.vacancy_state("nombre", F.lit(1)).alias("id_estado"),
                    T.remove_vacancy_marker("nombre").alias("nombre"))


@query("text_repairs", "X4 X5 X6 X12 X49", sql="""
WITH t AS (SELECT c_custkey,
             lower(replace(c_name, '#', '.')) || '@correo.com' || CASE WHEN c_acctbal < 0 THEN '..' ELSE '' END AS email,
             '$$' || CAST(c_nationkey AS VARCHAR) AS monto,
             c_name || ' ' || c_mktsegment AS texto FROM customer)
SELECT c_custkey, regexp_replace(email, '\\.+$', '') AS email,
       regexp_replace(email, '\\.+', '', 'g') AS sin_puntos,
       regexp_replace(monto, '^\\$+', '') AS monto,
       upper(replace(replace(texto, 'Customer', 'Cliente'), '#', 'Nº')) AS texto
FROM t
""")
def text_repairs(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    email = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@correo.com"),
                     F.when(F.col("c_acctbal") < 0, F.lit("..")).otherwise(F.lit("")))
    t = c.select("c_custkey", email.alias("email"),
                 F.concat(F.lit("$$"), F.col("c_nationkey").cast("string")).alias("monto"),
                 F.concat_ws(" ", "c_name", "c_mktsegment").alias("texto"))
    return t.select("c_custkey", T.trim_trailing_dots("email").alias("email"),
                    T.remove_dots("email").alias("sin_puntos"),
                    T.lstrip_char("monto", "$").alias("monto"),
                    F.upper(T.replace_map("texto", {"Customer": "Cliente", "#": "Nº"})).alias("texto"))


@query("key_text_formats", "X41 X42 X43 X47", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS qty,
             CASE WHEN l_tax = 0 THEN NULL ELSE l_returnflag END AS flag,
             CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_discount AS VARCHAR) END AS descuento_txt
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
  coalesce(CAST(CAST(trunc(qty) AS BIGINT) AS VARCHAR), '') AS qty_txt,
  concat_ws('-', CAST(l_orderkey AS VARCHAR), coalesce(CAST(CAST(trunc(qty) AS BIGINT) AS VARCHAR), ''),
            coalesce(flag, '')) AS llave,
  CASE WHEN flag IS NULL THEN NULL ELSE CAST(l_orderkey AS VARCHAR) || flag END AS llave_estricta,
  coalesce(TRY_CAST(CASE WHEN trim(descuento_txt) = '' THEN NULL ELSE descuento_txt END AS DOUBLE), 0.0) AS descuento,
  coalesce(flag, '') AS flag
FROM t
""")
def key_text_formats(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    t = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.col("l_quantity")).alias("qty"),
                  F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
                  F.when(F.col("l_discount") == 0, F.lit("")).otherwise(F.col("l_discount").cast("string"))
                   .alias("descuento"))
    out = t.select("l_orderkey", "l_linenumber",
                   K.int_text("qty").alias("qty_txt"),
                   K.concat_blank_nulls(K.id_text("l_orderkey"), K.int_text("qty"), "flag").alias("llave"),
                   K.concat_strict(K.id_text("l_orderkey"), "flag").alias("llave_estricta"),
                   "descuento", "flag")
    return N.fill_blank_then_zero(out, ["descuento"], text_blank=["flag"])


@query("json_list_and_type_map", "X45 X46 S19", sql="""
WITH t AS (SELECT o_orderkey,
             '[''' || o_orderstatus || ''', ''' || o_orderpriority || ''']' AS lista,
             regexp_extract(CAST(o_totalprice AS VARCHAR), '^[0-9]+', 0) AS total_txt,
             CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS cliente_txt
           FROM orders)
SELECT o_orderkey, list_contains(CAST(json(replace(lista, '''', '"')) AS VARCHAR[]), 'F') AS tiene_f,
       len(CAST(json(replace(lista, '''', '"')) AS VARCHAR[])) AS n_items,
       coalesce(CAST(trunc(TRY_CAST(total_txt AS DOUBLE)) AS INTEGER), 0) AS total,
       coalesce(CAST(trunc(TRY_CAST(cliente_txt AS DOUBLE)) AS BIGINT), 0) AS cliente
FROM t
""")
def json_list_and_type_map(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t = o.select("o_orderkey",
                 F.concat(F.lit("['"), F.col("o_orderstatus"), F.lit("', '"), F.col("o_orderpriority"),
                          F.lit("']")).alias("lista"),
                 F.regexp_extract(F.col("o_totalprice").cast("string"), "^[0-9]+", 0).alias("total"),
                 F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
                  .otherwise(F.col("o_custkey").cast("string")).alias("cliente"))
    arr = V.list_literal_to_array("lista")
    t = t.select("o_orderkey", F.array_contains(arr, "F").alias("tiene_f"),
                 F.size(arr).cast("bigint").alias("n_items"), "total", "cliente")
    return N.coerce_by_type_map(t, {"total": "int", "cliente": "bigint"})


@query("fill_from_other_column", "X48 X33 X51", sql="""
WITH t AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segmento,
             CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_name END AS nombre,
             CASE WHEN c_acctbal < 0 THEN 'Vacante ' || CAST(c_custkey AS VARCHAR)
                  WHEN c_acctbal < 500 THEN NULL
                  ELSE CAST(c_custkey AS VARCHAR) || ' 0' END AS cc
           FROM customer)
SELECT c_custkey, coalesce(segmento, nombre, 'SIN ASIGNACION') AS asignado,
       coalesce(nombre, 'NO APLICA') AS nombre,
       CASE WHEN contains(lower(replace(coalesce(cc, '11'), ' ', '')), 'vacante')
                 OR contains(lower(nombre), 'vacante') THEN '11'
            ELSE replace(coalesce(cc, '11'), ' ', '') END AS cc
FROM t
""")
def fill_from_other_column(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    t = c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segmento"),
                 F.when(F.col("c_acctbal") < 1000, F.lit(None)).otherwise(F.col("c_name")).alias("nombre"),
                 F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Vacante "), F.col("c_custkey").cast("string")))
                  .when(F.col("c_acctbal") < 500, F.lit(None))
                  .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(" 0"))).alias("cc"))
    return t.select("c_custkey", V.fill_from("segmento", "nombre").alias("asignado"),
                    V.fill_not_applicable("nombre").alias("nombre"),
                    V.vacancy_document("cc", "nombre").alias("cc"))


@query("case_and_flags", "X26 X27 X28 X30 X31", sql="""
WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, l_discount,
             CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'UP SELLING' ELSE 'OTRO' END AS categoria,
             CASE WHEN l_quantity < 5 THEN 'Persona (VACANTE)' ELSE 'Persona' END AS nombre,
             CASE WHEN l_quantity > 48 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS doc,
             CASE WHEN l_tax = 0 THEN '' ELSE 'ACTIVO' END AS estado
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
  NOT (l_returnflag IS NOT DISTINCT FROM 'N') AS no_es_n,
  CASE WHEN l_returnflag = 'R' THEN 'DEVUELTO' WHEN l_returnflag = 'A' THEN 'ACEPTADO' ELSE 'NORMAL' END AS etiqueta,
  l_extendedprice - l_extendedprice * l_discount AS neto,
  CASE WHEN (CASE WHEN categoria = 'A' THEN 'CROSS SELLING' ELSE categoria END) IN ('NEW', 'CROSS SELLING')
            THEN l_extendedprice
       WHEN (CASE WHEN categoria = 'A' THEN 'CROSS SELLING' ELSE categoria END) = 'UP SELLING'
            THEN l_extendedprice * l_discount END AS valor_neto,
  coalesce(nullif(CASE WHEN contains(nombre, '(VACANTE)') OR doc IS NULL OR doc = 'None' THEN 'INACTIVO'
                       ELSE estado END, ''), 'PENDIENTE_ESTADO') AS estado_consultor
FROM t
""")
def case_and_flags(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    t = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount",
                  F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "R", "UP SELLING")
                   .otherwise("OTRO").alias("categoria"),
                  F.when(F.col("l_quantity") < 5, F.lit("Persona (VACANTE)")).otherwise(F.lit("Persona")).alias("nombre"),
                  F.when(F.col("l_quantity") > 48, F.lit(None)).otherwise(F.col("l_suppkey").cast("string")).alias("doc"),
                  F.when(F.col("l_tax") == 0, F.lit("")).otherwise(F.lit("ACTIVO")).alias("estado"))
    neto = F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount")
    etiqueta = (F.when(F.col("l_returnflag") == "R", "DEVUELTO").when(F.col("l_returnflag") == "A", "ACEPTADO")
                 .otherwise("NORMAL"))
    return t.select("l_orderkey", "l_linenumber",
                    V.differs_from("l_returnflag", "N").alias("no_es_n"),
                    etiqueta.alias("etiqueta"), neto.alias("neto"),
                    V.net_value("categoria", "l_extendedprice",
                                F.col("l_extendedprice") * F.col("l_discount")).alias("valor_neto"),
                    V.consultant_state("nombre", "doc", "estado").alias("estado_consultor"))
