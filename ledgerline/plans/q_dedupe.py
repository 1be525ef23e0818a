"""De-duplication, ranking, numbering, group fill and domain queries
(A1-A4, N6, W1-W6, O4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.dates import month_abbrev
from ledgerline.functions.text import deep_clean
from ledgerline.operators import dedupe as dd
from ledgerline.operators.dims import assign_ids, domain_candidates, new_domain_values
from ledgerline.operators.fill import group_fill
from ledgerline.operators.numbering import number_rows
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query

LINE_ORDER_SQL = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                  "l_returnflag, l_linestatus, l_shipdate")


@query("dedupe_keep_first", "A2 P10", sql=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_keep_first(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return dd.keep_first(li, ["l_orderkey", "l_linenumber"], [])


@query("dedupe_keep_lowest_state", "A3 O2", sql="""
SELECT p_name, p_partkey, p_size, p_brand FROM (
  SELECT p_name, p_partkey, p_size, p_brand,
         row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) AS rn
  FROM part) WHERE rn = 1
""")
def dedupe_keep_lowest_state(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_name", "p_partkey", "p_size", "p_brand")
    return dd.keep_first(p, ["p_name"], ["p_size", "p_partkey"])


@query("latest_preferred_row", "W1 O4", sql="""
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END,
                                     o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
""")
def latest_preferred_row(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    pref = F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
    return dd.keep_first(o, ["o_custkey"], [pref.asc(), F.col("o_orderdate").desc_nulls_last(),
                                            F.col("o_orderkey").asc()], total=False)


@query("duplicate_ordinal", "W2 O1", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS ordinal
FROM lineitem
""")
def duplicate_ordinal(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = dd.duplicate_ordinal(li, ["l_orderkey", "l_linenumber"], [], name="ordinal")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "ordinal")


@query("duplicate_flag", "W3", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicado
FROM lineitem
""")
def duplicate_flag(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return dd.duplicate_flag(li, ["l_orderkey", "l_linenumber"], "duplicado")


GROUP_FILL_BASE = """
SELECT user_id, event_id,
       CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type
FROM events"""


@query("group_fill", "W4 P5 A1", sql=f"""
WITH base AS ({GROUP_FILL_BASE})
SELECT DISTINCT user_id,
  coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value,
  coalesce(last_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS event_type
FROM base WHERE user_id IS NOT NULL
""")
def group_fill_query(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    base = e.select(
        "user_id", "event_id",
        F.when(F.col("event_type").isin("view", "click"), F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))
    filled = group_fill(base, "user_id", ["event_id"], ["value", "event_type"], distinct=False)
    return filled.select("user_id", "value", "event_type").distinct()


@query("sequence_number", "W5", sql="""
SELECT o_orderkey,
  'ALT-' || ['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC'][month(o_orderdate)]
  || strftime(o_orderdate, '%y') || '-'
  || printf('%08d', row_number() OVER (PARTITION BY date_trunc('month', o_orderdate)
                                       ORDER BY o_orderdate, o_orderkey)) AS consecutivo
FROM orders
""")
def sequence_number(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate") \
        .withColumn("__month", F.trunc(F.col("o_orderdate").cast("date"), "MM"))
    numbered = number_rows(o, ["o_orderdate", "o_orderkey"], group=["__month"], name="__n")
    label = F.concat(F.lit("ALT-"), month_abbrev(F.month("o_orderdate")),
                     F.date_format("o_orderdate", "yy"), F.lit("-"),
                     F.format_string("%08d", "__n"))
    return numbered.select("o_orderkey", label.alias("consecutivo"))


DOMAIN_SQL = """
WITH cand AS (
  SELECT DISTINCT dominio, valor FROM (
    SELECT 'p_brand' AS dominio, upper(regexp_replace(p_brand, '^\\s+|\\s+$', '', 'g')) AS valor FROM part
    UNION ALL SELECT 'p_type', upper(regexp_replace(p_type, '^\\s+|\\s+$', '', 'g')) FROM part
    UNION ALL SELECT 'c_mktsegment', upper(regexp_replace(c_mktsegment, '^\\s+|\\s+$', '', 'g')) FROM customer)
  WHERE valor IS NOT NULL AND valor <> '' AND valor <> 'NO APLICA')"""


def _candidates(spark, sf_dir):
    t = Tables(spark, sf_dir)
    part = domain_candidates(t.part, ["p_brand", "p_type"], clean=deep_clean)
    cust = domain_candidates(t.customer, ["c_mktsegment"], clean=deep_clean)
    return part.unionByName(cust).distinct()


def _existing(cands):
    # Domain rows already loaded: values sorting before 'M', ids with gaps of 10.
    from pyspark.sql import Window
    w = Window.partitionBy("dominio").orderBy("valor")
    return cands.filter(F.col("valor") < "M").withColumn("id", (F.row_number().over(w) * 10).cast("bigint"))


@query("dim_candidates", "A4 X2 P6", sql=DOMAIN_SQL + " SELECT dominio, valor FROM cand")
def dim_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query("dim_new_ids", "N6 W6 C10", sql=DOMAIN_SQL + """,
existing AS (SELECT dominio, valor, row_number() OVER (PARTITION BY dominio ORDER BY valor) * 10 AS id
             FROM cand WHERE valor < 'M'),
fresh AS (SELECT c.* FROM cand c WHERE NOT EXISTS (
             SELECT 1 FROM existing e WHERE e.dominio = c.dominio AND e.valor = c.valor))
SELECT f.dominio, f.valor,
       CAST(coalesce((SELECT max(id) FROM existing e WHERE e.dominio = f.dominio), 0)
            + row_number() OVER (PARTITION BY f.dominio ORDER BY f.valor) AS BIGINT) AS id
FROM fresh f
""")
def dim_new_ids(spark, sf_dir):
    cands = _candidates(spark, sf_dir)
    existing = _existing(cands)
    fresh = new_domain_values(cands, existing)
    return assign_ids(fresh, existing, "id", "valor", group=["dominio"])
