"""Incremental-load queries: N1-N10, C9, U3, U4 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.predicates import positive_amount
from ledgerline.operators import incremental as inc
from ledgerline.operators.setops import key_difference, union_all
from ledgerline.plans.catalog import Tables
from ledgerline.plans.registry import query

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_OUT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_discount", "l_returnflag", "l_shipdate"]


@query("new_rows_composite_key", "N1 F1 F2", sql="""
SELECT b.l_orderkey, b.l_partkey, b.l_suppkey, b.l_linenumber, b.l_quantity,
       b.l_discount, b.l_returnflag, b.l_shipdate
FROM lineitem b
WHERE b.l_shipdate >= TIMESTAMP '1997-01-01' AND coalesce(b.l_discount, 0) > 0
  AND NOT EXISTS (
    SELECT 1 FROM lineitem h
    WHERE h.l_shipdate < TIMESTAMP '1998-01-01' AND coalesce(h.l_discount, 0) > 0
      AND h.l_orderkey IS NOT DISTINCT FROM b.l_orderkey
      AND h.l_partkey IS NOT DISTINCT FROM b.l_partkey
      AND h.l_suppkey IS NOT DISTINCT FROM b.l_suppkey
      AND h.l_linenumber IS NOT DISTINCT FROM b.l_linenumber)
""")
def new_rows_composite_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem
    batch = li.filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
              .filter(positive_amount("l_discount")).select(*LINE_OUT)
    # the history read carries the same amount filter, pushed to the scan.
    history = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
                .filter(positive_amount("l_discount"))
    return inc.new_rows(batch, history, LINE_KEY)


@query("new_rows_single_key", "N2", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders b
WHERE o_orderdate >= TIMESTAMP '1999-01-01'
  AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
""")
def new_rows_single_key(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    batch = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
             .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    history = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return inc.new_rows(batch, history, ["o_orderkey"])


@query("new_rows_by_day", "N5", sql="""
SELECT event_id, ts, user_id, event_type, value
FROM events
WHERE ts >= TIMESTAMP '2024-01-10'
  AND CAST(ts AS DATE) NOT IN (
    SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE ts < TIMESTAMP '2024-01-20')
""")
def new_rows_by_day(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    batch = e.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) \
             .select("event_id", "ts", "user_id", "event_type", "value")
    history = e.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return inc.new_rows_by_day(batch, history, "ts")


@query("new_rows_null_keys", "P1 N1", sql="""
WITH b AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag, l_quantity, l_shipdate
           FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'),
     h AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM h WHERE h.l_orderkey IS NOT DISTINCT FROM b.l_orderkey
    AND h.l_linenumber IS NOT DISTINCT FROM b.l_linenumber
    AND h.flag IS NOT DISTINCT FROM b.flag)
""")
def new_rows_null_keys(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    batch = li.filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
              .select("l_orderkey", "l_linenumber", "flag", "l_quantity", "l_shipdate")
    history = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return inc.new_rows(batch, history, ["l_orderkey", "l_linenumber", "flag"])


@query("new_and_existing_split", "N8", sql="""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
     h AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT b.*, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.o_orderkey = b.o_orderkey)
                 THEN 'EXISTENTE' ELSE 'NUEVO' END AS estado_cruce
FROM b
""")
def new_and_existing_split(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    batch = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
             .select("o_orderkey", "o_custkey", "o_orderdate")
    history = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return inc.split_new_existing(batch, history, ["o_orderkey"])


@query("semi_by_id_set", "N9 U4", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
""")
def semi_by_id_set(spark, sf_dir):
    t = Tables(spark, sf_dir)
    big = t.lineitem.filter(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("o_orderkey"))
    return inc.existing_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), big,
                             ["o_orderkey"])


@query("key_set_difference", "U3", sql="""
SELECT c_custkey FROM customer
EXCEPT
SELECT o_custkey AS c_custkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
""")
def key_set_difference(spark, sf_dir):
    t = Tables(spark, sf_dir)
    active = t.orders.filter((F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
                             & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))) \
                     .select(F.col("o_custkey").alias("c_custkey"))
    return key_difference(t.customer.select("c_custkey"), active)


@query("key_set_intersection", "U4 N9", sql="""
SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
INTERSECT
SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'O'
""")
def key_set_intersection(spark, sf_dir):
    from ledgerline.operators.setops import key_intersection
    o = Tables(spark, sf_dir).orders
    f = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("custkey"))
    op = o.filter(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("custkey"))
    return key_intersection(f, op)


@query("new_rows_five_columns", "N3 N4 N7", sql="""
WITH b AS (SELECT p_partkey, p_name, p_brand, p_type, p_size,
                  CASE WHEN p_retailprice > 1500 THEN NULL ELSE p_retailprice END AS price
           FROM part WHERE p_size >= 20),
     h AS (SELECT p_partkey, p_name, p_brand, p_type, p_size,
                  CASE WHEN p_retailprice > 1500 THEN NULL ELSE p_retailprice END AS price
           FROM part WHERE p_size < 30),
     five AS (SELECT 5 AS key_width, b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM h
        WHERE h.p_name IS NOT DISTINCT FROM b.p_name AND h.p_brand IS NOT DISTINCT FROM b.p_brand
          AND h.p_type IS NOT DISTINCT FROM b.p_type AND h.p_size IS NOT DISTINCT FROM b.p_size
          AND h.price IS NOT DISTINCT FROM b.price)),
     two AS (SELECT 2 AS key_width, b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM h
        WHERE h.p_brand IS NOT DISTINCT FROM b.p_brand AND h.p_type IS NOT DISTINCT FROM b.p_type)),
     one AS (SELECT 1 AS key_width, b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM h
        WHERE h.p_name IS NOT DISTINCT FROM b.p_name))
SELECT * FROM five UNION ALL SELECT * FROM two UNION ALL SELECT * FROM one
""")
def new_rows_five_columns(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        F.when(F.col("p_retailprice") > 1500, F.lit(None)).otherwise(F.col("p_retailprice")).alias("price"))
    batch = p.filter(F.col("p_size") >= 20)
    history = p.filter(F.col("p_size") < 30)
    parts = []
    for width, keys in ((5, ["p_name", "p_brand", "p_type", "p_size", "price"]),
                        (2, ["p_brand", "p_type"]),
                        (1, ["p_name"])):
        parts.append(inc.new_rows(batch, history, keys)
                     .select(F.lit(width).alias("key_width"), *batch.columns))
    return union_all(parts)


@query("watermark_increment", "C9 F17 A6", sql="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
""")
def watermark_increment(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    target = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    source = o.select("o_orderkey", "o_orderdate", "o_totalprice")
    return inc.watermark_increment(source, target, "o_orderdate")
