"""Lifecycle queries: soft delete, state updates, versions, profile, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import lifecycle as L
from ledgerline.operators.profile import column_profile
from ledgerline.operators.setops import union_all
from ledgerline.plans.catalog import Tables
from ledgerline.plans import q_jobs  # noqa: F401  (registers job_order_loader first)
from ledgerline.plans.registry import REGISTRY, query


@query("soft_delete_append", "C5", sql="""
SELECT o_orderkey, 1 AS carga, 4 AS id_estado FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, 2 AS carga, 1 AS id_estado FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""")
def soft_delete_append(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    first = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
             .select("o_orderkey", F.lit(1).alias("carga"), F.lit(1).alias("id_estado"))
    second = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
              .select("o_orderkey", F.lit(2).alias("carga"))
    return L.soft_delete_append(first, second).select("o_orderkey", "carga", "id_estado")


@query("targeted_state_update", "C6 C7", sql="""
WITH base AS (SELECT s_suppkey, s_name, CASE WHEN s_nationkey = 0 THEN 4 ELSE 1 END AS id_estado FROM supplier),
     vac AS (SELECT s_name FROM supplier WHERE s_acctbal < 1000)
SELECT s_suppkey, CASE WHEN s_name IN (SELECT s_name FROM vac) AND id_estado IS DISTINCT FROM 4 THEN 4
                       ELSE id_estado END AS id_estado
FROM base
""")
def targeted_state_update(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    base = s.select("s_suppkey", "s_name",
                    F.when(F.col("s_nationkey") == 0, F.lit(4)).otherwise(F.lit(1)).alias("id_estado"))
    vacated = s.filter(F.col("s_acctbal") < 1000).select("s_name")
    return L.targeted_state_update(base, vacated, ["s_name"], 4, skip_if=4).select("s_suppkey", "id_estado")


@query("version_snapshot", "C8 N24", sql="""
WITH snaps AS (
  SELECT p_partkey, p_type AS fuente, 1 AS version, p_retailprice AS precio FROM part
  UNION ALL
  SELECT p_partkey, p_type, 2, p_retailprice * 2 FROM part WHERE p_type IN ('SMALL', 'LARGE'))
SELECT s.* FROM snaps s
WHERE s.version = (SELECT max(version) FROM snaps m WHERE m.fuente = s.fuente)
""")
def version_snapshot(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    v1 = p.select("p_partkey", F.col("p_type").alias("fuente"), F.lit(1).alias("version"),
                  F.col("p_retailprice").alias("precio"))
    nxt = L.next_version(v1)  # C8: max + 1
    v2 = p.filter(F.col("p_type").isin("SMALL", "LARGE")).select(
        "p_partkey", F.col("p_type").alias("fuente"), F.lit(nxt).alias("version"),
        (F.col("p_retailprice") * 2).alias("precio"))
    return L.latest_version(union_all([v1, v2]), "version", per=["fuente"])


PROFILE_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("profile_counts", "A5 A7 A8", sql="""
WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name, c_nationkey,
                  c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, count(*) AS filas, count({c}) AS no_nulos, "
    f"count(DISTINCT CAST({c} AS VARCHAR)) AS distintos FROM t" for c in PROFILE_COLS))
def profile_counts(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    t = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_name")).alias("c_name"),
                 "c_nationkey", "c_acctbal", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"))
    return column_profile(t, PROFILE_COLS)


def _audit_sql():
    return ("WITH loaded AS (" + REGISTRY["job_order_loader"].sql + ")\n"
            "SELECT id_ejecucion, fuente, count(*) AS cantidad_registros FROM loaded GROUP BY 1, 2")


@query("audit_row", "C2 C3", sql=None)
def audit_row(spark, sf_dir):
    loaded = REGISTRY["job_order_loader"].build(spark, sf_dir)
    return L.audit_counts(loaded)


REGISTRY["audit_row"].sql = _audit_sql()
