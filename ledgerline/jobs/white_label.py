"""White-label churn vs. additions for one period.

Both sides are built from the same package table: churn rows were
deactivated in the period (and activated outside it), additions were
activated in it and are still active.  Each side is de-duplicated per
service (keep first after the package sort, all members flagged), tagged
with the company segment, and flagged when the other side holds the same
(nit, line, package, value).  Period, value threshold and excluded
services come from the business-rules table, not from code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_to_excel_serial
from ledgerline.functions.keys import int_text
from ledgerline.functions.predicates import in_period, not_in_keep_null
from ledgerline.functions.values import period_by_type
from ledgerline.operators.dedupe import keep_first_counted
from ledgerline.operators.incremental import membership_flag
from ledgerline.operators.setops import union_all
from ledgerline.operators.staging import staged


@dataclass
class WhiteLabelRules:
    period: str                 # 'yyyy-MM'
    min_value: float            # valor_paq must exceed this
    excluded: list[str]         # excluded services (null is never excluded)


MATCH_KEY = ["nit", "tel_num", "__paq_txt", "valor_paq"]
SORT = ["co_id", "tel_num", "cod_paq_instalado"]


def _side(rows: DataFrame, kind: str, serial: Column, rules: WhiteLabelRules,
          other: DataFrame, companies: DataFrame) -> DataFrame:
    df = rows.withColumn("fecha_excel", serial).withColumn("__paq_txt", int_text("cod_paq_instalado"))
    svc_key = ["co_id", "fecha_excel", "valor_paq", "desc_serv_instalado"]
    # Staged: its keys are asked for twice before its rows are.
    df = staged(keep_first_counted(df, svc_key, SORT, "duplicado_por_servicio"), "services")  # W3, W2 keep 1 (A2)
    df = membership_flag(df, companies, ["nit"], "segmento", yes="EMPRESAS", no="NEGOCIOS")  # N10
    other_keys = other.withColumn("__paq_txt", int_text("cod_paq_instalado")).select(*MATCH_KEY)
    df = membership_flag(df, other_keys, MATCH_KEY, "cruce_bajas_altas", yes="Cruza", no="No cruza")
    return df.withColumn("tipo", F.lit(kind)).drop("__paq_txt")


def churn_and_additions(packages: DataFrame, rules: WhiteLabelRules, companies: DataFrame) -> DataFrame:
    """Union of the churn (BAJAS) and additions (ALTAS) sides with the
    reporting month (X29)."""
    deact = F.col("fecha_desact_paq")
    churn_all = packages.filter(deact.isNotNull() & in_period(deact, rules.period)
                                & ~F.col("anio_mes_act_paq").eqNullSafe(F.lit(rules.period)))
    adds_all = packages.filter(deact.isNull() & (F.col("anio_mes_act_paq") == F.lit(rules.period)))
    churn = churn_all.filter((F.col("valor_paq") > rules.min_value)
                             & not_in_keep_null("desc_serv_instalado", rules.excluded))
    adds = adds_all.filter((F.col("valor_paq") > rules.min_value)
                           & not_in_keep_null("desc_serv_instalado", rules.excluded))
    bajas = _side(churn, "BAJAS", date_to_excel_serial(deact), rules,
                  adds_all.filter(F.col("valor_paq") > 0), companies)
    altas = _side(adds, "ALTAS", date_to_excel_serial("fecha_act_paq"), rules,
                  churn_all.filter(F.col("valor_paq") > 0), companies)
    out = union_all([bajas, altas])
    return out.withColumn("periodo", period_by_type("tipo", "anio_mes_act_paq", "fecha_desact_paq"))


def rules_from_table(params: DataFrame, period: str) -> WhiteLabelRules:
    """Threshold and exclusion list read from the parameter table."""
    from ledgerline.sources.readers import rule_value
    import json
    value = float(rule_value(params, "valor_paq_mb"))
    excluded = json.loads(str(rule_value(params, "excluidos_mb")).replace("'", '"'))
    return WhiteLabelRules(period=period, min_value=value, excluded=list(excluded))


def demo_packages(orders: DataFrame) -> DataFrame:
    """orders shaped like the package table."""
    return orders.select(
        F.col("o_orderkey"),
        F.col("o_custkey").alias("nit"),
        F.col("o_custkey").alias("co_id"),
        F.col("o_orderpriority").alias("tel_num"),
        F.when(F.col("o_orderpriority").like("5%"), F.lit(None))
         .otherwise((F.col("o_custkey") % 7).cast("double")).alias("cod_paq_instalado"),
        F.col("o_orderpriority").alias("desc_serv_instalado"),
        (F.floor(F.col("o_totalprice") / 100000) * 100 + 100).cast("double").alias("valor_paq"),
        F.col("o_orderdate").alias("fecha_act_paq"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), 30).cast("timestamp_ntz"))
         .alias("fecha_desact_paq"),
        F.date_format("o_orderdate", "yyyy-MM").alias("anio_mes_act_paq"))


DEMO_RULES = WhiteLabelRules(period="1998-03", min_value=150.0, excluded=["1-URGENT"])


SERVICE_KEY = ["co_id", "fecha_excel", "valor_paq", "desc_serv_instalado"]


def load(result: DataFrame, history: DataFrame, run, key: list[str] = SERVICE_KEY) -> DataFrame:
    """The load step: keep rows that do not cross, drop the working flags,
    keep only (service key, reporting month) pairs history lacks (N4), stamp."""
    from ledgerline.operators.incremental import new_rows
    from ledgerline.operators.lifecycle import stamp
    rows = (result.filter(F.col("cruce_bajas_altas") == "No cruza")
                  .drop("duplicado_por_servicio", "cruce_bajas_altas")
                  .withColumnRenamed("periodo", "mes_mb"))
    fresh = new_rows(staged(rows, "white-label"), history, [*key, "mes_mb"])
    out = stamp(fresh, run, "MARCA BLANCA")
    return out.withColumn("id_estado_registro", F.lit(1))
