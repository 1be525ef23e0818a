"""The six warehouse extracts, as configured stars over DataFrames.

The warehouse tables are read with the partitioned JDBC reader (or landed as
Parquet).  A star is a list of roles: which dimension, on which keys, which of
its columns under which names.  One dimension may play several roles.  Columns
are pruned and sides broadcast by Catalyst; rows already loaded are dropped by
the typed multi-column anti-join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import after_dash_code, strip_accents_lower
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.joins import spread_join


@dataclass(frozen=True)
class Role:
    """A dimension in a star: ``columns`` maps its columns to output names."""

    dimension: str
    key: str                      # of the dimension
    fact_key: str                 # of the fact, or an earlier role's output
    columns: dict[str, str]
    how: str = "left"             # "inner" drops fact rows without a match
    only: tuple[str, object] | None = None   # (dimension column, value) to keep


def star(fact: DataFrame, dimensions: dict[str, DataFrame], roles: list[Role]) -> DataFrame:
    """The fact with the columns of its roles added."""
    out = fact
    for i, role in enumerate(roles):
        d = dimensions[role.dimension]
        if role.only:
            d = d.filter(F.col(role.only[0]) == F.lit(role.only[1]))
        key = f"__key{i}"
        d = d.select(F.col(role.key).alias(key), *[F.col(c).alias(f"__{i}_{name}") for c, name in role.columns.items()])
        out = spread_join(out.withColumn(key, F.col(role.fact_key)), d, [key], role.how).drop(key)
        out = out.withColumns({name: F.col(f"__{i}_{name}") for name in role.columns.values()})
        out = out.drop(*[f"__{i}_{name}" for name in role.columns.values()])
    return out


# --- fixed values: dimensions of the plan-change extract and the columns taken -------
_PLAN = {"cod_plan": "cod_plan", "plan_desc": "ds_plan", "vlr_cfm": "cfm_plan", "tipo_plan": "tipo_plan"}
_USER = {"cd_usuario_red": "cd_usuario_red", "ds_nombre_usuario": "ds_nombre_usuario",
         "ds_ubicacion_usuario": "ds_ubicacion_usuario", "ds_canal_usuario": "ds_canal_usuario"}


def _named(columns: dict[str, str], suffix: str) -> dict[str, str]:
    return {c: f"{name}_{suffix}" for c, name in columns.items()}


PLAN_CHANGE_ROLES = [
    Role("agentes", "cod_agente", "cod_agente", {"custcode_agente": "custcode_agente", "region_comercial": "region_comercial",
                                                 "gerencia": "gerencia", "canal": "canal"}),
    Role("regiones", "cod_mercado", "cod_mercado", {"region_desc": "region_geografica"}),
    Role("identificadores", "tipo_identificacion", "tipo_identificacion", {"tipo_identificador_desc": "tipo_identificador_desc"}),
    Role("ciclos", "cod_ciclo", "cod_ciclo", {"cod_ciclo": "cod_ciclo"}),
    Role("segmentos", "sk_segmento_cliente", "sk_segmento_cliente",
         {"cd_segmento_cliente": "codigo_segmento_cliente", "ds_segmento_cliente": "segmentacion", "ds_unidad_negocio": "ds_unidad_negocio"}),
    Role("grados", "sk_tipo_grade", "sk_tipo_grade", {"ds_tipo_grade": "ds_tipo_grade"}),
    Role("antiguedades", "sk_rango_antiguedad", "sk_rango_antiguedad", {"ds_rango_antiguedad": "ds_rango_antiguedad"}),
    Role("gamas", "sk_gama_plan", "sk_gama_plan_origen", {"ds_gama_plan": "ds_gama_plan_origen"}),
    Role("gamas", "sk_gama_plan", "sk_gama_plan_destino", {"ds_gama_plan": "ds_gama_plan_destino"}),
    Role("usuarios", "sk_usuario_ubicacion", "sk_usuario_creacion", _named(_USER, "creacion")),
    Role("usuarios", "sk_usuario_ubicacion", "sk_usuario_cierre", _named(_USER, "cierre")),
    Role("clientes", "co_id", "co_id", {"identificacion": "identificacion", "identificacion_mtr": "identificacion_mtr"}),
    Role("planes", "cod_plan", "cod_plan_origen", {**_named(_PLAN, "origen"), "producto": "tipo_linea"}),
    Role("planes", "cod_plan", "cod_plan_destino", _named(_PLAN, "destino")),
    # The business flag of the destination plan: rows of other plans drop out.
    Role("planes", "cod_plan", "cod_plan_destino", {"ban_pyme": "plan_negocios"}, "inner", ("ban_pyme", "S")),
]
PLAN_CHANGE_KEYS = ["tipo_identificacion", "cod_mercado", "sk_segmento_cliente", "sk_tipo_grade", "sk_rango_antiguedad",
                    "sk_gama_plan_origen", "sk_gama_plan_destino", "sk_usuario_creacion", "sk_usuario_cierre"]
PLAN_CHANGE_DATES = ["fe_activacion", "fe_creacion", "fe_cambio", "fe_cierre"]
PLAN_CHANGE_AMOUNTS = ["cfm_plan_origen", "cfm_plan_destino", "vl_cfm_neto", "vl_cfm_neto_contable_voz", "vl_cfm_neto_contable_datos"]


PLAN_CHANGE_KEY = ["co_id", "cod_plan_origen", "cod_plan_destino"]


def plan_changes(fact: DataFrame, dimensions: dict[str, DataFrame], since: str, loaded: DataFrame | None = None) -> DataFrame:
    """Executed plan changes into business plans since a day, dates as text.

    N3: rows whose ``PLAN_CHANGE_KEY`` the history ``loaded`` holds are left
    out.  The key, and that of the inner roles, are columns of the fact: both
    are applied before the other roles, which then widen new rows only."""
    recent = fact.filter(F.col("fe_creacion") >= F.lit(since).cast("timestamp_ntz"))
    inner, left = ([r for r in PLAN_CHANGE_ROLES if (r.how == "inner") == kind] for kind in (True, False))
    rows = star(recent, dimensions, inner)
    if loaded is not None:
        rows = extract_new(rows, loaded, PLAN_CHANGE_KEY)
    last = [name for r in inner for name in r.columns.values()]
    rows = star(rows, dimensions, left)
    rows = rows.select(*[c for c in rows.columns if c not in last], *last).drop(*PLAN_CHANGE_KEYS)
    rows = rows.withColumns({c: F.date_format(c, "dd/MM/yyyy") for c in PLAN_CHANGE_DATES if c in rows.columns})
    rows = rows.withColumns({c: F.col(c).cast("double") for c in PLAN_CHANGE_AMOUNTS if c in rows.columns})
    closed = F.when(F.col("no_ejecutado") == 1, F.lit("Cerrado")).otherwise(F.lit("Abierto"))
    return rows.withColumns({"flag": F.lit("NEG_PLANES"), "estado_tickler": closed}).drop("no_ejecutado")


# --- fixed values: reason codes of the two branches of the sales extract -------------
FIRST_REASONS = ["32", "57", "267", "345", "362", "118", "285", "500", "202"]
SECOND_REASONS = ["333", "444", "555", "666", "777"]
DISTRIBUTOR_KINDS = ["D", "T", "MAY", "C"]


def like_any(col: str, codes: list[str]) -> Column:
    """the text contains one of the codes."""
    return reduce(lambda a, b: a | b, [F.col(col).contains(c) for c in codes])


def activations(sales: DataFrame, segments: DataFrame, branches: list[list[str]] | None = None) -> DataFrame:
    """Sales of confidential segments with a reason of any branch, without
    repeats.  A distinct union of filters of one input is one filter and one
    distinct: the sales are read once."""
    codes = [c for branch in branches or [FIRST_REASONS, SECOND_REASONS] for c in branch]
    d = segments.select(F.col("identificacion").alias("ssn"), F.col("segmento").alias("flag"))
    rows = spread_join(sales.filter(like_any("razon_inicial", codes)), d, ["ssn"], "inner")
    out = rows.withColumns({
        "segmento": F.lit("NEGOCIOS"), "cfm": F.col("cfm").cast("int"), "ciclo": after_dash_code("ciclo"),
        **{c: strip_accents_lower(c) for c in ("razon_inicial", "razon_final")}})
    return out.distinct()


def agents(table: DataFrame) -> DataFrame:
    """The agent dimension under the names of its landed table."""
    return table.withColumnsRenamed({"canal": "canal_comercial", "region_comercial": "direccion"})


def plans(table: DataFrame) -> DataFrame:
    """The plan dimension as it is."""
    return table


def segment_base(segments: DataFrame) -> DataFrame:
    """Current members of the confidential segments."""
    return segments.filter(F.col("cb_esactual") == "1").select(
        F.col("identificacion").alias("cust_id"), F.lit("").alias("cod_plan"), F.col("segmento").alias("flag"), F.lit("").alias("usuario"))


def city_codes(distributors: DataFrame) -> DataFrame:
    """Distributors of the kinds that have a city code."""
    return distributors.filter(F.col("tipo_distribuidor").isin(*DISTRIBUTOR_KINDS))


def extract_new(extract: DataFrame, history: DataFrame, key: list[str]) -> DataFrame:
    """Rows of an extract whose multi-column key history does not hold."""
    return new_rows(extract, history, key)
