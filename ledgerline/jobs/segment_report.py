"""Segment additions report.

Sources are coalesced per work order (W4), enriched from the staffing
table (left join that may fan out, with one role excluded except for a
named person), twins resolved, values normalised and scaled, consultant
state derived, and each row gets a sequential report number
``ALT-<MON><yy>-<8 digits>`` for the run month (W5, range-partitioned).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import MONTH_ABBREVIATIONS, UNASSIGNED
from ledgerline.functions.numbers import round_like_pandas
from ledgerline.functions.predicates import exclude_with_exception
from ledgerline.functions.values import consultant_state
from ledgerline.operators.columns import pad_columns
from ledgerline.operators.fill import fill_across_sources
from ledgerline.operators.joins import spread_join
from ledgerline.operators.numbering import number_rows
from ledgerline.operators.staging import staged


@dataclass
class ReportParams:
    run_date: _dt.date
    excluded_role: str = "CONSULTOR IT"
    exempt_person: str | None = None


OUTPUT = ["nuv", "ot", "fecha", "producto", "valor", "ciudad", "nit", "razon_social", "documento_consultor", "nombre_consultor",
          "cargo_actual", "estado_consultor", "ot_reemplazada"]


def preferred_fiber_rows(fiber: DataFrame) -> DataFrame:
    """One fiber row per work order -- rows with a real city first
    (``SIN CIUDA%`` last), then the newest processing time."""
    from ledgerline.operators.dedupe import keep_first
    pref = F.when(F.coalesce(F.col("ciudad").like("SIN CIUDA%"), F.lit(False)), F.lit(2)).otherwise(F.lit(1))
    return keep_first(fiber, ["ot"], [pref.asc(), F.col("fecha_inicio").desc_nulls_last()])


@dataclass
class ReportInputs:
    new: DataFrame            # new sales
    upsell: DataFrame         # up-sell sales
    hfc: DataFrame            # installed orders, with the consultant's document
    cloud: DataFrame
    staff: DataFrame          # (documento_consultor, nombre_consultor, cargo_actual, ciudad), may repeat a document
    assignment: DataFrame     # (nit, razon_social) -> consultant of the fixed and of the mobile line
    fiber: DataFrame | None = None


DATA = ["ot", "fecha", "producto", "valor", "ciudad", "nit", "razon_social", "documento_consultor", "nombre_consultor", "cargo_actual"]
TYPES = {"ot": "bigint", "valor": "double", "nit": "bigint", "documento_consultor": "bigint"}


def _placed(df: DataFrame) -> DataFrame:
    """All data columns, and the row's place in its source: as landed (``pos``),
    or by its content for the result of an earlier stage."""
    own = df.withColumns({c: (F.col(c) if c in df.columns else F.lit(None)).cast(TYPES.get(c, "string")) for c in DATA})
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in DATA])
    place = F.format_string("%020d", "pos") if "pos" in df.columns else text
    return own.withColumn("pos", place).select(*DATA, "pos")


def stage(*frames: DataFrame) -> DataFrame:
    """W4 + A1: sources coalesced per work order, in the given order."""
    return fill_across_sources([_placed(f) for f in frames], "ot", ["pos"])


def with_staff(df: DataFrame, staff: DataFrame, prefer: dict[str, str]) -> DataFrame:
    """N18 + J12 + A1: every staff row of the document (the join may fan out).

    Repeated rows of either side would only be repeated results, and are
    dropped first, which deals the rows out evenly, to as many tasks as their
    size asks for: a fixed number of tasks, each writing a block for every
    partition of the next shuffle, costs the square of that number."""
    renamed = staff.select("documento_consultor", *[F.col(c).alias(f"__{c}") for c in prefer]).distinct()
    out = spread_join(df.distinct(), renamed, ["documento_consultor"], "left")
    pick = {c: F.coalesce(F.col(c), F.col(f"__{c}")) if first == "left" else F.coalesce(F.col(f"__{c}"), F.col(c)) for c, first in prefer.items()}
    return out.withColumns(pick).select(*DATA).distinct()


def with_assignment(df: DataFrame, assignment: DataFrame) -> DataFrame:
    """The consultant assigned to (document, name) of the customer: of the
    fixed line, else of the mobile one; what the row has comes first."""
    a = assignment.select("nit", "razon_social",
                          F.coalesce("consultor_fijo", "consultor_movil").alias("__nombre_consultor"),
                          F.coalesce("cedula_fijo", "cedula_movil").alias("__documento_consultor")).distinct()
    out = spread_join(df, a, ["nit", "razon_social"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in ("nombre_consultor", "documento_consultor")}).select(*DATA).distinct()


def build(inp: ReportInputs, params: ReportParams) -> DataFrame:
    """The report's stages: sales, installed orders with staff, fiber and cloud
    rows, both coalesced, assignment, cloud again, staff again, numbers."""
    keep = exclude_with_exception(F.col("cargo_actual") == F.lit(params.excluded_role),
                                  ~F.col("nombre_consultor").eqNullSafe(F.lit(params.exempt_person)))
    staff = inp.staff.filter(keep)                                                          # F14
    hfc = with_staff(_placed(inp.hfc).drop("pos"), staff, {"ciudad": "left", "nombre_consultor": "right", "cargo_actual": "left"})
    installed = [hfc] + ([preferred_fiber_rows(inp.fiber).drop("fecha_inicio")] if inp.fiber is not None else [])
    rows = stage(stage(inp.new, inp.upsell), stage(stage(*installed), inp.cloud))
    rows = stage(with_assignment(rows, inp.assignment), inp.cloud)
    joined = with_staff(rows, staff, {"ciudad": "left", "nombre_consultor": "left", "cargo_actual": "left"})
    out = joined.withColumns({
        "nombre_consultor": F.when(F.coalesce(F.col("nombre_consultor"), F.lit("")) == "", F.lit(UNASSIGNED))
                             .otherwise(F.col("nombre_consultor")),                        # X22
        "valor": round_like_pandas(F.coalesce(F.col("valor").try_cast("double"), F.lit(0.0)) / 1000.0, 2),  # X18
    })
    out = out.withColumn("estado_consultor", consultant_state("nombre_consultor", "documento_consultor",
                                                              F.lit("ACTIVO")))             # X28
    numbered = number_rows(staged(out, "report"), DATA, None, "__n")                        # W5
    prefix = f"ALT-{MONTH_ABBREVIATIONS[params.run_date.month - 1]}{params.run_date:%y}-"
    numbered = numbered.withColumn("nuv", F.concat(F.lit(prefix), F.format_string("%08d", "__n")))
    types = dict(numbered.dtypes)
    return pad_columns(numbered.drop("__n"), {c: types.get(c, "string") for c in OUTPUT})  # J7


def demo_fiber(t) -> DataFrame:
    """Fiber-order loads: several per work order, some without a city."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey")
    return j.select(F.col("o_custkey").alias("ot"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
                    F.when(F.col("l_returnflag") == "N", F.lit("SIN CIUDAD"))
                     .otherwise(F.concat(F.lit("CIUDAD "), F.col("l_linestatus"))).alias("ciudad"),
                    F.col("l_shipdate").alias("fecha_inicio"))


def demo_inputs(t) -> ReportInputs:
    o, c = t.orders, t.customer
    sales = lambda state: o.filter(F.col("o_orderstatus") == state).select(
        F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("ot"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
        F.when(~F.col("o_orderpriority").like("5%"), F.col("o_totalprice")).alias("valor"), F.col("o_orderpriority").alias("producto"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 50).alias("nit"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("RS "), (F.col("o_custkey") % 50).cast("string"))).alias("razon_social"))
    hfc = c.select(F.col("c_custkey").alias("ot"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("ciudad"),
                   F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 60).alias("documento_consultor"),
                   F.when(F.col("c_custkey") % 5 == 0, F.lit("DE ALTA")).alias("nombre_consultor"))
    cloud = c.filter("c_custkey % 6 = 0").select(F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("ot"), F.lit("2024-02-02").alias("fecha"),
                                                 F.lit("CLOUD").alias("producto"), (F.col("c_custkey") % 50).alias("nit"))
    staff = t.supplier.select(
        F.floor(F.col("s_suppkey") / 2).alias("documento_consultor"), F.col("s_name").alias("nombre_consultor"),
        F.when(F.col("s_acctbal") < 0, F.lit("CONSULTOR IT")).otherwise(F.lit("CONSULTOR")).alias("cargo_actual"),
        F.when(F.col("s_acctbal") > 5000, F.lit("BOGOTA")).alias("ciudad"))
    assignment = t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("nit"), F.concat(F.lit("RS "), F.col("n_nationkey").cast("string")).alias("razon_social"),
        F.when(F.col("n_regionkey") != 1, F.concat(F.lit("FIJO "), "n_name")).alias("consultor_fijo"), F.concat(F.lit("MOVIL "), "n_name").alias("consultor_movil"),
        F.when(F.col("n_regionkey") != 1, F.col("n_nationkey").cast("bigint") + 20).alias("cedula_fijo"), (F.col("n_nationkey").cast("bigint") + 30).alias("cedula_movil"))
    return ReportInputs(sales("F"), sales("P"), hfc, cloud, staff, assignment, demo_fiber(t))


DEMO_PARAMS = ReportParams(run_date=_dt.date(2024, 3, 15), exempt_person="Supplier#000000003")
