"""The eight sheet layouts of the org chart, as configuration.

A layout says which headers a sheet has and what stands in for the columns it
lacks; ``normalise`` brings every sheet to the same columns, ``people`` takes
the persons named in any role, and ``fact`` looks all domains and roles up.
Domains and persons are committed before the fact is built (``org_chart``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.constants import (NOT_APPLICABLE, SENTINEL_DATE, STATE_ACTIVE, STATE_INACTIVE,
                                            UNKNOWN_DOCUMENT)
from ledgerline.functions.keys import row_id
from ledgerline.functions.text import deep_clean, fix_document, remove_vacancy_marker, rightmost, vacancy_state
from ledgerline.jobs.org_chart import assign_by_name
from ledgerline.operators.columns import rename_map
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.dims import assign_ids, domain_candidates, lookup, lookup_many, new_domain_values
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.lifecycle import Run, targeted_state_update, with_row_ids
from ledgerline.operators.setops import union_all

# --- fixed values: domain column -> id column of the fact ---------------------------
DOMAINS = {
    "tipo_documento": "id_tipo_documento", "genero": "id_genero", "cargo_actual": "id_cargo", "operacion": "id_operacion",
    "contrato": "id_contrato", "tipo_contrato": "id_tipo_contrato", "contratante": "id_contratante", "segmento": "id_segmento",
    "gerencia_jefatura": "id_gerencia_jefatura", "grupo": "id_grupo", "area": "id_area", "canal": "id_canal",
    "categoria": "id_categoria", "categorizacion": "id_categorizacion", "proveedor": "id_proveedor", "regional": "id_regional",
    "antiguedad": "id_antiguedad", "estado": "id_estado", "fuente": "id_fuente", "direccion_comercial": "id_direccion_comercial",
}
ROLES = ["especialista", "coordinador_tercero", "coordinador_directo", "jefe", "gerente", "director"]
DEFAULT_DOCUMENT_TYPE = 3

# --- fixed values: sheet header -> column -----------------------------------------------
STAFF_HEADERS = {
    "TIPO DOCUMENTO": "tipo_documento", "No DOCUMENTO": "identificacion", "NOMBRE": "nombre_completo", "GENERO": "genero",
    "CELULAR": "celular", "CORREO": "correo", "NACIONALIDAD": "nacionalidad", "CARGO ACTUAL": "cargo_actual", "OPERACION": "operacion",
    "CODIGO VENTAS MOVIL": "codigo_ventas_movil", "CONTRATO": "contrato", "TIPO DE CONTRATACION": "tipo_contrato",
    "CONTRATANTE": "contratante", "NOMBRE ESPECIALISTA": "especialista", "NOMBRE COORDINADOR TERCERO": "coordinador_tercero",
    "NOMBRE COORDINADOR DIRECTO": "coordinador_directo", "NOMBRE JEFE": "jefe", "NOMBRE GERENTE": "gerente",
    "NOMBRE DIRECTOR COMERCIAL": "director", "SEGMENTO": "segmento", "GERENCIA COMERCIAL/ O JEFATURA": "gerencia_jefatura",
    "GRUPO COMERCIAL": "grupo", "AREA": "area", "CANAL": "canal", "CATEGORIA": "categoria", "CATEGORIZACION": "categorizacion",
    "PROVEEDOR": "proveedor", "CIUDAD": "municipio", "REGIONAL": "regional", "DEPARTAMENTO": "departamento",
    "FECHA INGRESO AREA": "fecha_ingreso", "ANTIGUEDAD": "antiguedad", "ESTADO": "estado", "DIRECCION COMERCIAL": "direccion_comercial",
    "OBSERVACION": "observacion", "FUENTE": "fuente",
}
RETAIL_HEADERS = {"NIT": "nit", "NOMBRE": "nombre_completo", "GERENTE": "gerente", "ESPECIALISTA": "especialista",
                  "CIUDAD": "municipio", "DEPARTAMENTO": "departamento"}
DIRECT_HEADERS = {"CIUDAD INCIDENTE": "ciudad_incidente", "NOMBRE ESPECIALISTA": "especialista", "ALIADO RESIDENCIAL": "aliado_residencial"}
CAVS_HEADERS = {
    "No DOCUMENTO": "identificacion", "NOMBRE": "nombre_completo", "CAVS": "cavs", "NOMBRE ESPECIALISTA": "especialista",
    "NOMBRE JEFE": "jefe", "NOMBRE GERENTE": "gerente", "CODIGO PADRE CAV DONDE LABORA": "codigo_padre_cav", "DEALER": "dealer",
    "CODIGO CVC CONSULTOR ": "codigo_cvc_consultor", "CORREO": "correo", "USUARIO RED": "usuario_red", "OBSERVACION": "observacion",
    "SEGMENTO": "segmento", "DIRECCION COMERCIAL": "direccion_comercial", "GERENCIA COMERCIAL/ O JEFATURA": "gerencia_jefatura",
    "CARGO ACTUAL": "cargo_actual", "CANAL": "canal", "CIUDAD": "ciudad", "CELULAR": "celular", "FUENTE": "fuente",
}
TMK_HEADERS = {
    "Codigo": "codigo", "Dealer": "dealer", "NOMBRE DEL DEALER": "nombre_completo", "ALIADO": "aliado", "TIPO DE CVC": "tipo_cvc",
    "OPERACIÓN": "operacion", "REGION": "region", "GERENCIA": "gerencia_jefatura", "NOMBRE DE GERENTE": "gerente", "JEFE": "jefe",
    "ESPECIALISTA": "especialista", "DIRECCION COMERCIAL": "direccion_comercial", "NOMBRE DIRECTOR": "director",
    "OBSERVACION": "observacion", "FUENTE": "fuente",
}
# Commercial intelligence: fewer headers, and the head's document beside the name.
INTELLIGENCE_HEADERS = {h: STAFF_HEADERS[h] for h in (
    "TIPO DOCUMENTO", "No DOCUMENTO", "NOMBRE", "CELULAR", "CORREO", "CARGO ACTUAL", "TIPO DE CONTRATACION", "GERENCIA COMERCIAL/ O JEFATURA",
    "NOMBRE JEFE", "PROVEEDOR", "FECHA INGRESO AREA", "SEGMENTO", "DIRECCION COMERCIAL", "CANAL", "FUENTE")}
INTELLIGENCE_HEADERS |= {"CIUDAD": "ciudad", "DOCUMENTO JEFE": "documento_jefe"}
# --- fixed values: role -> word in the job title of a post that can be vacated --------------
VACANCY_TITLES = {"jefe": "jefe", "coordinador_directo": "coordinador", "gerente": "gerente"}
# --- fixed values: what stands in for columns that a sheet lacks; other domains and roles are 'NO APLICA'.
ABSENT = {"celular": "0", "correo": "0", "nacionalidad": "0", "codigo_ventas_movil": "0", "departamento": "0", "municipio": "0",
          "identificacion": "0", "nombre_completo": NOT_APPLICABLE, "fecha_ingreso": SENTINEL_DATE}
FACT = ["tipo_documento", "identificacion", "nombre_completo", "celular", "correo", "nacionalidad", "codigo_ventas_movil",
        "departamento", "municipio", "fecha_ingreso", "observacion", "fecha_retiro_area"]


@dataclass(frozen=True)
class Layout:
    source: str
    headers: dict[str, str]
    fixed: dict[str, str] = field(default_factory=dict)  # columns that the sheet's own value does not decide
    retired: bool = False                                 # the leavers' sheet: state 4 (C11)
    assign: str | None = None                             # N16: "independent" or "exclusive" slots of a partial name
    required: tuple[str, ...] = ()
    extra: tuple[str, ...] = ()


LAYOUTS = {
    "red_maestra": Layout("RED MAESTRA", STAFF_HEADERS),
    "retiro": Layout("RETIRO", {**STAFF_HEADERS, "FECHA RETIRO AREA": "fecha_retiro_area"}, retired=True),
    "retail": Layout("RETAIL", RETAIL_HEADERS, {"fuente": "RETAIL"}, assign="independent", extra=("nit",)),
    "directos": Layout("DIRECTOS", DIRECT_HEADERS, {"fuente": "DIRECTOS"}, assign="exclusive",
                       required=("aliado_residencial", "ciudad_incidente", "especialista"), extra=("aliado_residencial", "ciudad_incidente")),
    "cavs": Layout("CAVS", CAVS_HEADERS, {"coordinador_directo": NOT_APPLICABLE}, assign="independent",
                   extra=("cavs", "codigo_padre_cav", "codigo_cvc_consultor", "usuario_red", "ciudad", "dealer")),
    "tmk": Layout("TMK", TMK_HEADERS, extra=("dealer",)),
    "inteligencia": Layout("INTELIGENCIA COMERCIAL", INTELLIGENCE_HEADERS, extra=("ciudad", "documento_jefe")),
    "inteligencia_retiro": Layout("INTELIGENCIA COMERCIAL RETIRO", {**INTELLIGENCE_HEADERS, "FECHA RETIRO AREA": "fecha_retiro_area", "MOTIVO": "motivo"},
                                  retired=True, extra=("ciudad", "documento_jefe", "motivo")),
}


def normalise(sheet: DataFrame, layout: Layout, specialists: DataFrame | None = None, coordinators: DataFrame | None = None) -> DataFrame:
    """The sheet under common columns: renamed, cleaned, absent ones filled in
    and, where the layout says so, specialist and coordinator found by name."""
    own = {h: c for h, c in layout.headers.items() if h in sheet.columns}
    df = rename_map(sheet.select(*[F.col(f"`{h}`") for h in own]), own)
    df = df.withColumns({c: F.lit(None).cast("string") for c in [*DOMAINS, *ROLES, *FACT, *layout.extra] if c not in df.columns})
    fill = {c: ABSENT.get(c, NOT_APPLICABLE) for c in [*DOMAINS, *ROLES, *ABSENT] if c not in own.values()}
    fill |= {"area": NOT_APPLICABLE, "coordinador_directo": NOT_APPLICABLE}
    if "fecha_retiro_area" not in own.values():
        fill["fecha_retiro_area"] = SENTINEL_DATE
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if layout.assign:
        df = assign_by_name(df.withColumn("__buscado", F.col("especialista")).drop("especialista", "coordinador_directo"), "__buscado",
                            specialists, coordinators, exclusive=layout.assign == "exclusive").drop("__buscado")
    df = df.withColumns({c: deep_clean(c) for c in text})
    if layout.required:
        df = df.dropna(subset=list(layout.required))
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in fill.items()})
    return df.withColumns({c: F.lit(v) for c, v in {"fuente": layout.source, **layout.fixed}.items() if c in layout.fixed or "fuente" not in own.values()})


def domain_rows(sheets: list[DataFrame], existing: DataFrame) -> DataFrame:
    """A4 + N6 + W6: (dominio, valor, id) of the values that ``existing`` lacks."""
    names = list(DOMAINS)
    every = union_all([s.select(*names) for s in sheets])
    fresh = new_domain_values(domain_candidates(every, names, clean=lambda c: c), existing.select("dominio", "valor"))
    return assign_ids(fresh, existing, "id", "valor", group=["dominio"]).select("dominio", "valor", "id")


def people(sheets: dict[str, DataFrame], existing: DataFrame) -> DataFrame:
    """(rol, id_persona, nombre, identificacion, id_estado_registro)
    of the persons named in a role whom ``existing`` lacks.

    One pass: the role columns of all sheets are unpivoted.  A person who is a
    row of a sheet too has that row's document, a head whose document stands
    beside the name that one, others the unknown one; of a name's states the
    lowest stays."""
    frames, rows = [], []
    for name, s in sheets.items():
        retired = F.lit(LAYOUTS[name].retired)
        frames.append(s.select(*ROLES).withColumn("__retired", retired))
        rows.append(s.select(remove_vacancy_marker("nombre_completo").alias("nombre"), fix_document("identificacion").alias("identificacion"), F.lit(1).alias("orden")))
        if "documento_jefe" in s.columns:
            rows.append(s.select(remove_vacancy_marker("jefe").alias("nombre"), fix_document("documento_jefe").alias("identificacion"), F.lit(0).alias("orden"))
                        .filter("identificacion IS NOT NULL"))
    named = union_all(frames).unpivot(ids=["__retired"], values=ROLES, variableColumnName="rol", valueColumnName="__raw")
    named = named.filter(F.col("__raw").isNotNull() & ~F.col("__raw").isin("", NOT_APPLICABLE))
    state = F.when(F.col("__retired"), F.lit(STATE_INACTIVE)).otherwise(vacancy_state("__raw", F.lit(STATE_ACTIVE)))
    named = named.select("rol", remove_vacancy_marker("__raw").alias("nombre"), state.alias("id_estado_registro"))
    named = keep_first(named, ["rol", "nombre"], ["id_estado_registro"])
    found = lookup(named, union_all(rows), "nombre", "nombre", {"identificacion": "identificacion"}, {"identificacion": UNKNOWN_DOCUMENT}, order_col="orden")
    ident = row_id("rol", "nombre", run_id="PERSONA")
    return new_rows(found, existing, ["rol", "nombre"], small_history=True).select("rol", ident.alias("id_persona"), "nombre", "identificacion", "id_estado_registro")


def vacated(sheets: dict[str, DataFrame]) -> DataFrame:
    """(rol, nombre) of the posts that the sheets show as vacant: rows whose
    job title names the role and whose name carries the vacancy marker."""
    rows = union_all([s.select("cargo_actual", "nombre_completo") for s in sheets.values()])
    title = F.coalesce(F.lower("cargo_actual"), F.lit(""))
    roles = F.array_compact(F.array(*[F.when(title.contains(word), F.lit(role)) for role, word in VACANCY_TITLES.items()]))
    vacant = rows.filter(F.contains(F.upper("nombre_completo"), F.lit("VACANTE")))
    return vacant.select(F.explode(roles).alias("rol"), remove_vacancy_marker("nombre_completo").alias("nombre")).distinct()


def retire_vacated(existing: DataFrame, sheets: dict[str, DataFrame]) -> DataFrame:
    """Stored persons of a vacated post are inactive; all others stay."""
    return targeted_state_update(existing, vacated(sheets), ["rol", "nombre"], STATE_INACTIVE,
                                 state_col="id_estado_registro", skip_if=STATE_INACTIVE)


def fact(sheet: DataFrame, layout: Layout, domains: DataFrame, persons: DataFrame, version: int, run: Run) -> DataFrame:
    """The sheet's fact rows: domain and person ids, state, document, dealer, version."""
    df = lookup_many(sheet, domains, [(c, c, out) for c, out in DOMAINS.items()])                                     # N11
    df = lookup_many(df, persons, [(remove_vacancy_marker(r), r, f"id_{r}") for r in ROLES], "rol", "nombre", "id_persona")  # N12
    state = F.lit(STATE_INACTIVE) if layout.retired else vacancy_state("nombre_completo", F.lit(STATE_ACTIVE))    # X14, C11
    ident: Column = fix_document("identificacion")                                                                  # X15
    dealer = F.col("dealer") if "dealer" in layout.extra else rightmost(ident, 8)                                   # X8
    ids = [F.coalesce(F.col(c), F.lit(DEFAULT_DOCUMENT_TYPE)).alias(c) if c == "id_tipo_documento" else F.col(c) for c in DOMAINS.values()]
    plain = [c for c in FACT if c not in ("tipo_documento", "identificacion", "nombre_completo")]
    rows = df.select(ident.alias("identificacion"), remove_vacancy_marker("nombre_completo").alias("nombre_completo"), *plain, *ids,
                     *[f"id_{r}" for r in ROLES], dealer.alias("dealer"), *[c for c in layout.extra if c != "dealer"],
                     state.alias("id_estado_registro"), F.lit(version).alias("version"))
    return with_row_ids(rows, run.run_id)
