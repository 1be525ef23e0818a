"""Commercial org chart -> domain tables, person tables, versioned fact.

Order matters: domain values and persons are committed (written and read
back) before the fact looks them up, so surrogate ids are fixed once.
All domains live in one long table ``(dominio, valor, id, ...)``; a
domain is a configuration entry, not a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import STATE_ACTIVE, STATE_INACTIVE
from ledgerline.functions.keys import row_id
from ledgerline.functions.text import (deep_clean, fix_document, remove_vacancy_marker, rightmost,
                                       strip_ws, vacancy_state)
from ledgerline.operators.dedupe import keep_first
from ledgerline.operators.dims import assign_ids, domain_candidates, lookup, new_domain_values
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.lifecycle import Run, targeted_state_update, with_row_ids

# Sheet column -> domain name (configuration; extend per sheet layout).
ORG_DOMAINS = {"CARGO ACTUAL": "cargo", "SEGMENTO": "segmento", "CANAL": "canal"}
# Person role -> (sheet column with the person's name, title keyword).
PERSON_ROLES = {"jefe": ("NOMBRE JEFE", "jefe")}


def domain_updates(sheet: DataFrame, existing: DataFrame, run: Run, domains=ORG_DOMAINS) -> DataFrame:
    """A4 + N6 + W6: new (dominio, valor) rows with ids after the domain's max."""
    cands = domain_candidates(sheet, list(domains), clean=deep_clean)
    names = F.create_map(*[x for k, v in domains.items() for x in (F.lit(k), F.lit(v))])
    cands = cands.withColumn("dominio", names[F.col("dominio")]).distinct()
    fresh = new_domain_values(cands, existing.select("dominio", "valor"))
    return (assign_ids(fresh, existing, "id", "valor", group=["dominio"])
            .withColumns({"fecha_creacion": F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz"),
                          "fecha_modificacion": F.lit(run.started.isoformat(sep=" ")).cast("timestamp_ntz"),
                          "id_estado_registro": F.lit(STATE_ACTIVE)}))


def person_updates(sheet: DataFrame, existing: DataFrame, run: Run, role: str = "jefe",
                   retired_sheet: bool = False) -> tuple[DataFrame, DataFrame]:
    """N7 + X14/X13 + A3 + C7: (new persons, existing persons with vacancies retired)."""
    _, keyword = PERSON_ROLES[role]
    holders = sheet.filter(F.coalesce(F.lower(F.col("CARGO ACTUAL")).contains(keyword), F.lit(False)))
    state = F.lit(STATE_INACTIVE) if retired_sheet else vacancy_state("NOMBRE", F.lit(STATE_ACTIVE))
    people = holders.select(remove_vacancy_marker("NOMBRE").alias("nombre"),
                            fix_document("No DOCUMENTO").alias("identificacion"),
                            state.alias("id_estado_registro"))
    people = keep_first(people, ["nombre"], ["id_estado_registro", "identificacion"])          # A3
    fresh = new_rows(people, existing, ["nombre"], small_history=True).withColumns({                              # N7
        "rol": F.lit(role), "id_persona": row_id(F.lit(role), "nombre", run_id="PERSONA")})
    vacated = people.filter(F.col("id_estado_registro") == STATE_INACTIVE).select("nombre")
    updated = targeted_state_update(existing, vacated, ["nombre"], STATE_INACTIVE,
                                    state_col="id_estado_registro", skip_if=STATE_INACTIVE)   # C7
    return fresh.select("rol", "id_persona", "nombre", "identificacion", "id_estado_registro"), updated


def _lookup_domains(fact: DataFrame, domains: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """One left join per domain column, selecting only the id."""
    for col, dom in mapping.items():
        fact = lookup(fact, domains.filter(F.col("dominio") == dom), deep_clean(col), "valor", {"id": f"id_{dom}"})
    return fact


def build_fact(sheet: DataFrame, domains: DataFrame, persons: DataFrame, version: int, source: str,
               run: Run, retired_sheet: bool = False) -> DataFrame:
    """Fact rows: domain ids, person ids, fixed documents, state and version."""
    fact = _lookup_domains(sheet, domains, ORG_DOMAINS)
    bosses = (persons.filter(F.col("rol") == "jefe").groupBy("nombre").agg(F.max("id_persona").alias("id_jefe"))
                     .withColumnRenamed("nombre", "__jefe"))
    fact = lookup(fact, bosses, remove_vacancy_marker("NOMBRE JEFE"), "__jefe", {"id_jefe": "id_jefe"})  # N12
    state = F.lit(STATE_INACTIVE) if retired_sheet else vacancy_state("NOMBRE", F.lit(STATE_ACTIVE))   # X14, C11
    ident = fix_document("No DOCUMENTO")                                                        # X15
    out = fact.select(
        remove_vacancy_marker("NOMBRE").alias("nombre_completo"),
        ident.alias("identificacion"),
        rightmost(strip_ws("No DOCUMENTO"), 8).alias("codigo_dealer"),                          # X8
        *[F.col(f"id_{d}") for d in ORG_DOMAINS.values()], "id_jefe",
        state.alias("id_estado_registro"),
        F.lit(version).alias("version"), F.lit(source).alias("fuente"))
    return with_row_ids(out, run.run_id)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Commit a table and continue from what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def commit(df: DataFrame, path: str | None = None) -> DataFrame:
    """C10 as a lineage cut: write to ``path`` (a shared table location) when
    given, else checkpoint to the cluster's reliable checkpoint folder.  The
    fact then reads fixed ids instead of recomputing them per lookup."""
    return materialise(df, path) if path else df.checkpoint(eager=True)


def assign_by_name(sheet: DataFrame, name_col: str, specialists: DataFrame, coordinators: DataFrame,
                   exclusive: bool, out: tuple[str, str] = ("especialista", "coordinador_directo"),
                   order_col: str = "orden") -> DataFrame:
    """N16 for the retail / direct-channel sheets: a (partial) name is looked
    up, case-insensitively and literally, inside the specialist and
    coordinator dimensions.

    * independent (retail): each slot gets the first dimension name that
      contains the sheet's name;
    * exclusive (direct channel): the sheet's name goes to the specialist
      slot when a specialist name contains it, else to the coordinator slot.

    Empty or missing names and misses give 'NO APLICA'."""
    from ledgerline.functions.constants import NOT_APPLICABLE
    from ledgerline.operators.dims import contains_match_two
    probe = sheet.withColumn("__probe", F.when(strip_ws(name_col) == "", F.lit(None)).otherwise(F.col(name_col)))
    res = contains_match_two(probe, "__probe", (specialists, "nombre", [order_col]),
                             (coordinators, "nombre", [order_col]), out[0], out[1],
                             exclusive=exclusive, default=NOT_APPLICABLE, return_probe=exclusive)
    return res.drop("__probe")
