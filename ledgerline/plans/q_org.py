"""One query per org-chart sheet, on the supplier table relabelled.

Every header has one expression, valid in Spark SQL and in DuckDB, so the
oracle reads the same sheet; it finds domain ids, persons and facts its own way.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ledgerline.jobs import org_layouts as G
from ledgerline.jobs.org_chart import commit
from ledgerline.operators.lifecycle import Run
from ledgerline.plans.catalog import Tables
from ledgerline.plans import q_jobs, q_loaders  # noqa: F401  (registered first)
from ledgerline.plans.registry import REGISTRY, query

NUMBERS = {"red_maestra": 1, "retiro": 2, "retail": 3, "directos": 4, "cavs": 5, "tmk": 6, "inteligencia": 7, "inteligencia_retiro": 8}


def _values(sheet: str) -> dict[str, str]:
    """Expressions of the sheet's headers, by what the column is."""
    k = NUMBERS[sheet]
    out = {}
    for i, (header, column) in enumerate(G.LAYOUTS[sheet].headers.items()):
        if column == "nombre_completo":
            e = "CASE WHEN s_acctbal < 500 THEN concat(s_name, ' (VACANTE)') ELSE concat('  ', s_name) END"
        elif column == "identificacion":
            e = "CAST(s_suppkey * 1000003 + 10000000000 AS STRING)"
        elif column in G.ROLES and G.LAYOUTS[sheet].assign and column == "especialista":
            e = "CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN '' ELSE lower(substring(s_name, 3, 14)) END"
        elif column in G.ROLES:
            e = (f"CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 11 = 1 THEN 'NO APLICA' WHEN s_nationkey % 6 = {i % 6} "
                 f"THEN concat('Persona ', CAST(s_nationkey AS STRING), ' (VACANTE)') ELSE concat('supplier#00000000', CAST(s_nationkey % 7 AS STRING)) END")
        elif column in G.DOMAINS:
            e = f"CASE WHEN s_suppkey % {7 + i} = 0 THEN NULL ELSE concat(' v', CAST((s_nationkey + {i * k}) % {3 + i % 5} AS STRING), chr(10)) END"
        elif column in G.LAYOUTS[sheet].required:
            e = f"CASE WHEN s_suppkey % 13 = {i} THEN NULL ELSE concat('x', CAST(s_nationkey AS STRING)) END"
        else:
            e = f"concat('c{i} ', CAST(s_suppkey AS STRING))"
        out[header] = e
    return out


def _staff_sql(column: str) -> str:
    """Dimension for the match by partial name, in its order."""
    return f"SELECT s_name AS nombre, s_suppkey AS orden FROM supplier WHERE s_suppkey % 2 = {0 if column == 'especialista' else 1} AND s_suppkey % 3 <> 0"


def _clean(x: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(upper({x}), '^\\s+|\\s+$', '', 'g'), '[\\n\\r\\t]', '', 'g'), '  ', '', 'g')")


def _unmarked(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\(VACANT[EA]\\)', '', 'g'), '^\\s+|\\s+$', '', 'g')"


def _oracle(sheet: str) -> str:
    layout, values = G.LAYOUTS[sheet], _values(sheet)
    by_column = {c: values[h] for h, c in layout.headers.items()}
    raw = ", ".join(f"{e.replace(' AS STRING)', ' AS VARCHAR)')} AS {c}" for c, e in by_column.items())
    found, where = {}, "TRUE"
    if layout.assign:
        first = {c: f"(SELECT arg_min(d.nombre, d.orden) FROM ({_staff_sql(c)}) d WHERE contains(lower(d.nombre), lower(b.especialista)))"
                 for c in ("especialista", "coordinador_directo")}
        ask = "regexp_replace(b.especialista, '^\\s+|\\s+$', '', 'g') <> ''"
        if layout.assign == "independent":
            found = {c: f"coalesce(CASE WHEN {ask} THEN {q} END, 'NO APLICA')" for c, q in first.items()}
        else:
            a, b = first["especialista"], first["coordinador_directo"]
            found = {"especialista": f"coalesce(CASE WHEN {ask} AND {a} IS NOT NULL THEN b.especialista END, 'NO APLICA')",
                     "coordinador_directo": f"coalesce(CASE WHEN {ask} AND {a} IS NULL AND {b} IS NOT NULL THEN b.especialista END, 'NO APLICA')"}
        if layout.required:
            where = " AND ".join(f"b.{c} IS NOT NULL" for c in layout.required if c != "especialista")
    cols = {}
    for c in dict.fromkeys([*G.DOMAINS, *G.ROLES, *G.FACT, *layout.extra]):
        if c in layout.fixed:
            cols[c] = f"'{layout.fixed[c]}'"
        elif c in found:
            cols[c] = _clean(found[c])
        elif c in by_column:
            cols[c] = f"coalesce({_clean('b.' + c)}, 'NO APLICA')" if c in ("area", "coordinador_directo") else _clean("b." + c)
        elif c == "fuente":
            cols[c] = f"'{layout.source}'"
        elif c == "fecha_retiro_area":
            cols[c] = "'1900-01-01'"
        elif c in G.ABSENT or c in G.DOMAINS or c in G.ROLES:
            cols[c] = f"'{G.ABSENT.get(c, 'NO APLICA')}'"
        else:
            cols[c] = "CAST(NULL AS VARCHAR)"
    domains = " UNION ".join(f"SELECT '{c}' AS dominio, {c} AS valor FROM n" for c in G.DOMAINS)
    ident = "CASE WHEN length(identificacion) IN (9, 11) AND starts_with(identificacion, '1') THEN substring(identificacion, 2) ELSE identificacion END"
    ids = [f"(SELECT id FROM dom WHERE dominio = '{c}' AND dom.valor = n.{c}) AS {out}" if out != "id_tipo_documento" else
           f"coalesce((SELECT id FROM dom WHERE dominio = '{c}' AND dom.valor = n.{c}), 3) AS {out}" for c, out in G.DOMAINS.items()]
    roles = [f"CASE WHEN n.{r} NOT IN ('', 'NO APLICA') THEN upper(md5('7:PERSONA{len(r)}:{r}' || CAST(length({_unmarked('n.' + r)}) AS VARCHAR) || ':' || {_unmarked('n.' + r)})) END AS id_{r}"
             for r in G.ROLES]
    plain = [c for c in G.FACT if c not in ("tipo_documento", "identificacion", "nombre_completo")]
    extra = [c for c in layout.extra if c != "dealer"]
    dealer = "dealer" if "dealer" in layout.extra else f"right({ident}, 8)"
    state = "4" if layout.retired else "CASE WHEN contains(nombre_completo, '(VACANTE)') THEN 4 ELSE 1 END"
    return f"""
WITH b AS (SELECT {raw} FROM supplier JOIN nation ON n_nationkey = s_nationkey),
n AS (SELECT {", ".join(f"{e} AS {c}" for c, e in cols.items())} FROM b WHERE {where}),
dom AS (SELECT dominio, valor, CAST(row_number() OVER (PARTITION BY dominio ORDER BY valor) AS BIGINT) AS id
        FROM ({domains}) WHERE valor IS NOT NULL AND valor NOT IN ('', 'NO APLICA'))
SELECT {ident} AS identificacion, {_unmarked('nombre_completo')} AS nombre_completo, {", ".join(plain)}, {", ".join(ids)}, {", ".join(roles)},
       {dealer} AS dealer{"".join(", " + c for c in extra)}, {state} AS id_estado_registro, 2 AS version
FROM n
"""


def _run_sheet(spark, sf_dir, sheet: str):
    t = Tables(spark, sf_dir)
    run = Run(job="org_chart", run_id=f"RUN-ORG-{sheet.upper()}", started=_dt.datetime(2024, 4, 1))
    layout = G.LAYOUTS[sheet]
    rows = t.supplier.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    landed = rows.select(*[F.expr(e).alias(h) for h, e in _values(sheet).items()])
    staff = {c: spark.sql(_staff_sql(c).replace("FROM supplier", "FROM {s}"), s=t.supplier) for c in ("especialista", "coordinador_directo")}
    norm = commit(G.normalise(landed, layout, staff["especialista"], staff["coordinador_directo"]))
    domains = commit(G.domain_rows([norm], spark.createDataFrame([], "dominio string, valor string, id bigint")))        # C10
    persons = commit(G.people({sheet: norm}, spark.createDataFrame([], "rol string, nombre string")))                      # C10
    return G.fact(norm, layout, domains, persons, 2, run).drop("id")


for _name in G.LAYOUTS:
    query(f"job_org_{_name}", "G14 A4 N6 W6 N7 N14 A3 N11 N12 X8 X13 X14 X15 C1 C10" + (" N16" if G.LAYOUTS[_name].assign else "")
          + (" C11" if G.LAYOUTS[_name].retired else ""), sql=_oracle(_name))(lambda spark, sf_dir, sheet=_name: _run_sheet(spark, sf_dir, sheet))


_TITLES = "concat('x ', CASE s_suppkey % 4 WHEN 0 THEN 'JEFE' WHEN 1 THEN 'Coordinador Directo' WHEN 2 THEN 'gerente' ELSE 'consultor' END)"
_NAMES = "CASE WHEN s_acctbal < 2000 THEN concat(s_name, ' (VACANTE)') ELSE s_name END"


@query("org_vacancies_retired", "C7 G14", sql=f"""
WITH stored AS (SELECT rol, s_name AS nombre, CASE WHEN s_suppkey % 9 = 0 THEN 4 ELSE 1 END AS id_estado_registro
                FROM supplier, (VALUES ('jefe'), ('coordinador_directo'), ('gerente'), ('director')) r(rol)),
sheet AS (SELECT {_TITLES} AS cargo, s_name AS nombre FROM supplier WHERE s_acctbal < 2000),
gone AS (SELECT 'jefe' AS rol, nombre FROM sheet WHERE lower(cargo) LIKE '%jefe%'
         UNION SELECT 'coordinador_directo', nombre FROM sheet WHERE lower(cargo) LIKE '%coordinador%'
         UNION SELECT 'gerente', nombre FROM sheet WHERE lower(cargo) LIKE '%gerente%')
SELECT rol, nombre, CASE WHEN EXISTS (SELECT 1 FROM gone g WHERE g.rol = s.rol AND g.nombre = s.nombre) THEN 4 ELSE id_estado_registro END AS id_estado_registro
FROM stored s
""")
def org_vacancies_retired(spark, sf_dir):
    """Stored persons of three roles whose post a sheet shows as vacant."""
    s = Tables(spark, sf_dir).supplier
    roles = F.explode(F.array(*[F.lit(r) for r in ("jefe", "coordinador_directo", "gerente", "director")]))
    stored = s.select(roles.alias("rol"), F.col("s_name").alias("nombre"), F.when(F.col("s_suppkey") % 9 == 0, 4).otherwise(1).alias("id_estado_registro"))
    sheet = s.select(F.expr(_TITLES).alias("cargo_actual"), F.expr(_NAMES).alias("nombre_completo"))
    return G.retire_vacated(stored, {"red_maestra": sheet.filter("s_suppkey % 2 = 0"), "cavs": sheet.filter("s_suppkey % 2 = 1")})


#: Loaders whose rows are counted against their ids.
ID_LOADERS = ["job_order_loader", "job_value_added", "job_targets"]


def _ids_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS cargador, count(*) AS filas, count(*) AS ids FROM ({REGISTRY[n].sql})" for n in ID_LOADERS)


@query("row_ids", "X44 W7 C1", sql=_ids_sql())
def row_ids(spark, sf_dir):
    """Rows and distinct ids as the loaders return them, also where keys and
    rows repeat."""
    from ledgerline.operators.setops import union_all
    from ledgerline.plans import q_jobs as jobs, q_loaders as single
    t = Tables(spark, sf_dir)
    built = {"job_order_loader": jobs.order_loader_rows(t), "job_value_added": single.value_added_rows(t), "job_targets": jobs.targets_rows(t)}
    counts = []
    for name in ID_LOADERS:
        # Ids hardly repeat, so they are brought together before they are counted.
        ids = built[name].select("id").repartition("id")
        counts.append(ids.groupBy(F.lit(name).alias("cargador"), "id").agg(F.count(F.lit(1)).alias("n"))
                      .groupBy("cargador").agg(F.sum("n").alias("filas"), F.count(F.lit(1)).alias("ids")))
    return union_all(counts)
