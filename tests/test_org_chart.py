"""G14 on a small staff sheet (FIXTURES.md: staff_sheet, domain_tables)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerline.jobs import org_chart as g14
from ledgerline.operators.lifecycle import Run

RUN = Run(job="org", run_id="RUN-ORG", started=dt.datetime(2024, 4, 1))
COLS = "NOMBRE string, `No DOCUMENTO` string, `CARGO ACTUAL` string, SEGMENTO string, CANAL string, `NOMBRE JEFE` string"


def sheet(spark):
    return spark.createDataFrame([
        ("ANA PEREZ", "11234567890", "Jefe Zona", "PYME", "DIRECTO", "ANA PEREZ"),
        ("LUIS (VACANTE)", "123456789", "Jefe Zona", "PYME", "DIRECTO", "ANA PEREZ"),
        ("EVA", "987654321", "consultor", "NO APLICA", " directo ", "JUAN NADIE"),
        ("OTTO", "55", "consultor", "EMPRESAS", None, "LUIS"),
    ], COLS)


def test_domains_persons_and_fact(spark, tmp_dir):
    s = sheet(spark)
    existing = spark.createDataFrame([("segmento", "PYME", 10), ("canal", "AAA", 3)], "dominio string, valor string, id int")
    new = g14.domain_updates(s, existing, RUN)
    got = sorted((r["dominio"], r["valor"], r["id"]) for r in new.collect())
    assert got == [("canal", "DIRECTO", 4), ("cargo", "CONSULTOR", 1), ("cargo", "JEFE ZONA", 2),
                   ("segmento", "EMPRESAS", 11)]
    domains = g14.materialise(existing.unionByName(new.select("dominio", "valor", "id").withColumn("id", F.col("id").cast("int"))),
                              os.path.join(tmp_dir, "dom"))
    persons_old = spark.createDataFrame([("LUIS", "23456789", 1), ("OLD", "1", 1)],
                                        "nombre string, identificacion string, id_estado_registro int")
    fresh, updated = g14.person_updates(s, persons_old, RUN)
    assert [r["nombre"] for r in fresh.collect()] == ["ANA PEREZ"]
    assert fresh.first()["identificacion"] == "1234567890"
    assert {r["nombre"]: r["id_estado_registro"] for r in updated.collect()} == {"LUIS": 4, "OLD": 1}
    persons = fresh
    fact = {r["nombre_completo"]: r for r in g14.build_fact(s, domains, persons, 3, "RED", RUN).collect()}
    assert fact["LUIS"]["id_estado_registro"] == 4 and fact["ANA PEREZ"]["id_estado_registro"] == 1
    assert fact["LUIS"]["identificacion"] == "23456789"
    assert fact["EVA"]["id_segmento"] is None          # NO APLICA never becomes a domain value
    assert fact["EVA"]["id_canal"] == 4 and fact["EVA"]["id_jefe"] is None
    assert fact["OTTO"]["id_jefe"] is None and fact["ANA PEREZ"]["id_jefe"] == fresh.first()["id_persona"]
    assert fact["ANA PEREZ"]["codigo_dealer"] == "34567890"
    assert {r["version"] for r in fact.values()} == {3}


def test_retired_sheet_marks_everyone_inactive(spark):
    s = sheet(spark)
    dom = spark.createDataFrame([], "dominio string, valor string, id int")
    per = spark.createDataFrame([], "rol string, id_persona string, nombre string")
    fact = g14.build_fact(s, dom, per, 1, "RETIRO", RUN, retired_sheet=True)
    assert {r["id_estado_registro"] for r in fact.collect()} == {4}


def test_retail_and_direct_assignment_by_partial_name(spark):
    specialists = spark.createDataFrame([("MARIA JOSE PEREZ", 1), ("ANA MARIA", 2)], "nombre string, orden int")
    coordinators = spark.createDataFrame([("LUIS CARLOS ROJAS", 1), ("maria elena", 2)], "nombre string, orden int")
    sheet = spark.createDataFrame([(1, "maria"), (2, "carlos"), (3, ""), (4, None), (5, "pedro")],
                                  "fila int, NOMBRE_BUSCADO string")

    def run(exclusive):
        out = g14.assign_by_name(sheet, "NOMBRE_BUSCADO", specialists, coordinators, exclusive=exclusive)
        return {r["fila"]: (r["especialista"], r["coordinador_directo"]) for r in out.collect()}

    ind = run(False)
    assert ind[1] == ("MARIA JOSE PEREZ", "maria elena")
    assert ind[2] == ("NO APLICA", "LUIS CARLOS ROJAS")
    assert ind[3] == ind[4] == ind[5] == ("NO APLICA", "NO APLICA")
    exc = run(True)
    assert exc[1] == ("maria", "NO APLICA")
    assert exc[2] == ("NO APLICA", "carlos")
    assert exc[3] == exc[5] == ("NO APLICA", "NO APLICA")


def test_heads_have_the_document_beside_their_name(spark):
    """Commercial intelligence: a head without a row of its own."""
    from ledgerline.jobs import org_layouts as G
    rows = [("CC", "111222333", "ANA", "JEFE DE ZONA", "LUIS", "900100200"), ("CC", "444", "LUISA", "CONSULTOR", "ANA", "555"), ("CC", "777", "EVA", "CONSULTOR", "SIN DOC", None)]
    sheet = spark.createDataFrame(rows, "`TIPO DOCUMENTO` string, `No DOCUMENTO` string, NOMBRE string, `CARGO ACTUAL` string, `NOMBRE JEFE` string, `DOCUMENTO JEFE` string")
    norm = G.normalise(sheet, G.LAYOUTS["inteligencia"])
    found = {r["nombre"]: r["identificacion"] for r in G.people({"inteligencia": norm}, spark.createDataFrame([], "rol string, nombre string")).collect() if r["rol"] == "jefe"}
    assert found == {"LUIS": "900100200", "ANA": "11222333", "SIN DOC": G.UNKNOWN_DOCUMENT}
    gone = {r["nombre"]: r["id_estado_registro"] for r in G.retire_vacated(
        spark.createDataFrame([("jefe", "ANA", 1), ("jefe", "EVA", 1)], "rol string, nombre string, id_estado_registro int"),
        {"inteligencia": norm.withColumn("nombre_completo", norm["nombre_completo"])}).collect()}
    assert gone == {"ANA": 1, "EVA": 1}
