"""Single-source loaders on small synthetic fixtures (FIXTURES.md §1)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerline.jobs import loaders as L
from ledgerline.operators.lifecycle import Run

RUN = Run(job="t", run_id="RUN-T", started=dt.datetime(2024, 5, 1))


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def test_upsell_csv_latin1_cut_and_new_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "up", "f.csv")
    _write(p, "1,10,SVÑ,5.0,4.0,OLD,UP,x,y,z\n2,20,svb,0,1,OLD,UP,x\n3,30, svc ,7.5,1,OLD,DOWN\n", "latin-1")
    hist = spark.createDataFrame([(3, 30, " svc ")], "cuenta bigint, ot bigint, service_code string")
    out = L.upsell_csv(spark, p, hist, RUN, "UPSELL")
    got = out.select("cuenta", "service_code").collect()
    assert [tuple(r) for r in got] == [(1, "SVÑ")]
    assert out.columns[:2] == ["id", "id_ejecucion"]
    assert "_c7" not in out.columns


def test_sales_csv_day_first_and_bad_dates(spark, tmp_dir):
    p = os.path.join(tmp_dir, "sales", "f.csv")
    lines = []
    for cuenta, d, m, v in [(1, 13, 2, "10"), (2, 5, 3, "20"), (3, 31, 2, "30"), (4, 1, 1, "0")]:
        row = [str(cuenta), "7", "20", "2024", str(d), str(m)] + ["x"] * 5 + ["COD"] + ["x", "2", "x", "12", "99", v]
        lines.append(",".join(row))
    _write(p, "\n".join(lines) + "\n")
    hist = spark.createDataFrame([], "cuenta bigint, ot bigint, codigo_servicio_ad string")
    out = L.sales_csv(spark, p, hist, RUN, "VENTAS")
    got = {r["cuenta"]: r["fecha"] for r in out.collect()}
    assert got == {1: dt.date(2024, 2, 13), 2: dt.date(2024, 3, 5), 3: None}


def test_cloud_sales_rules(spark):
    df = spark.createDataFrame([
        ("K1", "Negocios Pyme", "activo parallels", "Activo", "123", "0", " si ", " ana  maria "),
        ("K2", "negocios", "Activo Parallels", "ACTIVO", "12a", "55", "tal vez", "x"),
        ("K3", "hogar", "Activo Parallels", "Activo", "1", "1", "SI", "y"),
        ("K4", "negocios", None, "Activo", "1", "1", "SI", "z"),
    ], "llave string, segmento_de_alta string, estado_inicial string, estado_final string, "
       "valor_unitario_sin_iva string, cedula_comercial string, reto_estrategico string, nombres string")
    hist = spark.createDataFrame([("K9",)], "llave string")
    out = {r["llave"]: r for r in L.cloud_sales(df, hist, RUN).collect()}
    assert set(out) == {"K1", "K2"}
    assert out["K1"]["valor_unitario_sin_iva"] == 123 and out["K2"]["valor_unitario_sin_iva"] == 0
    assert out["K1"]["cedula_comercial"] == 11
    assert out["K1"]["reto_estrategico"] == "SI" and out["K2"]["reto_estrategico"] == "NO"
    assert out["K1"]["nombres"] == "ANAMARIA"  # P8: the double space is deleted


def test_code_master_and_nodes(spark):
    cm = spark.createDataFrame([("A1", "soporte pc", None, "12"), ("A2", "otro", "X", "n/a"),
                                ("A3", None, "Y", "3")], "saserv string, saname string, clasificacion string, "
                                                          "capacidad_navegacion string")
    hist = spark.createDataFrame([("A3",)], "saserv string")
    got = {r["saserv"]: r for r in L.code_master(cm, hist, RUN, "MAESTRO").collect()}
    assert set(got) == {"A1", "A2"}
    assert got["A1"]["soporte_pc"] is False and got["A2"]["soporte_pc"] is True
    assert got["A1"]["clasificacion"] == "NO REGISTRA" and got["A2"]["capacidad_navegacion"] == 0
    nodes = spark.createDataFrame([("N1", "ANTIOQUIA", "C" * 12, "x" * 60, "7.0"), ("N2", None, None, None, "abc")],
                                  "id_nodo string, departamento string, codigo string, nombre_nodo string, largo string")
    got = {r["id_nodo"]: r for r in L.network_nodes(nodes, hist.withColumnRenamed("saserv", "id_nodo"), RUN, "RED")
           .collect()}
    assert got["N1"]["departamento"] == "AN" and len(got["N1"]["codigo"]) == 10 and len(got["N1"]["nombre_nodo"]) == 50
    assert got["N1"]["largo"] == 7 and got["N2"]["largo"] == 0 and got["N2"]["departamento"] == "0"


def test_reference_list_separator_free_collisions(spark):
    df = spark.createDataFrame([("1", "23", "a", 0, 45641.0), ("12", "3", "b", 1, 45642.0), ("1", "23", "c", 2, 1.0)],
                               "`Razon Inicial` string, Tipo string, TD string, _ingest_pos int, Fecha double")
    hist = spark.createDataFrame([("12", "3")], "razon_inicial string, tipo string")
    out = L.reference_list(df, hist, RUN, "CAUSALES", ["razon_inicial", "tipo"], ("fecha",))
    rows = [(r["razon_inicial"], r["tipo"], r["td"], r["fecha"]) for r in out.collect()]
    assert rows == [("1", "23", "a", dt.date(2024, 12, 15))]


def test_legalised_three_layouts(spark):
    a = spark.createDataFrame([("C1", 10, 45641.5, 0), ("C2", 10, 45000.0, 1), ("C3", None, 1.0, 2)],
                              "Cuenta string, OT bigint, `Fecha Ultimo Estado` double, _ingest_pos int")
    b = spark.createDataFrame([("I1", 20, "2024-01-02", 0)], "ID string, OT bigint, `FECHA DE LEGALIZACION` string, "
                                                             "_ingest_pos int")
    c = spark.createDataFrame([("C9", 30, "15/12/2024 10:30", 0), ("C8", 40, "bad", 1)],
                              "Cuenta string, `O.T.` bigint, `Fecha último estado` string, _ingest_pos int")
    hist = spark.createDataFrame([(40,)], "ot bigint")
    out = {r["ot"]: r for r in L.legalised(a, b, c, hist, RUN).collect()}
    assert set(out) == {10, 20, 30}
    assert out[10]["cuenta"] == "C1" and out[10]["fecha"] == dt.date(2024, 12, 15)
    assert out[30]["fecha"] == dt.date(2024, 12, 15)


def test_virtual_db_orders(spark):
    df = spark.createDataFrame([(1, 5, "A@B.CO..", "3.1.2", "ok", "act"), (2, 0, "x", "1", "ok", "a"),
                                (3, -2, "y@z.co", "9", "**borrar", "a"), (4, 1, None, None, None, "a")],
                               "OT bigint, aumento int, EMAIL string, telefono string, observacion string, estado string")
    hist = spark.createDataFrame([(4,)], "ot bigint")
    out = {r["ot"]: r for r in L.virtual_db_orders(df, hist, RUN, "RR", {"OT": "ot", "EMAIL": "email"}, ["ot"])
           .collect()}
    assert set(out) == {1}
    assert out[1]["email"] == "a@b.co" and out[1]["telefono"] == "312" and out[1]["estado"] == "ACT"


def test_value_added_roles_and_state_of_earlier_loads(spark):
    from ledgerline.operators.lifecycle import current_state
    roles = L.VALUE_ADDED_ROLES
    df = spark.createDataFrame([tuple([" ana (VACANTE) "] * 5) + ("  x ", None, dt.date(2024, 1, 5)), tuple(["LUIS"] * 4 + [None]) + (None, 2.0, None)],
                               ", ".join(f"{r} string" for r in roles) + ", producto string, cfm double, fecha date")
    names = spark.createDataFrame([("ANA", 9, 1), ("ANA", 7, 2), ("PEDRO", 8, 3)], "nombre string, id int, orden int")
    people = {r: names for r in roles}
    first = L.value_added(df, people, RUN, ["cfm"], ["fecha"])
    got = sorted((r["producto"], r["cfm"], r["fecha"], r["id_coordinador"], r["id_gerente"]) for r in first.collect())
    assert got == [("", 2.0, None, None, None), ("X", 0.0, "2024-01-05", 7, 7)]  # the last of a repeated name; no default
    second = L.value_added(df, people, Run(job="t", run_id="RUN-2", started=dt.datetime(2024, 5, 2)), ["cfm"], ["fecha"])
    table = first.unionByName(second)
    states = sorted((r["id_ejecucion"], r["id_estado"]) for r in current_state(table).collect())
    assert states == [("RUN-2", "1"), ("RUN-2", "1"), ("RUN-T", "4"), ("RUN-T", "4")]


def test_bad_text_is_no_error(spark):
    from ledgerline.functions.predicates import positive_amount
    df = spark.createDataFrame([("1.5",), ("n/a",), ("0",), (None,), ("-2",)], "v string")
    assert [r["v"] for r in df.filter(positive_amount("v")).collect()] == ["1.5"]
    a = spark.createDataFrame([("c", "7", 45000.5, 1), ("c", "x7", 45000.5, 2)], "Cuenta string, OT string, `Fecha Ultimo Estado` double, _ingest_pos int")
    b = spark.createDataFrame([("i", "8", "not a date", 1)], "ID string, OT string, `FECHA DE LEGALIZACION` string, _ingest_pos int")
    c = spark.createDataFrame([("k", "n/a", "1/2/2024 10:00", 1)], "Cuenta string, `O.T.` string, `Fecha último estado` string, _ingest_pos int")
    out = L.legalised(a, b, c, spark.createDataFrame([], "ot bigint"), RUN).collect()
    assert sorted((r["layout"], r["ot"], r["fecha"]) for r in out) == [(1, 7, dt.date(2023, 3, 15)), (2, 8, None)]


def test_cloud_document_zero_and_bad_documents(spark):
    row = ("K", "Negocios", "Activo Parallels", "Activo", "1", "SI")
    df = spark.createDataFrame([(*row, d) for d in ("0", "n/d", "12", None)],
                               "llave string, segmento_de_alta string, estado_inicial string, estado_final string, "
                               "valor_unitario_sin_iva string, reto_estrategico string, cedula_comercial string")
    out = L.cloud_sales(df, spark.createDataFrame([], "llave string"), RUN).collect()
    assert sorted(r["cedula_comercial"] for r in out) == [0, 0, 11, 12]


def test_dashboard_csv_rejects_and_loaded_days(spark, tmp_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    p = os.path.join(tmp_dir, "dash", "f.csv")
    _write(p, "tipo;cant;fecha\nA;1;2024-01-01\nB;x;2024-01-02\nC;3;2024-01-03;extra;cols\nD;4;2024-01-03\n")
    schema = StructType([StructField("tipo", StringType()), StructField("cant", StringType()),
                         StructField("fecha", StringType())])
    hist = spark.createDataFrame([(dt.date(2024, 1, 1),)], "fecha_dia date")
    good, bad = L.dashboard_csv(spark, p, schema, {"cant": "bigint"}, hist, RUN)
    got = sorted((r["tipo"], r["cant"]) for r in good.collect())
    assert got == [("B", 0), ("D", 4)]
    assert bad.count() == 1
