"""Sources and sinks (S1-S19, C2-C4) in a temporary folder; no servers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.jobs import order_loader as g1
from ledgerline.operators.columns import MissingColumnsError
from ledgerline.operators.lifecycle import Run
from ledgerline.plans.catalog import Tables
from ledgerline.sources import readers, sinks
from tests.conftest import SF001


def test_landed_table_with_position_and_tag(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k int, v string").coalesce(1).write.parquet(p)
    df = readers.read_landed(spark, p, source_tag="HOJA 1", with_position=True)
    r = df.orderBy("_ingest_pos").collect()
    assert [x["k"] for x in r] == list(range(5))
    assert {x["fuente"] for x in r} == {"HOJA 1"} and r[0]["_ingest_pos"]["file"].endswith(".parquet")


def test_headered_csv_semicolon_latin1(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c", "f.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w", encoding="latin-1") as fh:
        fh.write("Cuenta;Ciudad\n1;Bogotá\n2;Medellín\n")
    df = readers.read_headered_csv(spark, p)
    assert sorted(r["Ciudad"] for r in df.collect()) == ["Bogotá", "Medellín"]


def _set_mtime(folder, when):
    ts = when.timestamp()
    for root, _, files in os.walk(folder):
        for f in files:
            os.utime(os.path.join(root, f), (ts, ts))


def test_freshness_gate_and_newest_file(spark, tmp_dir):
    # Explicit modification times: the test must not depend on the wall clock.
    base = os.path.join(tmp_dir, "land")
    spark.createDataFrame([(1,)], "k int").write.parquet(os.path.join(base, "metas_old"))
    spark.createDataFrame([(2,)], "k int").write.parquet(os.path.join(base, "metas_new"))
    _set_mtime(os.path.join(base, "metas_old"), dt.datetime(2020, 1, 1))
    _set_mtime(os.path.join(base, "metas_new"), dt.datetime(2030, 1, 1))
    fresh = readers.modified_since(spark, base + "/*", "2025-01-01T00:00:00")
    assert [r["k"] for r in fresh.collect()] == [2]
    newest = readers.newest_file(spark, base + "/*", pattern="*.parquet")
    assert [r["k"] for r in newest.collect()] == [2]


def test_business_rules_table(spark):
    params = spark.createDataFrame([("valor_paq_mb", "2000"), ("excluidos_mb", "['A', 'B C']")],
                                   "nombre string, valor string")
    assert readers.rule_value(params, "valor_paq_mb") == "2000"
    arr = readers.business_rules(params).filter(F.col("nombre") == "excluidos_mb").first()["valores"]
    assert arr == ["A", "B C"]
    from ledgerline.jobs.white_label import rules_from_table
    rules = rules_from_table(params, "2024-12")
    assert rules.min_value == 2000.0 and rules.excluded == ["A", "B C"]


def test_jdbc_options_come_from_environment(monkeypatch):
    monkeypatch.setenv("WAREHOUSE_URL", "jdbc:postgresql://example/db")
    monkeypatch.setenv("WAREHOUSE_USER", "reader")
    opts = readers.jdbc_options("WAREHOUSE")
    assert opts == {"url": "jdbc:postgresql://example/db", "user": "reader"}


def test_required_columns_fail_by_name(spark):
    li = Tables(spark, SF001).lineitem.drop("l_returnflag")
    with pytest.raises(MissingColumnsError, match="l_returnflag"):
        g1.transform(g1.demo_landed(Tables(spark, SF001).lineitem).drop("l_returnflag"),
                     g1.demo_history(li.withColumn("l_returnflag", F.lit("x"))), g1.DEMO_CONFIG, g1.DEMO_RUN)


def test_run_loader_appends_then_audits(spark, tmp_dir):
    li = Tables(spark, SF001).lineitem
    batch = g1.demo_landed(li.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    target, audit, errors = (os.path.join(tmp_dir, x) for x in ("target", "audit", "errors"))
    run = Run(job="g1", run_id="RUN-A", started=dt.datetime(2024, 1, 1))
    n = g1.run_loader(batch, g1.demo_history(li), g1.DEMO_CONFIG, run, target, audit, errors)
    written = spark.read.parquet(target)
    assert written.count() == n > 0
    assert "fecha_carga" in written.columns
    a = spark.read.parquet(audit).first()
    assert a["cantidad_registros"] == n and a["id_ejecucion"] == "RUN-A"
    # second run of the same batch against the loaded target: nothing new
    hist = g1.demo_history(li).unionByName(written.select("cuenta", "ot", "codigo_servicio"))
    run2 = Run(job="g1", run_id="RUN-B", started=dt.datetime(2024, 1, 2))
    assert g1.run_loader(batch, hist, g1.DEMO_CONFIG, run2, target, audit, errors) == 0
    # a failing run writes one error row and nothing else
    with pytest.raises(Exception):
        g1.run_loader(batch.drop("l_linenumber"), hist, g1.DEMO_CONFIG, run2, target, audit, errors)
    e = spark.read.parquet(errors).collect()
    assert len(e) == 1 and len(e[0]["descripcion_error"]) <= 100
    assert spark.read.parquet(audit).count() == 2


def test_csv_copy_and_snapshot(spark, tmp_dir):
    df = Tables(spark, SF001).region
    sinks.write_csv_copy(df, os.path.join(tmp_dir, "copy"))
    back = spark.read.option("header", True).option("sep", ";").csv(os.path.join(tmp_dir, "copy"))
    assert back.count() == df.count()
    sinks.write_snapshot(df, os.path.join(tmp_dir, "snap"), 3)
    assert spark.read.parquet(os.path.join(tmp_dir, "snap")).select("version").distinct().first()[0] == 3


def test_position_is_file_order_however_files_are_split(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c")
    spark.range(20000).selectExpr("id AS k", "repeat('x', 40) AS pad").coalesce(1).write.csv(p)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20000", keep):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = readers.read_landed(spark, p, fmt="csv", with_position=True)
            assert df.rdd.getNumPartitions() > 4 or size == keep
            assert [int(r[0]) for r in df.orderBy("_ingest_pos").select("_c0").collect()] == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_missing_empty_and_unreadable_tables(spark, tmp_dir):
    assert readers.read_existing(spark, os.path.join(tmp_dir, "none")) is None
    os.makedirs(os.path.join(tmp_dir, "empty", "_temporary"))
    assert readers.read_existing(spark, os.path.join(tmp_dir, "empty")) is None
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as fh:
        fh.write(b"this is no parquet file")
    with pytest.raises(Exception):
        readers.read_existing(spark, bad).count()


def test_jdbc_history_reads_are_split(spark):
    with pytest.raises(ValueError, match="partition_column"):
        readers.read_jdbc(spark, {"url": "jdbc:none"}, table="t")
    with pytest.raises(ValueError, match="either"):
        readers.read_jdbc(spark, {"url": "jdbc:none"}, partition_column="id")


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from ledgerline.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="share"):
        ensure_checkpoint_dir(Session())


def test_loaded_today_reads_one_partition(spark, tmp_dir):
    import contextlib
    import io
    from ledgerline.operators.incremental import already_loaded
    p = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 5))], "k int, fecha_procesamiento timestamp_ntz")
    sinks.append_table(df, p)
    table = spark.read.parquet(p)
    assert already_loaded(table, dt.date(2024, 1, 2)) and not already_loaded(table, "2024-01-03")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        table.filter(F.col("fecha_carga") == F.lit("2024-01-02").cast("date")).explain("formatted")
    assert "PartitionFilters: [isnotnull(fecha_carga" in out.getvalue()
