"""Config-driven loader run: first load, re-run adds nothing, audit rows."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ledgerline.jobs import order_loader as g1
from ledgerline.jobs.run import run_config
from ledgerline.operators.lifecycle import Run
from ledgerline.plans.catalog import Tables
from tests.conftest import SF001


def test_json_configured_loader(spark, tmp_dir):
    landed = os.path.join(tmp_dir, "landed")
    g1.demo_landed(Tables(spark, SF001).lineitem).write.parquet(landed)
    c = g1.DEMO_CONFIG
    cfg = {"source": c.source, "input": landed, "format": "parquet", "rename": c.rename, "key": c.key,
           "amount": c.amount, "defaults": c.defaults, "time_columns": c.time_columns,
           "date_columns": c.date_columns, "required": c.required,
           "target": os.path.join(tmp_dir, "target"), "audit": os.path.join(tmp_dir, "audit")}
    cfg = json.loads(json.dumps(cfg))  # round-trips as a JSON file would
    n1 = run_config(spark, cfg, Run(job="t", run_id="R1", started=dt.datetime(2024, 1, 1)))
    landed_df = spark.read.parquet(landed)
    assert n1 == landed_df.filter(F.coalesce(F.col("valor"), F.lit(0.0)) > 0).count()
    n2 = run_config(spark, cfg, Run(job="t", run_id="R2", started=dt.datetime(2024, 1, 2)))
    assert n2 == 0
    audit = sorted((r["id_ejecucion"], r["cantidad_registros"]) for r in spark.read.parquet(cfg["audit"]).collect())
    assert audit == [("R1", n1), ("R2", 0)]


def test_json_configured_csv_loader(spark, tmp_dir):
    landed = os.path.join(tmp_dir, "csv")
    os.makedirs(landed)
    with open(os.path.join(landed, "f.csv"), "w", encoding="latin-1") as fh:
        fh.write("CUENTA;OT;CODIGO;VALOR;NOMBRE\n1;10;A;5.5; José \n1;10;A;5.5;dup\n2;20;B;0;cero\n3;30;C;;nulo\n")
    cfg = {"source": "CSV", "input": landed, "format": "csv",
           "read_options": {"header": "true", "sep": ";", "encoding": "ISO-8859-1"},
           "schema": "CUENTA BIGINT, OT BIGINT, CODIGO STRING, VALOR DOUBLE, NOMBRE STRING",
           "rename": {"CUENTA": "cuenta", "OT": "ot", "CODIGO": "codigo", "VALOR": "valor", "NOMBRE": "nombre"},
           "key": ["cuenta", "ot", "codigo"], "amount": "valor", "required": ["CUENTA", "OT", "CODIGO"],
           "target": os.path.join(tmp_dir, "t"), "audit": os.path.join(tmp_dir, "a")}
    n = run_config(spark, cfg, Run(job="csv", run_id="C1", started=dt.datetime(2024, 1, 1)))
    got = sorted((r["cuenta"], r["nombre"]) for r in spark.read.parquet(cfg["target"]).collect())
    assert n == 2 and got == [(1, "DUP"), (1, "JOSÉ")]   # zero/null amounts dropped, in-batch duplicates kept


def test_an_unreadable_target_stops_the_load(spark, tmp_dir):
    import pytest
    landed = os.path.join(tmp_dir, "landed")
    g1.demo_landed(Tables(spark, SF001).lineitem).limit(50).write.parquet(landed)
    c = g1.DEMO_CONFIG
    target = os.path.join(tmp_dir, "target")
    os.makedirs(target)
    with open(os.path.join(target, "part-0.parquet"), "wb") as fh:
        fh.write(b"broken")
    cfg = {"source": c.source, "input": landed, "rename": c.rename, "key": c.key, "amount": c.amount, "defaults": c.defaults,
           "time_columns": c.time_columns, "date_columns": c.date_columns, "target": target, "audit": os.path.join(tmp_dir, "audit")}
    with pytest.raises(Exception):
        run_config(spark, cfg, Run(job="t", run_id="R1", started=dt.datetime(2024, 1, 1)))
    assert os.listdir(target) == ["part-0.parquet"] and not os.path.exists(cfg["audit"])  # nothing was loaded


def test_ledgered_loader_takes_each_file_once(spark, tmp_dir, monkeypatch):
    """Late files, repeated runs, and runs killed before and after the commit."""
    import pytest

    from ledgerline.jobs import run as R
    from ledgerline.operators import key_index
    from ledgerline.sources import commits
    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)

    def land(name, lines, when):
        p = os.path.join(landing, name)
        with open(p, "w", encoding="latin-1") as fh:
            fh.write("\n".join(["CUENTA;OT;VALOR", *lines]) + "\n")
        os.utime(p, (when, when))
    cfg = {"source": "CSV", "input": landing, "format": "csv", "read_options": {"header": "true", "sep": ";"}, "ledger": True, "pattern": "*.csv",
           "schema": "CUENTA BIGINT, OT BIGINT, VALOR DOUBLE", "rename": {"CUENTA": "cuenta", "OT": "ot", "VALOR": "valor"}, "key": ["cuenta", "ot"],
           "amount": "valor", "target": os.path.join(tmp_dir, "t"), "buckets": 4}

    def load(k):
        return run_config(spark, cfg, Run(job="csv", run_id=f"R{k}", started=dt.datetime(2024, 1, k)))

    def rows():
        return sorted((r["cuenta"], r["ot"], r["id_ejecucion"]) for r in commits.read_committed(spark, cfg["target"]).collect())
    assert load(1) == 0
    land("b.csv", ["1;10;5", "1;10;5", "2;20;0"], 1_700_000_000)
    with monkeypatch.context() as m:  # killed before the commit
        m.setattr(commits, "claim", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            load(2)
    assert load(3) == 2 and load(4) == 0
    land("a.csv", ["1;10;5", "3;30;1"], 1_600_000_000)  # late; one key is known
    assert load(5) == 1
    land("c.csv", ["3;30;1", "4;40;1"], 1_700_000_001)
    with monkeypatch.context() as m:  # the index is written with the next load only, and that one dies
        m.setattr(key_index.KeyIndex, "catch_up", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            load(6)
    assert load(7) == 1 and load(8) == 0
    assert rows() == [(1, 10, "R3"), (1, 10, "R3"), (3, 30, "R5"), (4, 40, "R7")]
    assert sorted(r["cantidad_registros"] for r in commits.audit(spark, cfg["target"]).collect()) == [1, 1, 2]
    assert R.run_ledgered(spark, cfg, Run(job="csv", run_id="R9")) == 0
