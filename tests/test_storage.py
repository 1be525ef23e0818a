"""Committed loads, claimed versions, file ledger, key index, state log."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import state_log
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.key_index import KeyIndex
from ledgerline.operators.lifecycle import Run, numbered_copies, with_row_ids
from ledgerline.operators.staging import broadcast_if_small, staged_measured
from ledgerline.sources import commits, ledger, sinks
from tests.test_plans import formatted

RUN = Run(job="t", run_id="R-1", started=dt.datetime(2024, 3, 1, 8))


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- commits -----------------------------------------------------------------

def test_a_load_killed_before_its_record_is_not_there(spark, tmp_dir, monkeypatch):
    table, rows = os.path.join(tmp_dir, "t"), spark.range(10)
    assert commits.read_committed(spark, table) is None and commits.commits(spark, table).count() == 0

    def dies(*a):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(commits, "write_text", dies)
        with pytest.raises(RuntimeError, match="killed"):
            commits.append_committed(rows, table, "day-1", RUN, "S")
    assert commits.read_committed(spark, table) is None and commits.audit(spark, table).count() == 0
    record = commits.append_committed(rows, table, "day-1", RUN, "S")
    again = commits.append_committed(rows, table, "day-1", Run(job="t", run_id="R-2"), "S")
    assert record == again and record.rows == 10 and record.run_id == "R-1"
    assert values(commits.read_committed(spark, table), "id") == [(i,) for i in range(10)]
    one = commits.audit(spark, table).first()
    assert (one["id_ejecucion"], one["cantidad_registros"], one["fecha_inicio"]) == ("R-1", 10, dt.datetime(2024, 3, 1, 8))
    listed = json.load(open(os.path.join(table, "_commits", "day-1.json")))
    assert listed["files"] and all(os.path.exists(os.path.join(table, listed["folder"], f)) for f in listed["files"])


def test_two_attempts_at_once_count_once(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    got = []
    tries = [threading.Thread(target=lambda k=k: got.append(commits.append_committed(spark.range(100), table, "x", Run(job="t", run_id=f"R-{k}"), "S"))) for k in range(3)]
    for t in tries:
        t.start()
    for t in tries:
        t.join()
    assert len({g.run_id for g in got}) == 1 and commits.read_committed(spark, table).count() == 100


def test_partitions_schemas_names_and_empty_loads(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    commits.append_committed(spark.range(6).selectExpr("id", "id % 2 AS p"), table, "a", RUN, "S", partition_by="p")
    commits.append_committed(spark.range(3).selectExpr("id", "id % 2 AS p", "'n' AS extra"), table, "b", RUN, "S", partition_by="p")
    assert commits.append_committed(spark.range(0).selectExpr("id", "0L AS p"), table, "c", RUN, "S", partition_by="p").rows == 0
    out = commits.read_committed(spark, table, merge_schema=True)
    assert set(out.columns) == {"id", "p", "extra"} and out.count() == 9 and out.filter("extra IS NULL").count() == 6
    assert commits.read_committed(spark, table, loads=["b"]).count() == 3
    with pytest.raises(ValueError):
        commits.append_committed(spark.range(1), table, "a/b", RUN, "S")


def test_two_runs_claim_two_versions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "v")
    got = []
    runs = [threading.Thread(target=lambda k=k: got.append((sinks.write_snapshot(spark.range(k), path), k))) for k in (3, 5)]
    for t in runs:
        t.start()
    for t in runs:
        t.join()
    assert sorted(v for v, _ in got) == [1, 2] == commits.versions(spark, path)
    for v, k in got:
        assert spark.read.parquet(f"{path}/version={v}").count() == k
    with pytest.raises(FileExistsError):
        sinks.write_snapshot(spark.range(9), path, 2)
    assert spark.read.parquet(f"{path}/version=2").count() in (3, 5)


# -- ledger --------------------------------------------------------------------

def test_late_and_replaced_files_are_loaded_once(spark, tmp_dir):
    landing, table = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "t")
    os.makedirs(landing)

    def land(name, rows, when):
        p = os.path.join(landing, name)
        with open(p, "w") as fh:
            fh.write("\n".join(rows))
        os.utime(p, (when, when))

    def load(**more):
        return ledger.load_pending(spark, landing, table, lambda ps: spark.read.text(ps), RUN, "S", pattern="*.csv", **more)
    land("a.csv", ["1", "2"], 1_700_000_000)
    land("notes.txt", ["no"], 1_700_000_000)
    assert load().rows == 2 and load() is None
    land("late.csv", ["3"], 1_600_000_000)  # older than what was loaded
    assert [os.path.basename(i[0]) for i in load().inputs] == ["late.csv"]
    land("a.csv", ["1", "2", "4"], 1_700_000_100)  # replaced
    land("b.csv", ["5"], 1_700_000_200)
    assert load(newest_only=True).rows == 1  # b.csv; a.csv stays pending
    assert load().rows == 3 and load() is None
    assert values(commits.read_committed(spark, table), "value") == [("1",), ("1",), ("2",), ("2",), ("3",), ("4",), ("5",)]
    assert ledger.loaded_files(spark, table).count() == 4
    assert ledger.loaded_today(spark, table, dt.date(2024, 3, 1)) and not ledger.loaded_today(spark, table, "2024-03-02")


def test_a_repeated_run_of_the_same_files_has_the_same_name(spark, tmp_dir, monkeypatch):
    landing, table = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "t")
    spark.range(5).write.parquet(landing)
    names = []
    real = commits.claim

    def dies(spark_, staged_, final):
        names.append(final)
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(commits, "claim", dies)
        with pytest.raises(RuntimeError):
            ledger.load_pending(spark, landing, table, lambda ps: spark.read.parquet(*ps), RUN, "S", pattern="*.parquet")
    assert real is commits.claim
    record = ledger.load_pending(spark, landing, table, lambda ps: spark.read.parquet(*ps), RUN, "S", pattern="*.parquet")
    assert names[0].endswith(f"/{record.load}.json") and commits.read_committed(spark, table).count() == 5


# -- key index -------------------------------------------------------------------

TYPES = {"k": "bigint", "name": "string"}


def plan_of(spark, df):
    return formatted(spark, df).split("\n\n")[0]


def test_a_small_batch_shuffles_no_history(spark, tmp_dir):
    index = KeyIndex(spark, os.path.join(tmp_dir, "i"), TYPES, buckets=16)
    history = spark.range(5000).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS name")
    index.add(history.filter("k < 3000"), "1", RUN)
    index.add(history.filter("k >= 3000").unionByName(spark.createDataFrame([(None, "x"), (None, "x"), (7, None)], "k long, name string")), "2", RUN)
    batch = spark.createDataFrame([(4999, "1", "a"), (4999, "2", "b"), (None, "x", "c"), (None, None, "d"), (7, None, "e"), (0, "0", "f"), (0, "0", "f")],
                                  "k int, name string, v string")
    assert values(index.new_rows(batch), "v") == [("b",), ("d",)]
    assert values(index.existing_rows(batch), "v") == [("a",), ("c",), ("e",), ("f",), ("f",)]
    assert history_scan_is_unshuffled(spark, index.new_rows(batch))
    # Other buckets' files are not opened.
    assert "PartitionFilters: [__bucket" in formatted(spark, index.new_rows(batch)).replace("isnotnull(__bucket", "__bucket")


def history_scan_is_unshuffled(spark, df):
    """The batch's keys are sent to the scan: between it and the semi join no
    row is exchanged."""
    lines = plan_of(spark, df).split("\n")
    at = next(i for i, line in enumerate(lines) if "BroadcastHashJoin LeftSemi" in line)
    to = next(i for i in range(at, len(lines)) if "Scan parquet" in lines[i])
    return not any("Exchange" in line for line in lines[at:to])


def test_raw_history_is_not_shuffled_for_a_small_batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h")
    spark.range(20000).selectExpr("id AS k", "id % 5 AS z").write.parquet(path)
    batch = spark.createDataFrame([(5, "old"), (20001, "new"), (20001, "new")], "k long, v string")
    out = new_rows(batch, spark.read.parquet(path), ["k"])
    assert history_scan_is_unshuffled(spark, out)
    assert values(out, "k", "v") == [(20001, "new"), (20001, "new")]


def test_a_hot_key_in_history_and_in_the_batch(spark, tmp_dir):
    index = KeyIndex(spark, os.path.join(tmp_dir, "i"), {"k": "bigint"}, buckets=4)
    history = spark.range(30000).selectExpr("IF(id % 3 = 0, 1, id) AS k")
    index.add(history, "1", RUN)
    stored = commits.read_committed(spark, index.path)
    assert stored.count() == history.distinct().count()  # each key once
    batch = spark.range(9000).selectExpr("IF(id % 3 = 0, 1, id + 25000) AS k", "id")
    want = batch.join(history.distinct(), "k", "left_anti").count()
    assert index.new_rows(batch).count() == want == new_rows(batch, history, ["k"]).count()


def test_a_batch_of_many_keys_gives_the_same_rows(spark, monkeypatch):
    from ledgerline.operators import incremental
    history, batch = spark.range(1000).selectExpr("id AS k"), spark.range(500, 1500).selectExpr("id AS k", "id % 3 AS v")
    few = values(new_rows(batch, history, ["k"]), "k")
    monkeypatch.setattr(incremental, "broadcast_if_small", lambda df, size: broadcast_if_small(df, size, limit=0))
    assert values(new_rows(batch, history, ["k"]), "k") == few == [(k,) for k in range(1000, 1500)]


def test_empty_index_and_empty_batch(spark, tmp_dir):
    index = KeyIndex(spark, os.path.join(tmp_dir, "i"), TYPES)
    batch = spark.createDataFrame([(1, "a")], "k long, name string")
    assert index.new_rows(batch).count() == 1 and index.existing_rows(batch).count() == 0
    index.add(batch, "1", RUN)
    assert index.new_rows(batch.limit(0)).count() == 0


# -- ordinals --------------------------------------------------------------------

def test_equal_rows_are_numbered_by_many_tasks(spark):
    counted = spark.createDataFrame([("hot", 50_000), ("few", 3), ("one", 1), ("edge", 64), ("over", 65)], "v string, __n long")
    out = numbered_copies(counted, chunk=64)
    got = {r["v"]: (r["n"], r["d"], r["lo"], r["hi"]) for r in out.groupBy("v").agg(
        F.count("*").alias("n"), F.count_distinct("__ordinal").alias("d"), F.min("__ordinal").alias("lo"), F.max("__ordinal").alias("hi")).collect()}
    assert got == {v: (n, n, 1, n) for v, n in (("hot", 50_000), ("few", 3), ("one", 1), ("edge", 64), ("over", 65))}
    sizes = [r["count"] for r in out.filter("v = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 50_000 / 4


def test_ids_of_equal_rows_are_unique_and_repeatable(spark):
    df = spark.range(200_000).selectExpr("'same' AS v", "CAST(NULL AS INT) AS w")
    a, b = (with_row_ids(df, "R") for _ in range(2))
    assert a.select("id").distinct().count() == 200_000 and a.exceptAll(b).count() == 0


# -- state log --------------------------------------------------------------------

def test_an_update_of_ten_keys_writes_ten_rows(spark, tmp_dir):
    table = spark.range(1000).selectExpr("id AS k", "1 AS id_estado", "id * 2 AS v")
    log = os.path.join(tmp_dir, "log")
    assert state_log.with_states(table, log, ["k"]) is table and state_log.compact(spark, log, ["k"]) is None
    assert state_log.log_states(spark.range(10).selectExpr("id AS k"), log, ["k"], 4) == 1
    assert spark.read.parquet(f"{log}/version=1").count() == 10
    assert state_log.log_states(spark.range(5, 8).selectExpr("id AS k"), log, ["k"], 2, unless=1) == 2

    def states():
        return dict(values(state_log.with_states(table, log, ["k"]).filter("id_estado <> 1 OR k < 12"), "k", "id_estado"))
    want = {k: 4 if k < 10 else 1 for k in range(12)} | {5: 1, 6: 1, 7: 1}
    assert states() == want
    assert state_log.compact(spark, log, ["k"]) == 3 and states() == want
    assert spark.read.parquet(f"{log}/version=3").count() == 10
    state_log.log_states(spark.range(0, 2).selectExpr("id AS k"), log, ["k"], 9)
    assert states() == want | {0: 9, 1: 9}
    assert state_log.with_states(table, log, ["k"]).columns == table.columns


def test_an_update_between_read_and_claim_of_a_compaction_counts(spark, tmp_dir, monkeypatch):
    table = spark.range(4).selectExpr("id AS k", "1 AS id_estado")
    log = os.path.join(tmp_dir, "log")
    state_log.log_states(spark.range(3).selectExpr("id AS k"), log, ["k"], 4)
    real = state_log.staged

    def late(df, name):
        out = real(df, name)
        if name == "compacted":
            state_log.log_states(spark.range(1).selectExpr("id AS k"), log, ["k"], 7)
        return out
    monkeypatch.setattr(state_log, "staged", late)
    assert state_log.compact(spark, log, ["k"]) == 3
    monkeypatch.undo()
    assert values(state_log.with_states(table, log, ["k"]), "k", "id_estado") == [(0, 7), (1, 4), (2, 4), (3, 1)]


def test_null_keys_and_a_large_log(spark, tmp_dir, monkeypatch):
    table = spark.createDataFrame([(None, "1"), (1, "1"), (2, "1")], "k int, id_estado string")
    log = os.path.join(tmp_dir, "log")
    state_log.log_states(spark.createDataFrame([(None,), (2,)], "k int"), log, ["k"], 4)
    want = [("1", 1), ("4", -1), ("4", 2)]
    show = lambda: sorted((r["id_estado"], -1 if r["k"] is None else r["k"]) for r in state_log.with_states(table, log, ["k"]).collect())
    assert show() == want
    monkeypatch.setattr(state_log, "broadcast_if_small", lambda df, size: (df, False))
    assert show() == want


def test_measured_broadcast(spark):
    df, size = staged_measured(spark.range(100).selectExpr("id", "repeat('x', 100) AS s", "array(id) AS a"), "m")
    assert size > 100 * 132 and broadcast_if_small(df, size)[1] and not broadcast_if_small(df, size, limit=5000)[1]
    assert staged_measured(df.limit(0), "m")[1] == 0
