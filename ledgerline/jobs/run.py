"""Run a configured file loader (G1-G3, G8 shape) from a JSON file.

    spark-submit -m ledgerline.jobs.run config.json      (or python -m ...)

Config keys: ``source`` (label), ``input`` (path), ``format`` (parquet|csv),
``read_options`` (dict), ``schema`` (DDL string, optional), ``rename``,
``key``, ``amount``, ``defaults``, ``time_columns``, ``date_columns``,
``required``, ``target`` (append path; also the history), ``audit``,
``errors`` and optional ``history`` (defaults to ``target``),
``modified_after`` (freshness gate, S14).

With ``"ledger": true`` files are taken once each, late ones too, and every
load is one commit: rows, audit and list of files are there together or not at
all, and a run that died is simply run again (``sources/ledger.py``).  Its keys
go to an index at ``index`` (default: the target with ``_keys``), which later
loads are compared with instead of the target's rows.  Optional: ``pattern``,
``newest_only`` (S15), ``buckets``.
"""

from __future__ import annotations

import datetime as _dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from ledgerline.jobs.order_loader import LoaderConfig, run_loader, transform
from ledgerline.operators.columns import rename_map
from ledgerline.operators.key_index import BUCKETS, KeyIndex
from ledgerline.operators.lifecycle import Run
from ledgerline.sources.commits import read_committed
from ledgerline.sources.ledger import load_pending
from ledgerline.sources.readers import read_existing


def _read(spark: SparkSession, cfg: dict, paths: list[str] | None = None) -> DataFrame:
    r = spark.read.format(cfg.get("format", "parquet")).options(**cfg.get("read_options", {}))
    if cfg.get("schema"):
        r = r.schema(cfg["schema"])
    if cfg.get("modified_after"):
        r = r.option("modifiedAfter", cfg["modified_after"])
    return r.load(paths or cfg["input"])


def _history(spark: SparkSession, path: str, batch: DataFrame, lc: LoaderConfig) -> DataFrame:
    stored = read_existing(spark, path)
    if stored is not None:
        return stored.select(*lc.key)
    return rename_map(batch, lc.rename).select(*lc.key).limit(0)


def _config(cfg: dict) -> LoaderConfig:
    return LoaderConfig(source=cfg["source"], rename=cfg.get("rename", {}), key=cfg["key"],
                        amount=cfg.get("amount"), defaults=cfg.get("defaults", {}),
                        time_columns=cfg.get("time_columns", []), date_columns=cfg.get("date_columns", []),
                        required=cfg.get("required"))


def run_ledgered(spark: SparkSession, cfg: dict, run: Run) -> int:
    """Load the pending files as one commit; 0 if there are none.

    Keys are compared by the types of the first load."""
    lc, table = _config(cfg), cfg["target"]

    def rows(paths: list[str]) -> DataFrame:
        batch = _read(spark, cfg, paths)
        stored = read_committed(spark, table)
        types = dict(rename_map(batch, lc.rename).dtypes if stored is None else stored.dtypes)
        index = KeyIndex(spark, cfg.get("index", f"{table}_keys"), {k: types[k] for k in lc.key}, cfg.get("buckets", BUCKETS))
        index.catch_up(table, run)
        return transform(batch, index, lc, run)

    done = load_pending(spark, cfg["input"], table, rows, run, lc.source, cfg.get("pattern"), cfg.get("newest_only", False))
    return done.rows if done else 0


def run_config(spark: SparkSession, cfg: dict, run: Run | None = None) -> int:
    lc = _config(cfg)
    run = run or Run(job=cfg.get("job", cfg["source"]))
    if cfg.get("ledger"):
        return run_ledgered(spark, cfg, run)
    batch = _read(spark, cfg)
    history = _history(spark, cfg.get("history", cfg["target"]), batch, lc)
    return run_loader(batch, history, lc, run, cfg["target"], cfg["audit"], cfg.get("errors"))


def main(argv: list[str]) -> int:
    from ledgerline.session import build_session
    with open(argv[0], encoding="utf-8") as fh:
        cfg = json.load(fh)
    spark = build_session(app=f"ledgerline-{cfg['source']}")
    n = run_config(spark, cfg, Run(job=cfg.get("job", cfg["source"]),
                                   started=_dt.datetime.now().replace(microsecond=0)))
    print(json.dumps({"source": cfg["source"], "rows": n}))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
