"""A ledger of loaded files, so that batch loads take each file once.

Files are known by path, size and modification time.  What a load took is in
its commit record (``commits``), so the ledger can't say more or less than was
loaded.  A file that arrives late, or is replaced by another of its name, is
pending whatever its date; a load that is repeated finds nothing pending.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.lifecycle import Run
from ledgerline.sources.commits import Commit, append_committed, commits


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, size, modified): a listing only; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        files = files.option("pathGlobFilter", pattern)
    return files.load(path).select("path", F.col("length").alias("size"), F.unix_millis(F.col("modificationTime")).alias("modified"))


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, size, modified, load, run_id) of every file a committed load took."""
    each = commits(spark, table).select("load", "run_id", F.explode("inputs").alias("i"))
    return each.select(F.col("i")[0].alias("path"), F.col("i")[1].cast("bigint").alias("size"), F.col("i")[2].cast("bigint").alias("modified"), "load", "run_id")


def pending_files(spark: SparkSession, landing: str, table: str, pattern: str | None = None) -> DataFrame:
    """Files of the landing folder that no committed load has taken."""
    return list_files(spark, landing, pattern).join(loaded_files(spark, table), ["path", "size", "modified"], "left_anti")


def loaded_today(spark: SparkSession, table: str, day) -> bool:
    """Did a committed load start on ``day``?"""
    return not commits(spark, table).filter(F.col("started").startswith(str(day))).isEmpty()


def load_pending(spark: SparkSession, landing: str, table: str, read: Callable[[list[str]], DataFrame], run: Run,
                 source: str, pattern: str | None = None, newest_only: bool = False) -> Commit | None:
    """Load all pending files (S14), or the newest of them (S15), as one commit.

    ``read`` turns file paths into rows.  The load is named by its files, so a
    run that died before its commit is repeated under the same name.  None if
    nothing is pending.  What comes to the driver is the files' names."""
    files = pending_files(spark, landing, table, pattern).orderBy("modified", "path").collect()
    if not files:
        return None
    files = files[-1:] if newest_only else files
    inputs = [[r["path"], r["size"], r["modified"]] for r in files]
    name = hashlib.sha256("\n".join("\t".join(map(str, i)) for i in inputs).encode()).hexdigest()[:24]
    return append_committed(read([i[0] for i in inputs]), table, f"files-{name}", run, source, inputs=inputs)
