"""Sinks: append-only tables, CSV copies, report exports, audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_table(df: DataFrame, path: str, partition_by: str | None = "fecha_procesamiento",
                 fmt: str = "parquet") -> int:
    """Append ``df`` partitioned by load day; returns rows written.

    The row count is observed during the write itself (no second pass)."""
    from pyspark.sql import Observation
    obs = Observation("rows")
    out, parts = df, []
    if partition_by and partition_by in df.columns:
        out = out.withColumn("fecha_carga", F.to_date(F.col(partition_by)))
        parts = ["fecha_carga"]
    out = out.observe(obs, F.count(F.lit(1)).alias("n"))
    w = out.write.mode("append").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return int(obs.get.get("n", 0))


def append_jdbc(df: DataFrame, options: dict[str, str], table: str, batchsize: int = 1000) -> None:
    """S11 over JDBC: parallel batched inserts (batch size from configuration)."""
    (df.write.format("jdbc").options(**options).option("dbtable", table)
       .option("batchsize", str(batchsize)).mode("append").save())


def write_csv_copy(df: DataFrame, path: str, sep: str = ";") -> None:
    """CSV copy of a loaded frame or a report projection."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_audit(df: DataFrame, path: str) -> None:
    """Audit rows are tiny; one file per append."""
    df.coalesce(1).write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, path: str, version: int | None = None) -> int:
    """A new immutable snapshot folder ``version=N``; returns N.

    Without a number the next free one is claimed; a number that is taken is an
    error, as another run's snapshot stands there (``commits.claim_version``)."""
    from ledgerline.sources.commits import claim_version
    return claim_version(df, path, version)
