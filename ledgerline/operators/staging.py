"""Intermediate tables in the cluster's shared folder, and measured broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

#: Largest measured size of a frame that is sent to every task.
BROADCAST_BYTES = 32 * 1024 * 1024


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder that all machines share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: fixed rows, no lineage."""
    return staged_measured(df, name)[0]


def staged_measured(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged``, and the frame's bytes, summed while it was written."""
    path, seen = scratch_folder(df.sparkSession, name), Observation("bytes")
    df.observe(seen, F.sum(_row_bytes(df)).alias("b")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(seen.get.get("b") or 0)


def _row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's bytes: text by its length, other plain values
    as 16 bytes, nested ones by their text form."""
    total = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            total = total + 16
    return total


def broadcast_if_small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(``df`` with a broadcast hint, True) if its measured ``size`` is within
    ``limit``, else (``df``, False)."""
    small = size <= limit
    return (F.broadcast(df) if small else df), small
