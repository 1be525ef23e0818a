"""Helpers shared by the operators: code shipping, shared scratch, key hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()

#: Rows of an Arrow batch: whole texts are wide rows, and the default of 10,000
#: would hold tens of MB several times over on either side of a worker's pipe.
BATCH_ROWS = 1000


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    The package (source files only) is sent once per application through
    Spark's own file distribution, as ``--py-files`` would.  Arrow batches are
    kept to ``BATCH_ROWS`` unless the session asks for still fewer."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def tidied(batches: Iterator) -> Iterator:
    """The batches of a task; at their end the memory they took goes back to
    the machine.  Workers serve many tasks, and what one has freed would else
    stay with it."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder (URI) under the checkpoint folder that all machines share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def saved(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation of what stands before."""
    path = shared_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``saved``, and what was shuffled for it goes from the executors' disks:
    Spark removes shuffle files once the driver has collected what refers to
    them, which a driver with memory to spare may not do before the job ends."""
    out = saved(spark, df, name, compression)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the bytes of a written table: rows times widest row."""
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(16) for c, t in df.dtypes]
    total = widths[0]
    for w in widths[1:]:
        total = total + w
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).head()
    return int(row["b"] or 0) + 16 * int(row["n"])


def broadcast_if_small(df: DataFrame, limit: int = 32 * 1024 * 1024) -> DataFrame:
    """Broadcast hint only if the measured bytes of ``df`` are within ``limit``.

    ``df`` must be cheap to scan (a written table).  Beyond the limit the
    plain frame is returned and the join shuffles."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def doc_crc(col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
