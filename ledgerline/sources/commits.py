"""Atomic, repeatable appends: staged files and one commit record per load.

A load writes its rows into a folder of its own and then claims its name with
one record, ``_commits/<load>.json``: rows, files, times and the input files it
took.  The claim is a rename that fails if the name is taken, so of two
attempts at a load one counts; what the other wrote is never read.  Readers
take the folders of committed loads only.  Data, audit row (C2/C3) and file
ledger (S14-S16) are that one record, so none can be there without the others:
a load that dies before its claim left nothing, and a load that is run again
finds its record and writes nothing.

The rename is atomic where the file system's is (HDFS and the stores that
follow it); on a local disk the check and the rename are two steps.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.lifecycle import AUDIT_SCHEMA, Run


@dataclass
class Commit:
    load: str
    run_id: str
    job: str
    source: str
    rows: int
    started: str
    finished: str
    folder: str
    files: list[str] = field(default_factory=list)
    inputs: list[list] = field(default_factory=list)  # path, size, modification time (ms)


def _paths(spark: SparkSession, *paths: str):
    jvm = spark.sparkContext._jvm
    return [jvm.org.apache.hadoop.fs.Path(p) for p in paths]


def _fs(spark: SparkSession, path: str):
    (p,) = _paths(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def claim(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename ``staged`` to ``final`` unless ``final`` is there already."""
    sc = spark.sparkContext
    src, dst = _paths(spark, staged, final)
    _fs(spark, final).mkdirs(dst.getParent())
    if _fs(spark, final).exists(dst):
        return False
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), sc._jsc.hadoopConfiguration())
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(src, dst, sc._gateway.new_array(kind, 0))
    except Py4JJavaError as exc:
        if _fs(spark, final).exists(dst):
            return False
        raise exc
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    (p,) = _paths(spark, path)
    out = _fs(spark, path).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    (p,) = _paths(spark, path)
    fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    (p,) = _paths(spark, folder)
    fs, found = _fs(spark, folder), []
    each = fs.listFiles(p, True)
    root = fs.makeQualified(p).toString().rstrip("/")
    while each.hasNext():
        name = each.next().getPath().toString()
        if not name.rsplit("/", 1)[1].startswith(("_", ".")):
            found.append(name[len(root) + 1:])
    return sorted(found)


def commits(spark: SparkSession, table: str) -> DataFrame:
    """One row per committed load, as recorded."""
    names = [n for n in listed(spark, f"{table}/_commits") if n.endswith(".json")]
    schema = ("load string, run_id string, job string, source string, rows bigint, started string, finished string, "
              "folder string, files array<string>, inputs array<array<string>>")
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json([f"{table}/_commits/{n}" for n in names])


def committed(spark: SparkSession, table: str, load: str) -> Commit | None:
    """The record of one load, if it was committed."""
    row = commits(spark, table).filter(F.col("load") == load).first()
    return None if row is None else Commit(**row.asDict())


def append_committed(df: DataFrame, table: str, load: str, run: Run, source: str,
                     partition_by: str | None = None, inputs: list[list] | None = None) -> Commit:
    """S11 + C2 + C3: append ``df`` as the load named ``load``.

    ``load`` names what is loaded (a day, a set of files), not the attempt: a
    load that is there already is returned as it was recorded."""
    spark = df.sparkSession
    if not re.fullmatch(r"[\w.=-]+", load):
        raise ValueError(f"a load's name has letters, digits, '.', '=', '-' and '_' only: {load!r}")
    table = table.rstrip("/")
    before = committed(spark, table, load)
    if before is not None:
        return before
    folder = f"data/__load={load}-{uuid.uuid4().hex[:12]}"
    seen = Observation("rows")
    out = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(f"{table}/{folder}")
    record = Commit(load, run.run_id, run.job, source, int(seen.get.get("n", 0)), run.started.isoformat(sep=" "),
                    _dt.datetime.now().replace(microsecond=0).isoformat(sep=" "), folder,
                    _data_files(spark, f"{table}/{folder}"), [[str(x) for x in i] for i in inputs or []])
    draft = f"{table}/_drafts/{load}-{uuid.uuid4().hex[:12]}.json"
    write_text(spark, draft, json.dumps(asdict(record)))
    if claim(spark, draft, f"{table}/_commits/{load}.json"):
        return record
    return committed(spark, table, load)  # another attempt was first


def read_committed(spark: SparkSession, table: str, loads: list[str] | None = None, merge_schema: bool = False) -> DataFrame | None:
    """Rows of the committed loads (or of those named); None if there are none.

    Loads of unlike columns are read as one table with ``merge_schema``."""
    found = commits(spark, table).filter(F.size("files") > 0)
    if loads is not None:
        found = found.filter(F.col("load").isin(loads))
    folders = sorted(f"{table}/{r['folder']}" for r in found.select("folder").collect())
    if not folders:
        return None
    reader = spark.read.option("basePath", f"{table}/data").option("mergeSchema", merge_schema)
    return reader.parquet(*folders).drop("__load")


def audit(spark: SparkSession, table: str, state: int = 1) -> DataFrame:
    """C2 + C3: the run summary rows, taken from the commit records."""
    start, end = F.col("started").cast("timestamp_ntz"), F.col("finished").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", start, end)
    rows = commits(spark, table).select(
        F.col("run_id").alias("id_ejecucion"), F.col("job").alias("proceso"), F.col("source").alias("fuente"),
        F.col("rows").alias("cantidad_registros"), F.lit(state).alias("id_estado"), start.alias("fecha_inicio"), end.alias("fecha_fin"),
        seconds.cast("bigint").alias("duracion_segundos"))
    return rows.select([f.name for f in AUDIT_SCHEMA])


# -- numbered folders ----------------------------------------------------------

def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a snapshot table, ascending."""
    return sorted(int(n.split("=", 1)[1]) for n in listed(spark, path) if re.fullmatch(r"version=\d+", n))


def claim_version(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write ``df`` as a new snapshot ``version=N`` and return N.

    The rows are staged first; the number is claimed by a rename that fails if
    the version is there, and the next one is tried, so two runs at once get two
    versions.  A version that is asked for by number must be free."""
    spark, path = df.sparkSession, path.rstrip("/")
    draft = f"{path}/_drafts/{uuid.uuid4().hex}"
    df.write.parquet(draft)
    while True:
        n = version if version is not None else max(versions(spark, path), default=0) + 1
        if claim(spark, draft, f"{path}/version={n}"):
            return n
        if version is not None:
            raise FileExistsError(f"{path} has a version {version} already")
