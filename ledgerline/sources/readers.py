"""Readers for landed tables, CSV exports and JDBC sources.

Spreadsheets are landed as Parquet or CSV, one table per sheet (Spark has
no Excel reader); everything is read with an explicit schema contract.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_landed(spark: SparkSession, path: str, schema: StructType | None = None,
                fmt: str = "parquet", source_tag: str | None = None,
                with_position: bool = False, **options) -> DataFrame:
    """One landed sheet/table; optional source tag and file position.

    ``with_position`` adds ``_ingest_pos`` (file path, where its split starts,
    row order inside the split): the order of the rows in the files, however
    files are split or packed into tasks, so keep-first rules are reproducible."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if with_position:
        df = df.withColumn("_ingest_pos", F.struct(F.col("_metadata.file_path").alias("file"),
                                                   F.col("_metadata.file_block_start").alias("split"),
                                                   F.monotonically_increasing_id().alias("row")))
    if source_tag is not None:
        df = df.withColumn("fuente", F.lit(source_tag))
    return df


def read_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """A loaded table, or None if nothing was ever loaded there.

    Only a missing folder, or one without any data file, is "nothing": a table
    that can't be read is an error, or its rows would all be loaded again."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        kind = exc.getCondition()
        if kind == "PATH_NOT_FOUND":
            return None
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[!_.]*")
        if kind == "UNABLE_TO_INFER_SCHEMA" and files.load(path).select("path").isEmpty():
            return None
        raise


def read_headerless_csv(spark: SparkSession, path: str, schema: StructType,
                        sep: str = ",", encoding: str = "ISO-8859-1",
                        keep: int | None = None) -> DataFrame:
    """Headerless latin-1 CSV read by position; extra trailing columns
    beyond the contract are cut (``keep`` = number of leading columns)."""
    df = (spark.read.schema(schema).option("header", False).option("sep", sep)
          .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))
    if keep is not None:
        df = df.select(*df.columns[:keep])
    return df


def read_headered_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                      sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Headered CSV with ``;`` and latin-1."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType,
                          sep: str = ";", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Fault-tolerant CSV.  Returns (good rows, rejected raw lines) instead
    of silently skipping malformed lines."""
    with_corrupt = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    df = (spark.read.schema(with_corrupt).option("header", header).option("sep", sep)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # Spark refuses a query on the corrupt column alone, so the parsed rows are
    # written once, to the shared checkpoint folder, and both results read them.
    df = df.checkpoint(eager=True)
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def modified_since(spark: SparkSession, path: str, since: str, fmt: str = "parquet",
                   schema: StructType | None = None, **options) -> DataFrame:
    """Only files modified after ``since`` (``modifiedAfter`` is applied
    while listing files, before any data is read)."""
    r = spark.read.format(fmt).option("modifiedAfter", since).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def newest_file(spark: SparkSession, path: str, pattern: str | None = None,
                fmt: str = "parquet", schema: StructType | None = None, **options) -> DataFrame:
    """The rows of the newest matching file only.

    Files are listed with the ``binaryFile`` source selecting only path and
    modification time (the content column is pruned, so this is a listing,
    not a scan); the newest one (ties broken by path) is then read."""
    listing = spark.read.format("binaryFile")
    if pattern:
        listing = listing.option("pathGlobFilter", pattern)
    files = listing.load(path).select("path", "modificationTime")
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no file matches {path} {pattern or ''}".strip())
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(row["p"])


def jdbc_options(prefix: str) -> dict[str, str]:
    """Connection options from the environment (``{PREFIX}_URL``, ``_USER``,
    ``_PASSWORD``, ``_DRIVER``); secrets never live in code."""
    out = {}
    for k, opt in (("URL", "url"), ("USER", "user"), ("PASSWORD", "password"), ("DRIVER", "driver")):
        v = os.environ.get(f"{prefix}_{k}")
        if v:
            out[opt] = v
    return out


def read_jdbc(spark: SparkSession, options: dict[str, str], query: str | None = None,
              table: str | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10_000,
              one_task: bool = False) -> DataFrame:
    """Warehouse / virtual-database / SQL Server reads over JDBC.

    The read is split into range queries on ``partition_column``; its bounds
    are asked of the source (one row) where they are not given, and there are
    as many ranges as the cluster has cores.  Without a column Spark would read
    everything in one task, so that is refused unless ``one_task`` says that
    the result is small.  Filters and projections are pushed into the remote
    SQL by Spark."""
    if not partition_column and not one_task:
        raise ValueError("give partition_column, or one_task=True for a small result")
    if (query is None) == (table is None):
        raise ValueError("give either query or table")
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", str(fetchsize))
    source = f"({query}) q" if query is not None else table
    if not partition_column:
        return reader.option("dbtable", source).load()
    if lower is None or upper is None:
        bounds = f"(SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {source}) b"
        low, high = tuple(spark.read.format("jdbc").options(**options).option("dbtable", bounds).load().first())
        lower, upper = (low if lower is None else lower), (high if upper is None else upper)
        if lower is None or upper is None:  # no row, or no value to divide by
            return reader.option("dbtable", source).load()
    parts = num_partitions or spark.sparkContext.defaultParallelism
    return (reader.option("dbtable", source).option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper)).option("numPartitions", str(parts)).load())


def business_rules(params: DataFrame, name_col: str = "nombre", value_col: str = "valor") -> DataFrame:
    """Parameter table with list literals parsed to ARRAY<STRING>."""
    from ledgerline.functions.values import list_literal_to_array
    return params.select(name_col, value_col,
                         list_literal_to_array(F.col(value_col)).alias("valores"))


def rule_value(params: DataFrame, name: str, name_col: str = "nombre", value_col: str = "valor"):
    """One named parameter (a single row leaves the cluster)."""
    row = params.filter(F.col(name_col) == F.lit(name)).select(value_col).first()
    return None if row is None else row[0]
