"""Profiling counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: rows, non-null count, distinct count.

    One pass: every column is unpivoted to (column, value) text pairs and
    counted with combinable aggregates."""
    cols = cols or df.columns
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ids=[], values=cols, variableColumnName="columna", valueColumnName="valor")
    return long.groupBy("columna").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count("valor").alias("no_nulos"),
        F.count_distinct("valor").alias("distintos"))


def count_before_after(df: DataFrame, keep) -> DataFrame:
    """Rows before a filter and rows it keeps, in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("antes"), F.count_if(keep).alias("despues"))
