"""Unions and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union aligned by name; columns missing from a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a target schema: shared names cast, missing -> null,
    extra columns dropped."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION``."""
    return a.unionByName(b).distinct()


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` (SQL ``EXCEPT``)."""
    return a.subtract(b)


def key_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: distinct rows in both."""
    return a.intersect(b)
