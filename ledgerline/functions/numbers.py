"""Numeric coercion (X16-X19, X46, X47).  ANSI mode is on: always ``try_cast``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NumericType, ShortType, StringType)

from ledgerline.functions.constants import INT32_MAX, INT32_MIN


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, to: str | DataType) -> Column:
    return _c(c).try_cast(to)


def digits_or_zero(c) -> Column:
    """Digits-only text -> BIGINT, anything else (or overflow) -> 0."""
    x = _c(c).cast("string")
    return F.when(x.rlike(r"^[0-9]+$"), F.coalesce(x.try_cast("bigint"), F.lit(0))) \
        .otherwise(F.lit(0)).cast("bigint")


def coerce_number(c, to: str = "bigint", default=0) -> Column:
    """``to_numeric(errors='coerce').fillna(0).astype(int)``.

    Goes through DOUBLE so '12.0' parses; the final cast truncates toward
    zero like ``astype(int)``; values out of range fall back to the default.
    """
    d = _c(c).try_cast("double")
    if to in ("double", "float"):
        return F.coalesce(d, F.lit(default)).cast(to)
    return F.coalesce(d.try_cast(to), F.lit(default).cast(to))


def round_like_pandas(x: Column, digits: int = 2) -> Column:
    """pandas/numpy ``round``: ``rint(x * 10**d) / 10**d`` on the binary value.

    ``bround`` rounds the decimal text instead (10.155 -> 10.16 where numpy
    gives 10.15), so it is not used here."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def scale_thousands(c, digits: int = 2) -> Column:
    """Value / 1000 rounded half-to-even the way pandas does."""
    return round_like_pandas(F.coalesce(_c(c).try_cast("double"), F.lit(0.0)) / 1000.0, digits)


def clamp_int32(c) -> Column:
    """Values above INT32 max become INT32 min (what the target column holds)."""
    x = _c(c)
    return F.when(x > F.lit(INT32_MAX), F.lit(INT32_MIN)).otherwise(x)


def coerce_by_type_map(df: DataFrame, types: dict[str, str], int_default=0) -> DataFrame:
    """Coerce each listed column to its type; integer columns get 0 for bad values."""
    out = {}
    for name, t in types.items():
        if name not in df.columns:
            continue
        col = F.col(name)
        if t in ("int", "bigint", "smallint", "tinyint"):
            out[name] = coerce_number(col, t, int_default)
        elif t in ("double", "float"):
            out[name] = col.try_cast(t)
        else:
            out[name] = col.try_cast(t)
    return df.withColumns(out) if out else df


def fill_blank_then_zero(df: DataFrame, numeric: list[str],
                         text_blank: bool | list[str] = False) -> DataFrame:
    """Text nulls -> '' (all text columns, or the listed ones), and
    ''/null -> 0 on the numeric columns."""
    out = {}
    for f in df.schema.fields:
        if f.name in numeric:
            x = F.col(f.name)
            if isinstance(f.dataType, StringType):
                x = F.when(F.trim(x) == "", None).otherwise(x).try_cast("double")
            out[f.name] = F.coalesce(x.cast("double"), F.lit(0.0))
        elif isinstance(f.dataType, StringType) and (
                text_blank is True or (isinstance(text_blank, list) and f.name in text_blank)):
            out[f.name] = F.coalesce(F.col(f.name), F.lit(""))
    return df.withColumns(out) if out else df


def is_numeric_type(dt: DataType) -> bool:
    return isinstance(dt, NumericType)
