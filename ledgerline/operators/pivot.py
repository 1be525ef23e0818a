"""Entity-attribute-value pivot (A9) and the guarded-cast join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eav_pivot(df: DataFrame, entity: str, field: str, value: str, updated_at: str,
              fields: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """Entity x field -> latest non-null value.

    ``fields`` is the known column list: it avoids an extra job to discover
    the pivot values and pads fields absent from the data as null columns.
    ``max_by`` is a partial aggregate, so a chatty entity is combined
    map-side before the shuffle."""
    order = F.struct(F.col(updated_at), *[F.col(c) for c in (tiebreak or [])])
    return (df.filter(F.col(value).isNotNull())
              .groupBy(entity)
              .pivot(field, fields)
              .agg(F.max_by(F.col(value), order)))


def guarded_bigint(c) -> Column:
    """``CASE WHEN ISNUMERIC(v) THEN CAST(v AS BIGINT) END`` without failing
    on 20-digit or non-numeric text."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.rlike(r"^[0-9]{1,19}$"), x.try_cast("bigint"))
