"""Projection, renaming and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import rename_rule


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str], source: str = "") -> DataFrame:
    """Fail by name when a contract column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{source or 'input'} lacks required columns: {missing}")
    return df


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored (pandas rename)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_by_rule(df: DataFrame, rule=rename_rule) -> DataFrame:
    """Rename every column by a rule (strip, lower, spaces -> '_')."""
    return df.toDF(*[rule(c) for c in df.columns])


def select_positions(df: DataFrame, positions: dict[int, str]) -> DataFrame:
    """Take columns by position and name them."""
    cols = df.columns
    return df.select(*[F.col(cols[i]).alias(name) for i, name in sorted(positions.items())])


def select_required(df: DataFrame, cols: list[str]) -> DataFrame:
    """Required columns, fixed order."""
    require_columns(df, cols)
    return df.select(*cols)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop, ignoring absent names."""
    return df.drop(*cols)


def pad_columns(df: DataFrame, wanted: list[str] | dict[str, str], fill=None) -> DataFrame:
    """Add absent columns (null or a fill value) and order as ``wanted``.

    ``wanted`` may map name -> Spark type for typed padding."""
    names = list(wanted)
    types = wanted if isinstance(wanted, dict) else {}
    adds = {}
    for n in names:
        if n not in df.columns:
            lit = F.lit(fill)
            adds[n] = lit.cast(types[n]) if n in types else lit.cast("string")
    out = df.withColumns(adds) if adds else df
    return out.select(*names)


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Field-by-field mapping source -> target; unmapped columns dropped."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def control_first(df: DataFrame, first: list[str]) -> DataFrame:
    """Move control columns to the front."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def add_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def assert_unique_names(df: DataFrame) -> DataFrame:
    """Duplicate column names are rejected instead of silently dropped."""
    seen, dup = set(), []
    for c in df.columns:
        (dup.append(c) if c in seen else seen.add(c))
    if dup:
        raise ValueError(f"duplicate column names: {dup}")
    return df
