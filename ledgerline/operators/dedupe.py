"""De-duplication and ranking.

Keep-one rules use ``row_number() = 1``: Catalyst turns that filter into a
partial ``WindowGroupLimit`` that runs before the shuffle, so a hot key is
cut to one row per map task before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.joins import normalised_keys, spread_join
from ledgerline.operators.numbering import number_rows


def _as_sort(c) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def tiebreak(df: DataFrame, order: list, exclude: tuple = ()) -> list[Column]:
    """Order list extended with every remaining column, so ranking is total."""
    named = {c for c in order if isinstance(c, str)}
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in named and c not in exclude]
    return [_as_sort(c) for c in order] + rest


def keep_first(df: DataFrame, keys: list[str], order: list, total: bool = True) -> DataFrame:
    """One row per key, the first by ``order`` (then all columns)."""
    spec = tiebreak(df, order, tuple(keys)) if total else [_as_sort(c) for c in order]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*spec)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def duplicate_flag(df: DataFrame, keys: list[str], name: str = "duplicado") -> DataFrame:
    """True on every member of a key that occurs more than once.

    Counted with a combinable aggregation (a hot key costs one partial count
    per map task), then joined back, hot keys spread (``spread_join``)."""
    keyed, names = normalised_keys(df, keys, "__d")
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__cnt"))
    return (spread_join(keyed, counts, names, "inner")
                 .withColumn(name, F.col("__cnt") > 1)
                 .drop("__cnt", *names))


def keep_first_counted(df: DataFrame, keys: list[str], order: list[str], name: str = "duplicado") -> DataFrame:
    """A2 + W3 in one aggregation: the first row per key by ``order`` (then all
    columns, nulls last), and whether the key occurs more than once.

    Combined map-side, so a hot key is one row per task before the shuffle."""
    rest = [c for c in df.columns if c not in order]
    place = F.struct(*[x for i, c in enumerate([*order, *rest]) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    keyed, names = normalised_keys(df, keys, "__f")
    first = keyed.groupBy(*names).agg(F.min_by(F.struct(*df.columns), place).alias("__row"), F.count(F.lit(1)).alias("__cnt"))
    return first.select("__row.*", (F.col("__cnt") > 1).alias(name))


def duplicate_ordinal(df: DataFrame, keys: list[str], order: list,
                      name: str = "ordinal") -> DataFrame:
    """``cumcount() + 1`` after a sort, for every row (skew-safe numbering);
    rows that tie are told apart by their other columns."""
    if all(isinstance(c, str) for c in order):
        rest = [c for c in df.columns if c not in order and c not in keys]
        return number_rows(df, [*order, *rest], group=keys, name=name)
    return number_rows(df, tiebreak(df, order, tuple(keys)), group=keys, name=name)
