"""Filters with pandas' null semantics made explicit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def positive_amount(c) -> Column:
    """keep rows whose amount, null filled with 0, is > 0.

    As a filter: null, and text that is no number, is dropped like 0.  Plain
    ``> 0``, so the bound reaches the scan of a numeric column."""
    return _c(c).try_cast("double") > 0


def not_equal_keep_null(c, value) -> Column:
    """``df[col != v]`` keeps nulls."""
    return ~_c(c).eqNullSafe(F.lit(value))


def not_in_keep_null(c, values: list) -> Column:
    """``~isin(list)`` keeps nulls."""
    return F.coalesce(~_c(c).isin(*values), F.lit(True))


def matches(c, pattern: str) -> Column:
    """Regex match where null -> false."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def not_matches(c, pattern: str) -> Column:
    """Negation keeps nulls."""
    return ~matches(c, pattern)


def icontains(c, needle: str) -> Column:
    """Case-insensitive literal contains, null -> false."""
    return F.coalesce(_c(c).ilike("%" + needle.replace("%", "\\%").replace("_", "\\_") + "%"),
                      F.lit(False))


def exclude_all(conds: list[Column]) -> Column:
    """F8: fold a list of keep-conditions with AND."""
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def exclude_with_exception(cond_a: Column, cond_b: Column) -> Column:
    """drop rows where a AND b both hold (null-safe: unknown keeps the row)."""
    return ~F.coalesce(cond_a & cond_b, F.lit(False))


def in_period(ts, period: str) -> Column:
    """timestamp falls in month ``yyyy-MM``.

    A range with literal bounds, so it reaches the scan and prunes files."""
    import datetime as _dt
    first = _dt.date.fromisoformat(f"{period}-01")
    after = (first.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    bound = lambda d: F.lit(d.isoformat()).cast("timestamp_ntz")
    return (_c(ts) >= bound(first)) & (_c(ts) < bound(after))


def watermark(c, mark, inclusive: bool = False) -> Column:
    """incremental bound; the engine default is strict ``>``."""
    import datetime as _dt
    if mark is None:
        return F.lit(True)
    if isinstance(mark, Column):
        m = mark
    elif isinstance(mark, _dt.datetime):  # naive wall-clock, never the driver's local zone
        m = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    elif isinstance(mark, _dt.date):
        m = F.lit(mark.isoformat()).cast("date")
    else:
        m = F.lit(mark)
    return (_c(c) >= m) if inclusive else (_c(c) > m)
