"""Dates, Excel serials and business-day windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.constants import (MONTH_ABBREVIATIONS, MONTH_NAMES,
                                            SENTINEL_DATE, SENTINEL_TIME_BASE)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


EXCEL_EPOCH = SENTINEL_TIME_BASE  # Excel day 0 (1899-12-30)


def excel_serial_to_date(c) -> Column:
    """Excel serial day number -> DATE (fractional part = time, dropped)."""
    n = F.floor(_c(c).try_cast("double")).cast("int")
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), n)


def excel_serial_to_timestamp(c) -> Column:
    """Excel serial (with fraction) -> TIMESTAMP_NTZ."""
    secs = F.round(_c(c).try_cast("double") * F.lit(86400.0)).cast("bigint")
    base = F.lit(EXCEL_EPOCH).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", secs, base)


def date_to_excel_serial(c) -> Column:
    """X34 back: DATE -> Excel serial (``datediff(d, 1900-01-01) + 2``)."""
    return (F.datediff(_c(c).cast("date"), F.lit("1900-01-01").cast("date")) + 2).cast("bigint")


def parse_date_text(c, fmt: str = "dd/MM/yyyy") -> Column:
    """Parse with a fixed pattern; unparsable -> null."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def iso_date_text(c, fmt: str = "dd/MM/yyyy") -> Column:
    """Fixed pattern -> ISO ``yyyy-MM-dd`` text."""
    return F.date_format(parse_date_text(c, fmt), "yyyy-MM-dd")


def date_from_parts(day, month, year) -> Column:
    """day/month/year parts joined with '/' and parsed day-first, coercing."""
    txt = F.concat_ws("/", _c(day).cast("string"), _c(month).cast("string"), _c(year).cast("string"))
    return F.try_to_date(txt, "d/M/yyyy")


def date_text_two_digit_year(yy, mm, dd) -> Column:
    """``'20' || yy || '-' || mm || '-' || dd`` as text."""
    return F.concat(F.lit("20"), _c(yy).cast("string"), F.lit("-"),
                    _c(mm).cast("string"), F.lit("-"), _c(dd).cast("string"))


def fill_null_timestamp(c, sentinel: str = SENTINEL_DATE) -> Column:
    """Coerce to TIMESTAMP_NTZ; null / bad -> sentinel."""
    x = _c(c)
    parsed = F.try_to_timestamp(x.cast("string"))
    return F.coalesce(parsed.cast("timestamp_ntz"), F.lit(sentinel).cast("timestamp_ntz"))


def month_number(name) -> Column:
    """Spanish month name -> 1..12, unknown -> null (case-insensitive)."""
    m = F.create_map(*[x for i, n in enumerate(MONTH_NAMES, 1)
                       for x in (F.lit(n.upper()), F.lit(i))])
    return m[F.upper(strip(name))]


def month_label(month_num) -> Column:
    """Month number -> ``'01.Enero'`` label; unknown -> null."""
    arr = F.array(*[F.lit(f"{i:02d}.{n}") for i, n in enumerate(MONTH_NAMES, 1)])
    return F.try_element_at(arr, _c(month_num).cast("int"))


def month_abbrev(month_num) -> Column:
    """Month number -> 'ENE'..'DIC'."""
    arr = F.array(*[F.lit(a) for a in MONTH_ABBREVIATIONS])
    return F.try_element_at(arr, _c(month_num).cast("int"))


def strip(c):
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def business_day_window(run_date) -> tuple[Column, Column]:
    """Monday -> previous Friday .. yesterday; any other day -> yesterday."""
    d = _c(run_date).cast("date")
    is_monday = F.dayofweek(d) == 2
    start = F.when(is_monday, F.date_sub(d, 3)).otherwise(F.date_sub(d, 1))
    end = F.date_sub(d, 1)
    return start, end


def month_start(run_date) -> Column:
    """F16: first day of the month of the run date."""
    return F.trunc(_c(run_date).cast("date"), "MM")
