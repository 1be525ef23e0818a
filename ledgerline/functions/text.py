"""Text cleaning expressed with native Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.constants import SPECIAL_CHARS_CLASS, VACANCY_MARKER

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Strip all leading/trailing whitespace (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def strip_upper(c: ColumnOrName) -> Column:
    """Strip then upper-case."""
    return F.upper(strip_ws(c))


def drop_double_spaces(c: ColumnOrName) -> Column:
    """Delete each pair of spaces, so 2 spaces vanish and 3 become 1."""
    return F.regexp_replace(_c(c), "  ", "")


def deep_clean(c: ColumnOrName) -> Column:
    """Upper -> strip -> remove \\n \\r \\t -> delete double spaces.

    Strip and the tab/newline removal run as one regex pass (leading run,
    trailing run, or any tab/newline): same result, one scan of the text
    fewer."""
    x = F.regexp_replace(F.upper(_c(c)), r"^\s+|\s+$|[\n\r\t]", "")
    return drop_double_spaces(x)


def remove_special(c: ColumnOrName) -> Column:
    """Remove ``| . * } $ @`` then upper and strip again."""
    return strip_upper(F.regexp_replace(_c(c), SPECIAL_CHARS_CLASS, ""))


def remove_dots(c: ColumnOrName) -> Column:
    """Remove every dot."""
    return F.regexp_replace(_c(c), r"\.+", "")


def trim_trailing_dots(c: ColumnOrName) -> Column:
    """Drop dots trailing an e-mail address."""
    return F.regexp_replace(_c(c), r"\.+$", "")


def lstrip_char(c: ColumnOrName, ch: str = "$") -> Column:
    """Left-strip a character."""
    import re as _re
    return F.regexp_replace(_c(c), "^" + _re.escape(ch) + "+", "")


def truncate(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(c), 1, n)


def rightmost(c: ColumnOrName, n: int = 8) -> Column:
    """Last ``n`` characters of the text form."""
    return F.right(_c(c).cast("string"), F.lit(n))


def first_token(c: ColumnOrName) -> Column:
    """First whitespace-separated token."""
    return F.split(strip_ws(c), r"\s+").getItem(0)


def after_dash_code(c: ColumnOrName, length: int = 3) -> Column:
    """``SUBSTRING(x, POSITION(' - ' IN x) + 2, n)``."""
    x = _c(c)
    return F.substr(x, F.locate(" - ", x) + 2, F.lit(length))


def strip_accents_lower(c: ColumnOrName) -> Column:
    """X11: ``translate`` of lower-case accented vowels, as written."""
    return F.translate(_c(c), "áéíóú", "aeiou")


def replace_map(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Chained literal replacements (not regex)."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])),
                  mapping.items(), _c(c))


def remove_vacancy_marker(c: ColumnOrName) -> Column:
    """Remove ``(VACANTE)`` / ``(VACANTA)`` then strip."""
    return strip_ws(F.regexp_replace(_c(c), r"\(VACANT[EA]\)", ""))


def vacancy_state(name: ColumnOrName, state: ColumnOrName, inactive: int = 4) -> Column:
    """State 4 when the (uncleaned) name carries the vacancy marker."""
    hit = F.coalesce(F.contains(_c(name), F.lit(VACANCY_MARKER)), F.lit(False))
    return F.when(hit, F.lit(inactive)).otherwise(_c(state))


def fix_document(c: ColumnOrName) -> Column:
    """Drop a leading '1' from 9- or 11-digit documents."""
    x = _c(c).cast("string")
    return F.when(F.length(x).isin(9, 11) & x.startswith("1"),
                  F.substr(x, F.lit(2))).otherwise(x)


def contains_ci(c: ColumnOrName, needle: str) -> Column:
    """Case-insensitive literal contains; null -> false."""
    return F.coalesce(F.contains(F.lower(_c(c)), F.lit(needle.lower())), F.lit(False))


def clean_all_strings(df: DataFrame, fn=strip_upper, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Apply ``fn`` to every string column of ``df`` (X1 over the schema)."""
    cols = {f.name: fn(F.col(f.name)) for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in exclude}
    return df.withColumns(cols) if cols else df


def rename_rule(name: str) -> str:
    """Strip, lower, spaces -> '_'."""
    return "_".join(name.strip().lower().split(" "))

