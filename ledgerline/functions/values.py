"""Value fills, replacement maps and CASE helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.constants import (CROSS_SELLING, INACTIVE, NOT_APPLICABLE,
                                            OTHERS, PENDING_STATE, UNASSIGNED, VACANCY_DOCUMENT,
                                            VACANCY_MARKER)
from ledgerline.functions.text import deep_clean, strip_ws


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def fill_by_map(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Typed null fill.  Each default is cast to the column's type, so a
    mismatched default is an error instead of a silently skipped entry."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = {}
    for name, value in defaults.items():
        if name not in types:
            continue
        out[name] = F.coalesce(F.col(name), F.lit(value).cast(types[name]))
    return df.withColumns(out) if out else df


def fill_all(df: DataFrame, number=0, text: str | None = "0") -> DataFrame:
    """Fill every column with a zero of its own type."""
    from ledgerline.functions.numbers import is_numeric_type
    out = {}
    for f in df.schema.fields:
        if is_numeric_type(f.dataType):
            out[f.name] = F.coalesce(F.col(f.name), F.lit(number).cast(f.dataType))
        elif isinstance(f.dataType, StringType) and text is not None:
            out[f.name] = F.coalesce(F.col(f.name), F.lit(text))
    return df.withColumns(out) if out else df


def replace_values(c, mapping: dict, null_to=None) -> Column:
    """Whole-value replacement map; unmapped values unchanged.
    ``null_to`` replaces nulls too (pandas ``replace`` with None in the list)."""
    x = _c(c)
    m = F.create_map(*[v for kv in mapping.items() for v in (F.lit(kv[0]), F.lit(kv[1]))])
    out = F.coalesce(m[x], x)
    if null_to is not None:
        out = F.when(x.isNull(), F.lit(null_to)).otherwise(out)
    return out


def replace_list(c, values: list, target) -> Column:
    """Any of ``values`` -> ``target``."""
    x = _c(c)
    return F.when(x.isin(*values), F.lit(target)).otherwise(x)


def normalise_unassigned(c, spellings: list[str], target: str = OTHERS,
                         pattern: str | None = None) -> Column:
    """Strip + remove newline/tab runs, then map the listed spellings to
    OTROS.  ``pattern`` (e.g. ``'^SIN ASIGNACI.{0,4}N$'``) also maps any text
    it matches, catching mis-encodings the list does not name."""
    x = F.regexp_replace(strip_ws(c), r"[\n\r\t]+", "")
    hit = x.isin(*spellings)
    if pattern:
        hit = hit | F.coalesce(x.rlike(pattern), F.lit(False))
    return F.when(hit, F.lit(target)).otherwise(x)


def keep_if_in(c, allowed: list, default="NO") -> Column:
    """Value if it is in ``allowed`` else the default (null -> default)."""
    x = _c(c)
    return F.when(F.coalesce(x.isin(*allowed), F.lit(False)), x).otherwise(F.lit(default))


def null_if_in(c, sentinels: list) -> Column:
    """Listed sentinels -> null."""
    x = _c(c)
    return F.when(~F.coalesce(x.isin(*sentinels), F.lit(False)), x)


def differs_from(c, value) -> Column:
    """Boolean ``c != value`` where null counts as different."""
    return ~_c(c).eqNullSafe(F.lit(value))


def net_value(category, service_value, difference) -> Column:
    """Net value by data origin ('A' is recoded to CROSS SELLING first):
    NEW and CROSS SELLING take the service value, UP SELLING the difference;
    anything else stays null (no ``otherwise``)."""
    cat = recode_category(category)
    return (F.when(cat.isin("NEW", CROSS_SELLING), _c(service_value))
             .when(cat == F.lit("UP SELLING"), _c(difference)))


def recode_category(category) -> Column:
    x = _c(category)
    return F.when(x == "A", F.lit(CROSS_SELLING)).otherwise(x)


def consultant_state(name, document, state) -> Column:
    """Vacancy or missing document -> INACTIVO; blank/null -> PENDIENTE_ESTADO."""
    vac = F.coalesce(F.contains(_c(name), F.lit(VACANCY_MARKER)), F.lit(False))
    no_doc = F.coalesce(_c(document).cast("string") == "None", F.lit(False)) | _c(document).isNull()
    s = F.when(vac | no_doc, F.lit(INACTIVE)).otherwise(_c(state))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(PENDING_STATE))


def period_by_type(kind, year_month_text, ts) -> Column:
    """Reporting month: additions keep their text month, churn uses the timestamp."""
    k = _c(kind)
    return (F.when(k == "ALTAS", _c(year_month_text))
             .when(k == "BAJAS", F.date_format(_c(ts), "yyyy-MM")))


def vacancy_document(document, name) -> Column:
    """X33: 'vacante' (any case) in the document or the name -> '11'; spaces removed."""
    doc = F.regexp_replace(F.coalesce(_c(document).cast("string"), F.lit(VACANCY_DOCUMENT)), " ", "")
    hit = (F.coalesce(F.lower(doc).contains("vacante"), F.lit(False))
           | F.coalesce(F.lower(_c(name)).contains("vacante"), F.lit(False)))
    return F.when(hit, F.lit(VACANCY_DOCUMENT)).otherwise(doc)


def fill_from(*cols, default: str | None = UNASSIGNED) -> Column:
    """First non-null of the columns, then the default."""
    parts = [_c(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def fill_not_applicable(c) -> Column:
    """X51."""
    return F.coalesce(_c(c), F.lit(NOT_APPLICABLE))


def list_literal_to_array(c) -> Column:
    """A Python list literal stored as text -> ARRAY<STRING>."""
    txt = F.regexp_replace(_c(c), "'", '"')
    return F.from_json(txt, "array<string>")
