"""Key building and null-safe key helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def concat_blank_nulls(*cols, sep: str = "-") -> Column:
    """Join parts with ``sep``; a null part contributes ''."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def concat_strict(*cols) -> Column:
    """Plain ``concat``: null if any part is null."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def int_text(c) -> Column:
    """``str(int(x))`` for numbers, '' for null."""
    return F.coalesce(_c(c).try_cast("bigint").cast("string"), F.lit(""))


def id_text(c) -> Column:
    """Id as text without a float tail ('123', never '123.0')."""
    x = _c(c)
    return F.coalesce(x.try_cast("bigint").cast("string"), x.cast("string"))


def row_id(*key_cols, run_id: str | Column) -> Column:
    """Deterministic upper-case 32-hex id of the given values and a run id.

    Each part is written with its length (``3:abc``; null is ``N``), so no two
    lists of values share a text.  As unique as the values are: ids of rows
    come from ``lifecycle.with_row_ids``.  ``uuid()`` would be re-drawn whenever
    a task is recomputed."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    texts = [run, *[_c(c).cast("string") for c in key_cols]]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in texts]
    return F.upper(F.md5(F.concat(*parts)))
