"""Domain (dimension) tables and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.constants import NOT_APPLICABLE
from ledgerline.functions.text import deep_clean
from ledgerline.operators.incremental import new_rows
from ledgerline.operators.joins import spread_join
from ledgerline.operators.numbering import number_rows
from ledgerline.operators.staging import broadcast_if_small, staged_measured


def domain_candidates(df: DataFrame, cols: list[str], clean=deep_clean,
                      exclude: tuple = (NOT_APPLICABLE,),
                      domain_col: str = "dominio", value_col: str = "valor") -> DataFrame:
    """A4: distinct cleaned values of every configured column, in one pass.

    One unpivot + one map-side-combined distinct instead of a job per column.
    Nulls are dropped (never turned into 'NAN' text, P6)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ids=[], values=cols, variableColumnName=domain_col, valueColumnName=value_col)
    cleaned = long.withColumn(value_col, clean(F.col(value_col)))
    keep = F.col(value_col).isNotNull() & (F.col(value_col) != "")
    if exclude:
        keep = keep & ~F.col(value_col).isin(*exclude)
    return cleaned.filter(keep).distinct()


def new_domain_values(candidates: DataFrame, existing: DataFrame,
                      keys: tuple = ("dominio", "valor")) -> DataFrame:
    """Candidates the domain tables do not hold yet."""
    return new_rows(candidates, existing, list(keys), small_history=True)


def assign_ids(new_values: DataFrame, existing: DataFrame, id_col: str = "id",
               value_col: str = "valor", group: list[str] | None = None) -> DataFrame:
    """Surrogate ids ``max(existing id) + row_number()`` ordered by value,
    per domain when ``group`` is given.  Numbering is range-partitioned, so a
    large domain does not collapse to one task."""
    group = list(group or [])
    order = [value_col]
    if group:
        maxes = existing.groupBy(*group).agg(F.max(id_col).alias("__max"))
        numbered = number_rows(new_values, order, group, "__rn")
        out = spread_join(numbered, maxes, group, "left")
    else:
        mx = existing.agg(F.max(id_col).alias("m")).first()["m"]
        out = number_rows(new_values, order, None, "__rn").withColumn("__max", F.lit(mx))
    return (out.withColumn(id_col, (F.coalesce(F.col("__max"), F.lit(0)) + F.col("__rn")).cast("bigint"))
               .drop("__rn", "__max"))


def lookup(fact: DataFrame, dim: DataFrame, fact_col: str | Column, dim_value_col: str,
           take: dict[str, str], default: dict | None = None, order_col: str | None = None,
           how: str = "left") -> DataFrame:
    """Join on a value, keeping only the looked-up columns.

    ``take`` maps dimension column -> output name.  The dimension is
    de-duplicated on the value first (one whole row per value, so fields never
    mix across duplicates) and the lookup cannot fan out: the last row by
    ``order_col`` wins as in ``dict(zip(k, v))`` (P13), or the greatest row
    where the dimension has no order.  ``how="inner"`` drops fact rows without
    a match (N20).  Large fact values are spread (``spread_join``)."""
    fcol = F.col(fact_col) if isinstance(fact_col, str) else fact_col
    row = F.struct(*[F.col(k).alias(v) for k, v in take.items()])
    last = F.max(row) if order_col is None else F.max_by(row, F.struct(F.col(order_col), row))
    d = (dim.groupBy(F.col(dim_value_col).alias("__lk")).agg(last.alias("__row"))
            .filter(F.col("__lk").isNotNull()).select("__lk", "__row.*"))
    out = spread_join(fact.withColumn("__lk", fcol), d, ["__lk"], how).drop("__lk")
    if default:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in default.items()})
    return out


def lookup_many(fact: DataFrame, dim: DataFrame, slots: list[tuple], group_col: str = "dominio", value_col: str = "valor",
                take: str = "id", order_col: str | None = None) -> DataFrame:
    """N11/N12 for many columns: every slot ``(column, group, output)`` looks its
    value up among the dimension rows of its group.

    The dimension is made one row per (group, value) once for all slots, as in
    ``lookup``, and staged.  If it is measured small it is sent to the fact and
    the fact is not shuffled at all.  If not, it is cut down to the values that
    the fact holds, all slots unpivoted and joined at once; only if those are
    too many as well does each slot join by a shuffle of its own."""
    row = F.col(take) if order_col is None else F.struct(order_col, take)
    one = dim.filter(F.col(group_col).isin(sorted({g for _, g, _ in slots})) & F.col(value_col).isNotNull())
    one = one.groupBy(F.col(group_col).alias("__group"), F.col(value_col).alias("__value")).agg(F.max(row).alias("__row"))
    one, size = staged_measured(one.select("__group", "__value", (F.col("__row") if order_col is None else F.col(f"__row.{take}")).alias("__id")), "dimension")
    values = {f"__v{i}": F.col(c) if isinstance(c, str) else c for i, (c, _, _) in enumerate(slots)}
    out, (few, small) = fact.withColumns(values), broadcast_if_small(one, size)
    if not small:
        held = out.select(F.explode(F.array(*[F.struct(F.lit(g).alias("__group"), F.col(f"__v{i}").cast("string").alias("__value"))
                                              for i, (_, g, _) in enumerate(slots)])).alias("s")).select("s.*").filter("__value IS NOT NULL").distinct()
        one, size = staged_measured(spread_join(one, held, ["__group", "__value"], "left_semi"), "dimension-held")
        few, small = broadcast_if_small(one, size)
    for i, (_, group, name) in enumerate(slots):
        own = (few if small else one).filter(F.col("__group") == group).select(F.col("__value").alias(f"__v{i}"), F.col("__id").alias(name))
        # A filter would lose the hint.
        out = out.join(F.broadcast(own), f"__v{i}", "left") if small else spread_join(out, own, [f"__v{i}"], "left")
    return out.drop(*values)


def keep_if_known(fact: DataFrame, col: str, dim: DataFrame, dim_col: str,
                  fallback: str = NOT_APPLICABLE) -> DataFrame:
    """Keep the value when the dimension holds it, else 'NO APLICA'."""
    known = dim.select(F.col(dim_col).alias("__kv")).distinct().withColumn("__ok", F.lit(True))
    out = spread_join(fact.withColumn("__kv", F.col(col)), known, ["__kv"], "left")
    return (out.withColumn(col, F.when(F.col("__ok"), F.col(col)).otherwise(F.lit(fallback)))
               .drop("__kv", "__ok"))


#: Length of the pieces by which names are found.
GRAM = 3


def _grams(text: Column, n: int = GRAM) -> Column:
    """The distinct runs of ``n`` characters of a text; at most one a character."""
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def contains_first_match(probe: DataFrame, probe_col: str, dim: DataFrame, dim_col: str,
                         dim_order: list, out_col: str, default=None) -> DataFrame:
    """First dimension value (by ``dim_order``) that contains the probe
    text, case-insensitively and literally.

    A q-gram index instead of a nested-loop join: each dimension value is
    listed under each of its runs of ``GRAM`` characters (as many rows as
    characters, not as substrings), and a distinct probe looks only under its
    rarest run; what it finds there is checked literally.  The list of a run
    that many values have is spread over tasks like any hot key's rows.
    Probes of up to ``GRAM`` characters are looked up among the runs of their
    own length, of which each value has one a character too.  Of each probe the
    first match stays, by a map-side-combined minimum."""
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in dim_order], F.col(dim_col))
    values = (dim.select(F.col(dim_col).alias("__val"), order.alias("__ord")).filter(F.col("__val").isNotNull())
                 .groupBy(F.lower("__val").alias("__v")).agg(F.min(F.struct("__ord", "__val")).alias("__best")))
    asked = probe.select(F.lower(F.col(probe_col)).alias("__p")).filter("__p IS NOT NULL").distinct()

    # Short probes: an equi-join on the probe itself, the first value of each run.
    short = asked.filter(F.length("__p") <= GRAM)
    runs = F.array_distinct(F.flatten(F.array(F.array(F.lit("")), *[_grams(F.col("__v"), n) for n in range(1, GRAM + 1)])))
    firsts = values.select("__best", F.explode(runs).alias("__p")).groupBy("__p").agg(F.min("__best").alias("__best"))
    hits = spread_join(short, firsts, ["__p"], "inner")

    # Longer ones: candidates under the rarest run, checked literally.
    listed = values.select("__v", "__best", F.explode(_grams(F.col("__v"))).alias("__g"))
    sizes = listed.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    wide = asked.filter(F.length("__p") > GRAM)
    of_probe = wide.select("__p", F.explode(_grams(F.col("__p"))).alias("__g"))
    rarest = (spread_join(of_probe, sizes, ["__g"], "left")
              .groupBy("__p").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__g").alias("g"))).alias("r"))
              .filter("r.n > 0").select("__p", F.col("r.g").alias("__g")))
    found = (spread_join(listed, rarest, ["__g"], "inner").filter(F.contains("__v", "__p"))
             .groupBy("__p").agg(F.min("__best").alias("__best")))
    first = hits.unionByName(found).select("__p", F.col("__best.__val").alias("__hit"))
    out = spread_join(probe.withColumn("__p", F.lower(F.col(probe_col))), first, ["__p"], "left")
    return (out.withColumn(out_col, F.coalesce(F.col("__hit"), F.lit(default).cast("string")))
               .drop("__p", "__hit"))


def contains_match_two(probe: DataFrame, probe_col: str, first: tuple, second: tuple,
                       out_first: str, out_second: str, exclusive: bool, default=None,
                       return_probe: bool = False) -> DataFrame:
    """N16 with two dimensions, each given as ``(dim, dim_col, dim_order)``.

    ``exclusive=False``: both lookups are independent.  ``exclusive=True``:
    the second dimension is consulted only for probes the first one misses
    (e.g. specialist first, else coordinator).  ``return_probe=True`` puts
    the probe text itself in the matching slot instead of the matched name."""
    d1, c1, o1 = first
    d2, c2, o2 = second
    out = contains_first_match(probe, probe_col, d1, c1, o1, out_first, None)
    out = contains_first_match(out, probe_col, d2, c2, o2, out_second, None)
    if exclusive:
        out = out.withColumn(out_second, F.when(F.col(out_first).isNull(), F.col(out_second)))
    if return_probe:
        out = out.withColumns({c: F.when(F.col(c).isNotNull(), F.col(probe_col)) for c in (out_first, out_second)})
    if default is not None:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in (out_first, out_second)})
    return out
