"""Core operators against brute force on random small inputs (nulls, ties)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import dedupe, dims, incremental
from ledgerline.operators.fill import group_fill
from ledgerline.operators.numbering import number_rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
small_int = st.one_of(st.none(), st.integers(0, 3))
small_txt = st.one_of(st.none(), st.sampled_from(["a", "b", "ab", " a"]))
row = st.tuples(small_int, small_txt, st.integers(0, 50))


def _key(r):
    return (r[0], r[1])


@SETTINGS
@given(st.lists(row, max_size=25), st.lists(row, max_size=25))
def test_new_and_existing_rows(spark, batch, hist):
    schema = "k1 int, k2 string, v int"
    b = spark.createDataFrame(batch, schema)
    h = spark.createDataFrame(hist, schema)
    seen = {_key(r) for r in hist}
    exp_new = sorted((r for r in batch if _key(r) not in seen), key=repr)
    exp_old = sorted((r for r in batch if _key(r) in seen), key=repr)
    got_new = sorted((tuple(x) for x in incremental.new_rows(b, h, ["k1", "k2"]).collect()), key=repr)
    got_old = sorted((tuple(x) for x in incremental.existing_rows(b, h, ["k1", "k2"]).collect()), key=repr)
    assert got_new == exp_new and got_old == exp_old


def _nulls_last(v):
    return (v is None, v if v is not None else 0)


@SETTINGS
@given(st.lists(st.tuples(small_int, small_int, st.integers(0, 1000)), max_size=30, unique_by=lambda r: r[2]))
def test_keep_first_and_ordinal(spark, data):
    df = spark.createDataFrame(data, "k int, s int, pos int")
    got = {(r["k"], r["s"], r["pos"]) for r in dedupe.keep_first(df, ["k"], ["s", "pos"]).collect()}
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    exp = {min(g, key=lambda r: (_nulls_last(r[1]), r[2])) for g in groups.values()}
    assert got == exp
    out = number_rows(df, ["s", "pos"], group=["k"], name="n", num_partitions=3)
    got_n = {r["pos"]: r["n"] for r in out.collect()}
    for g in groups.values():
        for i, r in enumerate(sorted(g, key=lambda r: (_nulls_last(r[1]), r[2])), 1):
            assert got_n[r[2]] == i


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 500), small_int),
                max_size=40, unique_by=lambda r: r[1]))
def test_group_fill_matches_ffill_bfill(spark, data):
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = {r["o"]: r["v"] for r in group_fill(df, "k", ["o"], ["v"], distinct=False, num_partitions=3).collect()}
    exp = {}
    groups = {}
    for r in data:
        if r[0] is not None:
            groups.setdefault(r[0], []).append(r)
    for g in groups.values():
        g = sorted(g, key=lambda r: r[1])
        vals = [r[2] for r in g]
        last, ff = None, []
        for v in vals:
            last = v if v is not None else last
            ff.append(last)
        nxt, bf = None, []
        for v in reversed(vals):
            nxt = v if v is not None else nxt
            bf.append(nxt)
        bf.reverse()
        for r, f, b in zip(g, ff, bf):
            exp[r[1]] = f if f is not None else b
    assert got == exp


@SETTINGS
@given(st.lists(st.text(alphabet="abAB (", min_size=0, max_size=4), max_size=8),
       st.lists(st.text(alphabet="abAB (", min_size=1, max_size=6), min_size=1, max_size=6, unique=True))
def test_contains_first_match(spark, probes, names):
    p = spark.createDataFrame([(i, x) for i, x in enumerate(probes)], "i int, p string")
    d = spark.createDataFrame([(n, j) for j, n in enumerate(names)], "name string, pos int")
    got = {r["i"]: r["hit"] for r in dims.contains_first_match(p, "p", d, "name", ["pos"], "hit", "NONE").collect()}
    for i, x in enumerate(probes):
        hits = [n for n in names if x.lower() in n.lower()]
        assert got[i] == (hits[0] if hits else "NONE")


@SETTINGS
@given(st.lists(st.text(alphabet=" \t\n\rab\x0b\x0cÉ", max_size=12), min_size=1, max_size=20))
def test_deep_clean_single_pass_equals_three_steps(spark, texts):
    from pyspark.sql import functions as F
    from ledgerline.functions.text import deep_clean, drop_double_spaces, strip_ws
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    three = drop_double_spaces(F.regexp_replace(strip_ws(F.upper("t")), r"[\n\r\t]", ""))
    got = df.select(deep_clean("t").alias("a"), three.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), small_int, small_txt), max_size=12),
       st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), small_int, small_txt), max_size=12))
def test_fill_across_sources_matches_pandas(spark, first, second):
    import pandas as pd
    from ledgerline.operators.fill import fill_across_sources
    schema = "ot string, x int, y string, pos int"
    f1 = spark.createDataFrame([(*r, i) for i, r in enumerate(first)], schema)
    f2 = spark.createDataFrame([(*r, i) for i, r in enumerate(second)], schema)
    got = sorted((tuple(r) for r in fill_across_sources([f1, f2], "ot", ["pos"]).collect()), key=repr)
    pdf = pd.concat([pd.DataFrame(first, columns=["ot", "x", "y"]),
                     pd.DataFrame(second, columns=["ot", "x", "y"])], ignore_index=True).drop_duplicates()
    parts = [g.ffill().bfill() for _, g in pdf.groupby("ot", sort=False)]
    exp_df = pd.concat(parts).drop_duplicates() if parts else pdf.iloc[0:0]
    exp = sorted((tuple(None if pd.isna(v) else (int(v) if isinstance(v, float) else v) for v in row)
                  for row in exp_df[["ot", "x", "y"]].itertuples(index=False)), key=repr)
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["f", "g"]), small_txt, st.integers(0, 5)),
                max_size=25))
def test_eav_pivot_latest_non_null(spark, data):
    from ledgerline.operators.pivot import eav_pivot
    rows_ = [(e, f, v, ts, i) for i, (e, f, v, ts) in enumerate(data)]
    df = spark.createDataFrame(rows_, "e int, f string, v string, ts int, seq int")
    got = {r["e"]: (r["f"], r["g"], r["h"]) for r in eav_pivot(df, "e", "f", "v", "ts", ["f", "g", "h"], ["seq"]).collect()}
    exp = {}
    for e, f, v, ts, seq in rows_:
        if v is None:
            continue
        cur = exp.setdefault(e, {})
        if f not in cur or (ts, seq) > cur[f][0]:
            cur[f] = ((ts, seq), v)
    exp = {e: (d.get("f", (0, None))[1], d.get("g", (0, None))[1], None) for e, d in exp.items()}
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(small_int, small_txt, st.integers(0, 9)), max_size=30))
def test_duplicate_flag_matches_pandas(spark, data):
    import pandas as pd
    rows_ = [(a, b, i) for i, (a, b, _) in enumerate(data)]
    df = spark.createDataFrame(rows_, "a int, b string, i int")
    got = {r["i"]: r["dup"] for r in dedupe.duplicate_flag(df, ["a", "b"], "dup").collect()}
    pdf = pd.DataFrame(rows_, columns=["a", "b", "i"]).astype(object)
    exp = dict(zip(pdf["i"], pdf.duplicated(subset=["a", "b"], keep=False)))
    assert got == {k: bool(v) for k, v in exp.items()}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["s1", "s2", None]), st.integers(1, 4), st.integers(0, 99)), max_size=30))
def test_latest_version_per_source(spark, data):
    from ledgerline.operators.lifecycle import latest_version
    rows_ = [(s, v, i) for i, (s, v, _) in enumerate(data)]
    df = spark.createDataFrame(rows_, "fuente string, version int, i int")
    got = sorted(r["i"] for r in latest_version(df, "version", per=["fuente"]).collect())
    best = {}
    for s, v, _ in rows_:
        best[s] = max(best.get(s, v), v)
    assert got == sorted(i for s, v, i in rows_ if v == best[s])
