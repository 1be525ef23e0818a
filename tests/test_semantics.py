"""pandas semantics restated in Spark, on tiny frames with
nulls, ties and odd spacing that the driver tables never contain."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import numbers as N
from ledgerline.functions import predicates as P
from ledgerline.functions import text as T
from ledgerline.functions import values as V
from ledgerline.operators import dedupe, dims, incremental
from ledgerline.operators.fill import group_fill
from ledgerline.operators.pivot import eav_pivot, guarded_bigint


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_p1_null_keys_match_null(spark):
    batch = spark.createDataFrame([(1, None, "a"), (2, "x", "b"), (None, None, "c")], "k1 int, k2 string, v string")
    hist = spark.createDataFrame([(1, None), (None, None)], "k1 int, k2 string")
    out = incremental.new_rows(batch, hist, ["k1", "k2"])
    assert rows(out, "v") == [("b",)]


def test_n1_concat_collisions_do_not_match(spark):
    # '1'+'23' and '12'+'3' collide as text keys; typed keys keep them apart.
    batch = spark.createDataFrame([(1, 23), (12, 3)], "cuenta bigint, ot bigint")
    hist = spark.createDataFrame([(12, 3)], "cuenta bigint, ot bigint")
    assert rows(incremental.new_rows(batch, hist, ["cuenta", "ot"])) == [(1, 23)]


def test_p2_p3_p4_keep_nulls(spark):
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "c string")
    assert df.filter(P.not_equal_keep_null("c", "X")).count() == 2
    assert df.filter(P.not_in_keep_null("c", ["X", "Y"])).count() == 1
    assert df.filter(P.matches("c", "X")).count() == 1
    assert df.filter(P.not_matches("c", "X")).count() == 2


def test_p5_groupby_drops_null_keys(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, "z"), ("a", 1, None), ("a", 2, "q")],
                               "k string, o int, v string")
    out = group_fill(df, "k", ["o"], ["v"], distinct=False)
    assert rows(out, "k", "o", "v") == [("a", 1, "q"), ("a", 2, "q")]


def test_p6_no_nan_text(spark):
    df = spark.createDataFrame([(None,), ("  a ",)], "c string")
    out = dims.domain_candidates(df, ["c"])
    assert rows(out, "valor") == [("A",)]


def test_p7_strip_all_whitespace(spark):
    df = spark.createDataFrame([("\t x \n",)], "c string")
    assert df.select(T.strip_ws("c")).first()[0] == "x"
    assert df.select(F.trim("c")).first()[0] != "x"  # why trim is not used


def test_p8_double_space_rule(spark):
    df = spark.createDataFrame([("a  b",), ("a   b",)], "c string")
    assert sorted(r[0] for r in df.select(T.drop_double_spaces("c")).collect()) == ["a b", "ab"]


def test_p9_coerce_instead_of_fail(spark):
    df = spark.createDataFrame([("12",), ("1e3",), ("abc",), (None,), ("99999999999999999999",)], "c string")
    got = [r[0] for r in df.select(N.coerce_number("c", "bigint")).collect()]
    assert got == [12, 1000, 0, 0, 0]
    got = [r[0] for r in df.select(N.digits_or_zero("c")).collect()]
    assert got == [12, 0, 0, 0, 0]
    got = [r[0] for r in df.select(guarded_bigint("c")).collect()]
    assert got == [12, None, None, None, None]


def test_p10_keep_first_by_ingest_position(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b"), ("j", 5, "z")],
                               "key string, _ingest_pos int, v string")
    out = dedupe.keep_first(df, ["key"], ["_ingest_pos"])
    assert rows(out, "key", "v") == [("j", "z"), ("k", "a")]


def test_p11_nulls_last_with_tiebreak(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 2.0, 2), ("k", 2.0, 0)], "key string, s double, pos int")
    out = dedupe.keep_first(df, ["key"], ["s"])
    assert rows(out, "s", "pos") == [(2.0, 0)]


def test_p12_combine_first(spark):
    from ledgerline.operators.fill import resolve_twins
    left = spark.createDataFrame([(1, None), (2, "l")], "k int, c string")
    right = spark.createDataFrame([(1, "r1"), (2, "r2")], "k int, c string")
    assert rows(resolve_twins(left, right, "k", prefer="left")) == [(1, "r1"), (2, "l")]
    assert rows(resolve_twins(left, right, "k", prefer="right")) == [(1, "r1"), (2, "r2")]


def test_p13_last_duplicate_wins(spark):
    dim = spark.createDataFrame([("A", 1, 0), ("A", 2, 1), ("B", 3, 2)], "valor string, id int, pos int")
    fact = spark.createDataFrame([("A",), ("B",), ("C",)], "v string")
    out = dims.lookup(fact, dim, "v", "valor", {"id": "id"}, order_col="pos")
    assert rows(out, "v", "id") == [("A", 2), ("B", 3), ("C", None)]
    assert rows(dims.lookup(fact, dim, "v", "valor", {"id": "id"}, how="inner"), "v", "id") == [("A", 2), ("B", 3)]  # N20


def test_p14_ids_as_text_without_float_tail(spark):
    from ledgerline.functions.keys import id_text, int_text
    df = spark.createDataFrame([(123.0,), (None,)], "x double")
    assert [r[0] for r in df.select(int_text("x")).collect()] == ["123", ""]
    assert df.select(id_text("x")).first()[0] == "123"


def test_p15_pivot_first_skips_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "f", "old", t, 0), (1, "f", None, t + dt.timedelta(1), 1),
                                (1, "g", "x", t, 2)], "id int, field string, value string, ts timestamp, seq int")
    out = eav_pivot(df, "id", "field", "value", "ts", ["f", "g", "h"], ["seq"])
    assert out.columns == ["id", "f", "g", "h"]
    assert rows(out) == [(1, "old", "x", None)]


def test_rounding_matches_pandas(spark):
    df = spark.createDataFrame([(10155.0,), (2345.0,), (-1035.0,)], "x double")
    got = [r[0] for r in df.select(N.scale_thousands("x")).collect()]
    assert got == [round(10.155, 2), round(2.345, 2), round(-1.035, 2)]


def test_fill_by_map_is_typed(spark):
    df = spark.createDataFrame([(None, None)], "a string, b double")
    out = V.fill_by_map(df, {"a": "NO REGISTRA", "b": 0, "absent": 1})
    assert out.first() == ("NO REGISTRA", 0.0)


def test_vacancy_flag_before_marker_removal(spark):
    df = spark.createDataFrame([("ANA (VACANTE)",), ("LUIS",)], "n string")
    out = df.select(T.vacancy_state("n", F.lit(1)).alias("s"), T.remove_vacancy_marker("n").alias("n"))
    assert rows(out) == [(1, "LUIS"), (4, "ANA")]


def test_contains_join_is_literal_and_first_by_order(spark):
    probe = spark.createDataFrame([("(vacante)",), ("ana",), ("zz",)], "p string")
    dim = spark.createDataFrame([("MARIANA", 2), ("ANA (VACANTE)", 1), ("JUANA", 3)], "name string, pos int")
    out = dims.contains_first_match(probe, "p", dim, "name", ["pos"], "hit", default="NO APLICA")
    assert rows(out) == [("(vacante)", "ANA (VACANTE)"), ("ana", "ANA (VACANTE)"), ("zz", "NO APLICA")]


def test_contains_match_two_dimensions_priority(spark):
    probe = spark.createDataFrame([("ana",), ("luis",), ("zoe",)], "p string")
    spec = spark.createDataFrame([("MARIANA", 1)], "name string, pos int")
    coord = spark.createDataFrame([("ANA MARIA", 1), ("LUISA", 2)], "name string, pos int")
    ind = dims.contains_match_two(probe, "p", (spec, "name", ["pos"]), (coord, "name", ["pos"]),
                                  "esp", "coord", exclusive=False, default="NO APLICA")
    assert rows(ind) == [("ana", "MARIANA", "ANA MARIA"), ("luis", "NO APLICA", "LUISA"),
                         ("zoe", "NO APLICA", "NO APLICA")]
    exc = dims.contains_match_two(probe, "p", (spec, "name", ["pos"]), (coord, "name", ["pos"]),
                                  "esp", "coord", exclusive=True, default="NO APLICA")
    assert rows(exc) == [("ana", "MARIANA", "NO APLICA"), ("luis", "NO APLICA", "LUISA"),
                         ("zoe", "NO APLICA", "NO APLICA")]


def test_unassigned_spellings_list_and_pattern(spark):
    from ledgerline.functions.constants import UNASSIGNED_SPELLINGS
    df = spark.createDataFrame([(" SIN ASIGNACIÓN\n",), ("SIN ASIGNACI#N",), ("NORTE",), (None,)], "g string")
    plain = [r[0] for r in df.select(V.normalise_unassigned("g", UNASSIGNED_SPELLINGS)).collect()]
    assert plain == ["OTROS", "SIN ASIGNACI#N", "NORTE", None]
    pat = [r[0] for r in df.select(V.normalise_unassigned("g", UNASSIGNED_SPELLINGS,
                                                          pattern="^SIN ASIGNACI.{0,4}N$")).collect()]
    assert pat == ["OTROS", "OTROS", "NORTE", None]


def test_operators_accept_empty_inputs(spark):
    from ledgerline.operators.numbering import number_rows
    empty = spark.createDataFrame([], "k string, o int, v int")
    assert number_rows(empty, ["o"], group=["k"], name="n").count() == 0
    assert number_rows(empty, ["o"], name="n").count() == 0
    assert group_fill(empty, "k", ["o"], ["v"]).count() == 0
    batch = spark.createDataFrame([("a", 1, 1)], "k string, o int, v int")
    assert incremental.new_rows(batch, empty, ["k"]).count() == 1
    assert incremental.new_rows(empty, batch, ["k"]).count() == 0
    ids = dims.assign_ids(spark.createDataFrame([("d", "x")], "dominio string, valor string"),
                          spark.createDataFrame([], "dominio string, valor string, id bigint"),
                          group=["dominio"])
    assert [tuple(r) for r in ids.select("valor", "id").collect()] == [("x", 1)]


def test_lookup_by_broadcast_and_by_shuffle_agree(spark):
    fact = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in range(300)] + [(None, -1)], "k int, v int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(300)], "k int, name string")
    small = sorted(map(tuple, dims.lookup(fact, dim, "k", "k", {"name": "name"}).collect()), key=repr)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in keep:
            spark.conf.set(k, "-1")
        large = dims.lookup(fact, dim, "k", "k", {"name": "name"})
        assert sorted(map(tuple, large.collect()), key=repr) == small
        assert large.filter(F.col("name").isNull()).count() == 1   # only the null key: it never matches
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_spread_join_with_hot_key_and_map_column(spark):
    from ledgerline.operators.joins import spread_join
    left = spark.createDataFrame([("h" if i % 2 else f"k{i}", i, {"a": i}) for i in range(64)],
                                 "k string, v int, m map<string,int>")
    right = spark.createDataFrame([("h", "HOT")] + [(f"k{i}", f"n{i}") for i in range(0, 64, 2)], "k string, name string")
    out = spread_join(left, right, ["k"], "left")
    assert out.columns == ["k", "v", "m", "name"]
    assert out.count() == 64 and out.filter(F.col("name").isNull()).count() == 0
    assert out.filter(F.col("k") == "h").select("name").distinct().collect()[0][0] == "HOT"


def test_spread_join_of_keys_of_unlike_types(spark):
    from ledgerline.operators.joins import spread_join
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, v string")
    for kind in ("int", "double", "decimal(10,2)", "smallint"):
        right = spark.createDataFrame([(1,), (2,)], "k int").select(F.col("k").cast(kind), F.lit("x").alias("hit"))
        got = spread_join(left, right, ["k"], "left").select("v", "hit").collect()
        assert sorted(map(tuple, got), key=repr) == sorted([("a", "x"), ("b", "x"), ("c", None)], key=repr), kind


def test_contains_match_of_one_letter_and_empty_probes(spark):
    probe = spark.createDataFrame([("a",), ("",), (None,), ("zz",), ("AN",)], "p string")
    dim = spark.createDataFrame([("Mariana", 2), ("Ana", 1), ("Pedro", 3), (None, 0)], "name string, pos int")
    out = dims.contains_first_match(probe, "p", dim, "name", ["pos"], "hit", "NO")
    assert sorted((r["p"], r["hit"]) for r in out.collect() if r["p"] is not None) == [("", "Ana"), ("AN", "Ana"), ("a", "Ana"), ("zz", "NO")]
    assert out.filter("p IS NULL").first()["hit"] == "NO"
