"""Many lookups at once and the contains join's index."""

import random
import re

from pyspark.sql import functions as F

from ledgerline.operators import dims
from tests.test_plans import formatted


def made(spark, n=300):
    r = random.Random(5)
    rows = [(i, r.choice(["A", "B", "C", None]), r.choice(["x", "y", None]), r.choice(["A", "Z"])) for i in range(n)]
    dim = [("one", "A", 1), ("one", "A", 7), ("one", "B", 2), ("two", "x", 3), ("two", None, 9), ("three", "A", 4), ("other", "Z", 5)]
    want = {i: (("one", a), ("two", b), ("three", c)) for i, a, b, c in rows}
    ids = {("one", "A"): 7, ("one", "B"): 2, ("two", "x"): 3, ("three", "A"): 4}
    return (spark.createDataFrame(rows, "i int, a string, b string, c string"), spark.createDataFrame(dim, "dominio string, valor string, id int"),
            {i: tuple(ids.get(k) for k in ks) for i, ks in want.items()})




def test_one_dimension_for_all_slots(spark, monkeypatch):
    fact, dim, want = made(spark)
    slots = [("a", "one", "ia"), (F.lower("b"), "two", "ib"), ("c", "three", "ic")]
    for sizes in ([True], [False, True], [False, False]):
        answers = iter(sizes)
        monkeypatch.setattr(dims, "broadcast_if_small", lambda df, size: (df, next(answers)))
        out = dims.lookup_many(fact, dim, slots)
        assert {r["i"]: (r["ia"], r["ib"], r["ic"]) for r in out.collect()} == want
        assert out.columns == ["i", "a", "b", "c", "ia", "ib", "ic"]
    monkeypatch.undo()
    text = formatted(spark, dims.lookup_many(fact, dim, slots)).split("\n\n")[0]
    assert not re.search(r"(?<!Broadcast)Exchange \(", text) and text.count("BroadcastHashJoin") == 3


def test_the_last_of_a_repeated_name_by_its_order(spark):
    fact = spark.createDataFrame([("n",), ("m",), (None,)], "v string")
    dim = spark.createDataFrame([("r", "n", 1, 5), ("r", "n", 9, 2), ("r", "m", 3, None)], "rol string, nombre string, id int, orden int")
    out = dims.lookup_many(fact, dim, [("v", "r", "x")], "rol", "nombre", "id", "orden")
    assert {r["v"]: r["x"] for r in out.collect()} == {"n": 1, "m": 3, None: None}


def test_org_sheets_use_few_shuffles(spark):
    """A sheet's fact: domains and persons are looked up without shuffling it."""
    from ledgerline.plans.registry import load_all
    from tests.conftest import SF001
    for name in ("job_org_red_maestra", "job_org_retail"):
        tree = formatted(spark, load_all()[name].build(spark, SF001)).split("\n\n")[0]
        assert len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) < 15, name


def test_contains_index_is_linear_in_the_text(spark):
    """Listed rows: at most one per character and length of run, not one per substring."""
    names = ["abcdefghij" * k for k in range(1, 30)] + ["Ábaco 100%_x", "", None]
    dim = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, pos int")
    listed = dim.filter("name IS NOT NULL").select("name", F.explode(dims._grams(F.lower("name"))).alias("g"))
    assert listed.count() <= sum(len(n) for n in names if n)
    probes = ["", "a", "ij", "jab", "JABC", "abcdefghijabcdefghija", "100%_", "ÁBACO", "zzzz", "z", None, "%"]
    p = spark.createDataFrame([(x,) for x in probes] * 2, "p string")
    got = {r["p"]: r["hit"] for r in dims.contains_first_match(p, "p", dim, "name", ["pos"], "hit", "NONE").collect()}
    for x in probes:
        hits = [n for n in names if x is not None and n is not None and x.lower() in n.lower()]
        assert got[x] == (hits[0] if hits else "NONE"), x


def test_contains_with_a_run_that_every_name_has(spark):
    """A run shared by all names is found under rarer runs of the probe."""
    dim = spark.createDataFrame([(f"SUPPLIER#{i:06d}", i) for i in range(2000)], "name string, pos int")
    p = spark.createDataFrame([(f"plier#{i:06d}",) for i in range(0, 2000, 100)] + [("supplier",)], "p string")
    got = {r["p"]: r["hit"] for r in dims.contains_first_match(p, "p", dim, "name", ["pos"], "hit").collect()}
    assert got["supplier"] == "SUPPLIER#000000" and all(got[k] == "SUP" + k.upper() for k in got if k != "supplier")
