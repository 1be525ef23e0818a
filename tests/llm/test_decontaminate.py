import hashlib
import random
import re

from ledgerline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w = split(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = split(item)
        n = min(10, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if n and tuple(w[p:p + n]) in grams:
                hit |= set(range(p, p + n))
                found.add(str(item_id)) if item_id is not None else None
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def items(r):
    words = [f"w{i}" for i in range(30)]
    out = [(i, " ".join(r.choice(words) for _ in range(r.choice([10, 11, 25, 40])))) for i in range(6)]
    return out + [(10, "ünï w1 w2"), (9, "Tail Words Here now"), (11, ""), (12, None), (13, "solo"), (14, out[0][1]), (14, out[0][1]), (None, "lost item of six words here")]


def test_table_against_brute_force(spark, docs, no_docs, doc_rows):
    r = random.Random(2)
    bench = items(r)
    words = [f"W{i}" for i in range(30)]
    made = list(doc_rows)
    for k in range(30):
        base = bench[k % 6][1].upper().split()
        a = r.randrange(max(1, len(base) - 12))
        cut = base[a:a + r.randint(7, 25)]
        made.append((1000 + k, ", ".join([r.choice(words) for _ in range(r.randint(0, 9))] + cut + ["-- tail. words", "here NOW", "ÜNÏ w1"]), "en"))
    made += [(2000, "solo", "en"), (2001, "x Solo. y", "en"), (2002, "ünï W1 w2", "en"), (2003, "LOST item, of six words here!", "en")]
    frame = spark.createDataFrame([(i, t, "x") for i, t, _ in made], "doc_id long, text string, n_words string")
    bench_df = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id long, text string, n long")
    got = sorted((tuple(x) for x in D.report(spark, frame, bench_df).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)
    want = sorted(((i, *brute(t, bench)) for i, t, _ in made), key=repr)
    assert got == want
    assert D.report(spark, no_docs, bench_df).count() == 0
    none = D.report(spark, docs, bench_df.limit(0)).collect()
    assert len(none) == len(doc_rows) and not any(x["contaminated"] for x in none)


def test_every_shared_span_shares_a_fingerprint(spark):
    r = random.Random(9)
    rows = []
    for k in range(60):
        span = [f"s{r.randrange(8)}" for _ in range(10)]
        rows.append((k, [f"a{r.randrange(5)}" for _ in range(r.randint(0, 9))] + span + [f"b{r.randrange(5)}" for _ in range(r.randint(0, 9))], span))
    df = spark.createDataFrame(rows, "k long, words array<string>, span array<string>")
    a = D._fingerprints(df.select("k", "words"), ["k"], [10])
    b = D._fingerprints(df.selectExpr("k", "span AS words"), ["k"], [10])
    assert a.join(b, ["k", "n", "fp"]).select("k").distinct().count() == 60


def test_no_python_on_the_main_path(spark, docs):
    bench = spark.createDataFrame([(1, "the of and to in is that for it with on as")], "item_id long, text string")
    plan = D.report(spark, docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
