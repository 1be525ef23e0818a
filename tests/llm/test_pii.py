import hashlib
import random
import re

import numpy as np
import pytest

from ledgerline.llm import pii as P
from ledgerline.llm import pii_model as net


def naive(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    r = random.Random(3)
    parts = ["a", "b.", "@", "@", "1", "2", "25", "256", "."," ", "-", "+", "(", ")", "x@y.z", "é", "0", "4111111111111111", "\n", "007", "١"]
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert naive(t) == P.base_spans(t), t
    assert P.base_spans("1" * 200000 + "@" + "a" * 200000) == []


def test_gradients():
    r = np.random.default_rng(0)
    ids, tags = r.integers(0, 20, (3, 7)), np.zeros((3, 7), int)
    tags[0, 2:4], tags[1, 4:6] = (1, 2), (7, 8)
    p = {k: v.astype(np.float64) for k, v in net.new_parameters().items()}
    _, g = net.loss_and_gradients(p, ids, tags)
    for k in p:
        at = tuple(int(r.integers(s)) for s in p[k].shape)
        at = (int(ids[0, 0]), at[1]) if k == "emb" else at
        value = []
        for step in (1e-3, -1e-3):
            q = {a: b.copy() for a, b in p.items()}
            q[k][at] += step
            value.append(net.loss_and_gradients(q, ids, tags)[0])
        assert abs((value[0] - value[1]) / 2e-3 - g[k][at]) < 2e-3


def test_viterbi_is_the_best_path():
    import itertools
    r = np.random.default_rng(2)
    p = net.new_parameters()
    p["trans"] = r.normal(0, 1, (net.TAGS, net.TAGS))
    em = r.normal(0, 2, (2, 4, net.TAGS))
    tr, st = p["trans"] + net.allowed(), p["start"] + net.allowed_start()
    got = net.best_tags(p, em, np.array([4, 3]))
    for i, n in ((0, 4), (1, 3)):
        def value(y):
            return st[y[0]] + sum(em[i, k, t] for k, t in enumerate(y)) + sum(tr[a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product(range(net.TAGS), repeat=n), key=value)
        assert tuple(got[i, :n]) == best


@pytest.fixture(scope="module")
def model(spark):
    from tests.conftest import SF01
    return P.fit(spark.read.parquet(SF01.replace("0.01", "0.1") + "/documents.parquet"), sample_docs=400)


def test_held_out_spans_are_found_by_the_tagger(spark, model):
    from tests.conftest import SF01
    texts = [r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("text").collect()]
    found = [0, 0]
    for t, spans in zip(texts, P.added_spans(model, texts)):
        for s in P.base_spans(t):
            if s[1] != 2:  # card checksums are beyond a tagger
                found[s in spans] += 1
    assert found[1] / sum(found) > 0.9
    clean = [re.sub(r"[0-9@]", "x", t) for t in texts[:200]]
    assert not any(P.added_spans(model, clean))


def test_spans_that_the_patterns_miss(model):
    text = "then (212) 555-0199 and the other of jósé@example.com in it"
    got = P.all_spans(model, [text])[0]
    assert any(text[s:e] == "(212) 555-0199" and P.KINDS[k] == "phone" and not b for s, k, e, b in got)
    assert any(text[s:e].endswith("é@example.com") and P.KINDS[k] == "email" for s, k, e, b in got)


def test_windows_agree_with_one_long_reading(model):
    """A span that crosses windows' borders is read as one."""
    for pad in range(40, 110, 7):
        text = "1 " * (pad // 2) + "the phone is +1 (336) 555-3810 as of now " + "2 " * 60
        want = (text.index("+1"), 3, text.index("3810") + 4)
        assert any(s[:3] == want for s in P.all_spans(model, [text])[0])


def test_added_spans_that_hold_a_base_span(model):
    """The pattern takes a part of the address; the whole one is found and goes."""
    text = "then write to garcía@example.com or to him"
    got = P.all_spans(model, [text])[0]
    assert any(text[s:e] == "garcía@example.com" and not b for s, k, e, b in got)
    assert any(text[s:e] == "a@example.com" and b for s, k, e, b in got)
    assert P.redacted(text, got) == "then write to [EMAIL] or to him"


def test_long_local_parts_are_whole(model):
    name = "maría.del.carmen.fernández.garcía.de.los.ríos.y.san.juan.lópez"
    text = f"then write to {name}@example.com or to him"
    assert len(name) > 60 and "[EMAIL]" in P.redacted(text, P.all_spans(model, [text])[0])
    assert not any(x in P.redacted(text, P.all_spans(model, [text])[0]) for x in ("fern", "lópez"))


def test_a_span_across_the_border_of_parts(model):
    """Long stretches are read in parts; what lies across their border is whole."""
    phone = "+1 (336) 555-3810"
    for at in (P.SEGMENT - 30, P.SEGMENT - 9, P.SEGMENT, P.SEGMENT + 5, P.SEGMENT + P.LAP - 8):
        text = ("7 " * (at // 2))[:at] + "the phone is " + phone + " as of now " + "8 " * P.SEGMENT
        want = (text.index("+1"), 3, text.index("3810") + 4)
        assert any(s[:3] == want for s in P.all_spans(model, [text])[0])
        assert any(a <= want[0] and want[2] <= b for part in P.stretches(text) for a, b in P.segments(text, *part))
    solid = "9" * 50_000 + "é" + "1" * 20_000
    parts = list(P.segments(solid, *P.stretches(solid)[0]))
    assert parts[0][0] == 0 and parts[-1][1] == len(solid) and all(b - a <= P.SEGMENT + P.LAP for a, b in parts)
    assert all(b2 - a2 > 0 and a2 <= b1 for (a1, b1), (a2, b2) in zip(parts, parts[1:]))


def test_the_longer_of_two_readings_counts():
    assert P.reconciled([(5, 0, 9), (5, 0, 20), (12, 0, 16), (30, 0, 31), (5, 1, 9)]) == [(5, 0, 20), (5, 1, 9), (30, 0, 31)]
    base = [(0, 0, 4), (10, 1, 15), (11, 2, 30), (40, 0, 44)]
    spans = sorted([(2, 0, 6), (9, 3, 31), (14, 0, 15), (41, 0, 42), (50, 0, 51)])
    assert P._met(base, spans) == [[b for b in base if b[0] < e and s < b[2]] for s, _, e in spans]


def test_redaction():
    text = "a x@y.zz b +1 (336) 555-3810 c"
    spans = [(s, k, e, True) for s, k, e in P.base_spans(text)]
    assert P.redacted(text, spans) == "a [EMAIL] b [PHONE] c"
    assert P.redacted("4111 1111", []) == "4111 1111"
    assert P.redacted("abcdef", [(1, 0, 4, True), (2, 1, 5, True)]) == "a[EMAIL]f"


def test_table(spark, docs, no_docs, doc_rows, model):
    more = [(3000, "mail a.b@c.de now", "en"), (3001, "at 10.0.0.1 or 300.1.1.1", "en"), (3002, "4111 1111 1111 1111", "en"), (3003, "9" * 5000, "en")]
    df = docs.select("doc_id", "text", "fp").union(spark.createDataFrame([(i, t, "x") for i, t, _ in more], "doc_id long, text string, fp string"))
    got = P.find(df, model).collect()
    assert len(got) == len(doc_rows) + 4
    for r in got:
        base = [(x["start"], P.KINDS.index(x["kind"]), x["end"]) for x in r["pii"] if x["base"]]
        assert base == naive(r["text"] or "")
        assert [tuple(x)[1:3] for x in r["pii"]] == sorted(tuple(x)[1:3] for x in r["pii"])
    assert P.find(no_docs, model).count() == 0
    assert P.fit(no_docs) is None
    assert [len(r["pii"]) for r in P.find(df.filter("doc_id = 3000"), None).collect()] == [1]
    clean = {r["doc_id"]: r["text"] for r in P.redact(df, model).collect()}
    assert clean[3000] == "mail [EMAIL] now" and clean[102] is None and clean[103] == ""


def test_query_columns(spark):
    from tests.conftest import SF001
    rows = P.op7_pii(spark, SF001).join(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        base = naive(r["text"])
        line = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(line.split(",")) - {""} <= set(r["spans"].split(","))
