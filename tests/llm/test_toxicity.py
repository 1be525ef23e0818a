import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from ledgerline.llm import toxicity as T
from tests.llm.conftest import EN, make_text


def test_search_is_exact():
    r = np.random.default_rng(1)
    for _ in range(120):
        n = int(r.integers(0, 300))
        vectors, full = [], np.zeros((n, 12))
        for i in range(n):
            t = np.sort(r.choice(12, r.integers(0, 6), replace=False))
            w = r.random(len(t)).round(1) + 0.1
            w = w / np.sqrt((w * w).sum()) if len(t) else w
            vectors.append((t, w))
            full[i, t] = w
        q = np.sort(r.choice(12, 4, replace=False))
        w = r.random(4)
        got = T.BlockMaxIndex(vectors, block=16).search(q.tolist(), w.tolist(), 7)
        scores = full[:, q] @ w
        want = sorted(((-s, i) for i, s in enumerate(scores) if s > 0))[:7]
        assert np.allclose([s for s, _ in got], [-s for s, _ in want])


def planted(spark, seed=3, n=600):
    r = random.Random(seed)
    bad = ["grobble", "fnarg", "zwick", "plonker"]
    docs, labels = [], []
    for i in range(n):
        words = make_text(r, EN, r.randint(20, 60)).split()
        toxic = i % 6 == 0
        if toxic:
            for w in r.sample(bad, 2):
                words.insert(r.randrange(len(words)), w)
        docs.append((i, " ".join(words), "x"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(toxic)))
    extra = [(9000, None, None), (9001, "", "x"), (None, "no id fnarg zwick", "x"), (9002, "fnarg " * 5000, "x"), (5, docs[6][1], "x"), docs[7], docs[7]]
    labels += [(9001, None), (None, 1), (12, 1)]
    return (spark.createDataFrame(docs + extra, "doc_id long, text string, score string"),
            spark.createDataFrame([(i, 0, t) for i, t in labels], "doc_id long, quality int, toxic int"), docs)


def test_planted_words_are_found_on_held_out_rows(spark):
    df, labels, docs = planted(spark)
    model, counted = T.fit(df.select("doc_id", "text"), labels)
    heaviest = sorted(model.words, key=lambda w: -model.scale[model.words[w]])[:4]
    assert set(heaviest) == {"grobble", "fnarg", "zwick", "plonker"}
    got = T.score(counted, model).collect()
    assert len(got) == len(docs) + 7
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 60
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in held if r["doc_id"] != 5)
    train = {i for i, in labels.filter("doc_id IS NOT NULL").select("doc_id").collect() if zlib.crc32(str(i).encode()) % 5}
    assert all(set(r["evidence"]) <= train for r in got)  # no held-out label is used
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[9000] == by[9001] < 0.5 and by[9002] >= 0.5 and by[None] >= 0.5


def test_no_labels_and_no_rows(spark):
    df, labels, docs = planted(spark, n=40)
    model, counted = T.fit(df.select("doc_id", "text"), labels.limit(0))
    assert {r["score"] for r in T.score(counted, model).collect()} == {0.0}
    model, counted = T.fit(df.select("doc_id", "text").limit(0), labels)
    assert T.score(counted, model).count() == 0
    model, counted = T.fit(df.select("doc_id", "text"), labels.filter("toxic = 1"))
    assert {r["score"] for r in T.score(counted, model).collect()} == {1.0}


def test_rare_words_count_in_the_cosine(spark):
    """A near copy of a toxic example finds it by words that no other text has,
    and cosines are over all words of either text."""
    df, labels, docs = planted(spark, n=200)
    rare = " ".join(f"vex{k}" for k in range(20))
    ids = [i for i in range(5000, 5040) if zlib.crc32(str(i).encode()) % 5][:2]
    own = [(ids[0], rare + " alpha", "x"), (8001, rare + " beta gamma gamma", "x")]
    labels = labels.unionByName(spark.createDataFrame([(ids[0], 0, 1)], labels.schema))
    texts = df.union(spark.createDataFrame(own, df.schema)).select("doc_id", "text")
    model, found = T.fit(texts, labels)
    got = {r["doc_id"]: r for r in found.collect()}
    assert T.score(found, model).filter("doc_id = 8001").head()["evidence"][0] == ids[0]

    rows = [(T._words((r["text"] or "").lower())) for r in texts.collect()]
    n = len(rows)
    idf = {w: np.log((1 + n) / (1 + sum(w in set(x) for x in rows))) for w in {*own[0][1].split(), *own[1][1].split()}}
    a, b = ({w: (1 + np.log(t.split().count(w))) * idf[w] for w in t.split()} for _, t, _ in own)
    # A word of the examples weighs more where it tells the classes apart.
    scale = {w: model.scale[model.words[w]] / idf[w] if w in model.words else 1.0 for w in idf}
    assert all(v >= 1 for v in scale.values()) and scale["beta"] == scale["gamma"] == 1.0
    a, b = ({w: x * scale[w] for w, x in v.items()} for v in (a, b))
    dot = sum(x * b.get(w, 0) for w, x in a.items())
    want = dot / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    assert abs(got[8001]["cosines"][0] - want) < 1e-6


def test_many_blocks_are_dropped_by_their_bounds():
    """Vectors of one topic stand together; a query of a topic scores few blocks."""
    r = np.random.default_rng(2)
    vectors = []
    for i in range(1280):
        t = np.array(sorted({i // 128 * 3, i // 128 * 3 + 1, 30 + int(r.integers(0, 5))}))
        w = r.random(len(t)) * 0.1 + np.where(t < 30, 1.0, 0.01)
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = T.BlockMaxIndex(vectors)
    full = np.zeros((1280, 35))
    for i, (t, w) in enumerate(vectors):
        full[i, t] = w
    seen = []
    real = np.einsum
    for q in range(0, 1280, 100):
        t, w = vectors[q]
        try:
            np.einsum = lambda *a: seen.append(a[2].shape[0]) or real(*a)
            got = index.search(t, w, 7, skip=q)
        finally:
            np.einsum = real
        scores = full[:, t] @ w
        want = sorted((-s, i) for i, s in enumerate(scores) if s > 0 and i != q)[:7]
        assert np.allclose([s for s, _ in got], [-s for s, _ in want])
    assert sum(seen) <= 13 * 12  # of 20 blocks a query


def counted(docs, labels):
    """Words of each text, document frequencies, and the training rows."""
    bag = {t: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for _, t in docs}
    n = len(docs)
    df = Counter(w for _, t in docs for w in bag[t])
    marked = {(i, y) for i, y in labels if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5}
    train = {(i, t or "", y) for i, t in docs for j, y in marked if i == j}
    shares = Counter(y for _, _, y in train)
    return bag, n, df, train, shares


def test_scores_and_evidence_of_all_cosines(spark):
    """Every document against every example, in plain Python."""
    df_, labels_, docs = planted(spark, n=260)
    rows = [(r["doc_id"], r["text"]) for r in df_.collect()]
    labels = [(r["doc_id"], r["toxic"]) for r in labels_.collect()]
    model, found = T.fit(df_.select("doc_id", "text"), labels_)
    bag, n, df, train, shares = counted(rows, labels)
    # The examples: each distinct text of a class once, by its smallest id.
    chosen = {}
    for i, t, y in train:
        chosen[t, y] = min(chosen.get((t, y), i), i)
    assert sorted(zip(model.ids, model.labels.tolist())) == sorted((i, y) for (_, y), i in chosen.items())
    text_of = {(i, y): t for (t, y), i in chosen.items()}
    ex = [(i, int(y), bag[text_of[i, y]] if text_of[i, y] in bag else bag[None]) for i, y in zip(model.ids, model.labels.tolist())]
    size = Counter(y for _, y, _ in ex)
    held = [Counter(w for _, y, b in ex if y == c for w in b) for c in (0, 1)]

    def scale(w):
        idf = math.log((1 + n) / (1 + df[w]))
        a, b = (held[c][w] + T.PRIOR * size[c] / len(ex) for c in (1, 0))
        return idf * (1 + math.log(a / b * size[0] / size[1]) ** 2)

    def vector(b):
        return {w: (1 + math.log(c)) * scale(w) for w, c in b.items()}
    vectors = [vector(b) for _, _, b in ex]
    norms = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]

    def nearest(v, skip=-1):
        norm = math.sqrt(sum(x * x for x in v.values()))
        s = [(-sum(x * e.get(w, 0) for w, x in v.items()) / (norm * m), j) for j, (e, m) in enumerate(zip(vectors, norms)) if m and norm and j != skip]
        return [(-c, j) for c, j in sorted(x for x in s if x[0] < 0)[:T.NEIGHBOURS]]

    def vote(f):
        w = [1 / (1 - min(c, 1) + 0.05) for c, _ in f]
        p = (sum(a * ex[j][1] for a, (_, j) in zip(w, f)) + 0.1) / (sum(w) + 0.2)
        return math.log(p / (1 - p))
    curve = T._logistic(np.array([[1, vote(nearest(v, j))] for j, v in enumerate(vectors) if nearest(v, j)]),
                        np.array([ex[j][1] for j, v in enumerate(vectors) if nearest(v, j)], float),
                        np.array([shares[ex[j][1]] / size[ex[j][1]] for j, v in enumerate(vectors) if nearest(v, j)]))
    got = {}
    for r in T.score(found, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        f = nearest(vector(bag[t]))
        want = model.empty if not f else 1 / (1 + math.exp(-max(-30, min(30, curve[0] + curve[1] * vote(f)))))
        near = min(got[i], key=lambda r: abs(r["score"] - want))
        assert abs(near["score"] - want) < 1e-6, (i, near, want)
        assert np.allclose(near["cosines"], [c for c, _ in f], atol=1e-6)


def test_copies_and_near_copies_take_one_place(spark):
    """Texts in thousands of copies leave room for all others of their class."""
    r = random.Random(2)
    base = make_text(r, EN, 120)
    docs = [(i, base) for i in range(3000)]
    docs += [(3000 + i, base + f" end{i}") for i in range(40)]
    docs += [(4000 + i, make_text(r, [f"{w}{i}" for w in EN], 60)) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 4025)) for i, _ in docs], "doc_id long, toxic int")
    chosen, shares = T.examples(df, labels, per_class=20)
    rows = chosen.collect()
    train = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5]
    assert shares[0] == sum(i < 4025 for i in train)
    clean = [x["doc_id"] for x in rows if x["toxic"] == 0]
    assert sum(i < 4000 for i in clean) <= 1 and len(clean) == min(20, 1 + sum(4000 <= i < 4025 for i in train))
    assert len({x["h"] for x in rows}) == len(rows)


def test_shared_passages_do_not_make_near_copies(spark):
    """Different texts with one common passage stay examples of their own."""
    r = random.Random(4)
    passage = make_text(r, EN, 30)
    docs = [(i, passage + " " + " ".join(f"u{i}x{k}" for k in range(90))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    chosen, _ = T.examples(df, labels)
    assert chosen.count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i, _ in docs)


def test_common_words_of_texts_without_labels_are_counted(spark):
    """A word that no example has and most texts have: part of every norm."""
    docs = [(i, f"alpha{i} beta gamma") for i in range(20)] + [(1000 + i, f"omega tail{i} beta") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    model, found = T.fit(df, labels)
    assert "omega" not in model.words
    n = len(docs)
    idf = lambda k: math.log((1 + n) / (1 + k))
    beta = model.scale[model.words["beta"]]
    for r in found.filter("doc_id >= 1000").collect():
        size = math.sqrt(beta ** 2 + idf(400) ** 2 + idf(1) ** 2)
        assert abs(beta - idf(n)) < 1e-9 and (not r["cosines"] or max(r["cosines"]) <= beta / size + 1e-6)
    counted = T.bags(df, model.words, ["doc_id"])
    norms = {r["row"]: r["rest_norm"] / 1e9 for r in T._rest_norms(T.saved(spark, counted, "t"), n).collect()}
    assert {round(v, 5) for v in norms.values()} - {round(idf(1) ** 2, 5)} == {round(idf(400) ** 2 + idf(1) ** 2, 5)}
