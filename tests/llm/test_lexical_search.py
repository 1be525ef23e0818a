"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

from tests.conftest import SF001

from ledgerline.llm import lexical_search


def brute(docs, items, top):
    """(item_id, rank, doc_id, score) by the formulas, over all documents."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    count, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, c, _ in bags for w in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        found = []
        for i, c, n in bags:
            m = 100 - 25 + (25 * n * count) // total
            score = 0
            for w in words(text):
                if c[w]:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for k, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:top]):
            out.append((item, k + 1, i, -s))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ranks_like_scoring_all(spark, docs, doc_rows):
    r = random.Random(3)
    texts = [t for _, t, _ in doc_rows if t and t.split()]
    items = [(k, " ".join(r.choices(r.choice(texts).split(), k=12))) for k in range(25)]
    items += [(25, None), (26, ""), (27, "?? !!"), (28, "the the THE of"), (28, "the the THE of"), (None, "one two"), (30, "no such wordatall"), (31, "Ünï çödé 漢字 ÇÖDÉ")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as score", "1 as rank", "2 as q")
    want = brute([(i, t) for i, t, _ in doc_rows], items, 5)
    assert rows(lexical_search.rank(docs, asked, top=5, block_docs=9, query_bytes=300)) == want
    assert rows(lexical_search.rank(docs, asked, top=5)) == want


def test_ties_and_copies(spark):
    """Many equal scores: the smallest ids are taken whatever the blocks."""
    made = [(900 - i, "red green blue" if i % 3 else "red red green") for i in range(900)] + [(None, "red green blue")] * 3
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "red blue"), (2, "green")], "item_id long, text string")
    assert rows(lexical_search.rank(docs, items, top=20, block_docs=64)) == brute(made, [(1, "red blue"), (2, "green")], 20)


def test_long_text_and_string_ids(spark):
    r = random.Random(1)
    names = [f"w{k}" for k in range(300)]
    made = [(f"d{k}", " ".join(r.choices(names, k=r.choice([3, 40, 20_000 if k == 5 else 80])))) for k in range(60)]
    docs = spark.createDataFrame(made, "name string, body string")
    items = [("q", " ".join(names[:150])), ("p", "w1 w2 w3")]
    found = lexical_search.rank(docs, spark.createDataFrame(items, "item_id string, text string"), top=7, doc_id="name", text="body", block_docs=16)
    bags = brute([(k, t) for k, (_, t) in enumerate(sorted(made))], items, 7)
    names_of = dict(enumerate(n for n, _ in sorted(made)))
    assert rows(found) == sorted(((q, k, names_of[i], s) for q, k, i, s in bags), key=str)


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "the of")], "item_id long, text string")
    none = lexical_search.rank(no_docs, items)
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.rank(docs, items.limit(0)).count() == 0


def test_query_against_sql(spark):
    import duckdb
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    found = lexical_search.op11_rmq_search(spark, SF001)
    assert rows(found) == sorted(db.sql(lexical_search.OP11_SQL).fetchall(), key=str)
