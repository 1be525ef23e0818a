import random
import re
from collections import Counter

import numpy as np
import xxhash

from ledgerline.llm import simhash as S
from ledgerline.llm.components import components


def naive_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_roots(values, distance=4):
    x = np.array(values, np.uint64)
    up = list(range(len(x)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= distance):
        a, b = root(i), root(j)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(x))]


def clouds(seed, centers, each, spread):
    r = random.Random(seed)
    out = set()
    for _ in range(centers):
        c = r.getrandbits(64)
        for _ in range(each):
            x = c
            for _ in range(r.randint(0, spread)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(out)


def test_gray_rank_is_the_position_in_the_gray_sequence():
    n = np.arange(4096, dtype=np.uint64)
    assert (S.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_index_matches_brute_force():
    for seed in range(12):
        x = clouds(seed, 1 + seed, 30, 6)
        u, v = S.local_stars(np.array(x, np.uint64), 4)
        star = dict(zip(u.tolist(), v.tolist()))
        root = naive_roots(x)
        assert [star.get(a, a) for a in x] == [x[i] for i in root]


def test_one_or_no_pattern():
    for x in ([], [5]):
        assert len(S.local_stars(np.array(x, np.uint64), 4)[0]) == 0


def test_links_of_a_table_with_hot_buckets(spark):
    x = clouds(3, 25, 12, 5) + clouds(4, 1, 150, 4)
    df = spark.createDataFrame([(int(np.uint64(a).astype(np.int64)),) for a in x], "fp long")
    for rows in (1 << 16, 20):  # 20: buckets are dealt again by other bits
        edges = S.links(spark, df, 4, bucket_rows=rows)
        got = {r["node"]: r["root"] for r in components(spark, edges).collect()}
        signed = [int(np.uint64(a).astype(np.int64)) for a in x]
        classes = {}
        for a, r in zip(signed, naive_roots(x)):
            classes.setdefault(r, []).append(a)
        want = {a: min(c) for c in classes.values() if len(c) > 1 for a in c}
        assert {a: got.get(a, min(want[a], a)) for a in want} == want
        assert set(got) <= set(want)


def test_table(spark, docs, no_docs, doc_rows):
    rows = S.near_groups(docs).collect()
    assert len(rows) == len(doc_rows)
    fps = [naive_fp(t) for _, t, _ in doc_rows]
    low = {}
    for (i, _, _), r in zip(doc_rows, naive_roots(fps)):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    want = Counter((i, f, low[r]) for (i, _, _), f, r in zip(doc_rows, fps, naive_roots(fps)))
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in rows) == want
    assert S.near_groups(no_docs).count() == 0


def test_components_of_chains_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (100, 100), (7, None), (None, None), (200, 3)]
    got = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 200: 0, 101: 100}
    assert components(spark, spark.createDataFrame([], "u long, v long")).count() == 0
