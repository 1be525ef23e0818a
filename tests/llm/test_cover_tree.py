"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest
from tests.conftest import SF001

from ledgerline.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label string, n long, key string, cell int"


def brute(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) from every pair of rows."""
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    units = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if usable(v) else None for _, v in rows]
    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (vid, _) in enumerate(rows):
        low.setdefault(root(i), [])
        if vid is not None:
            low[root(i)].append(vid)
    out = [(vid, links[i], min(low[root(i)], default=None)) for i, (vid, _) in enumerate(rows)]
    return sorted(((v, k, c, v == c) for v, k, c in out), key=str)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(7)
    rows = []

    def add(v):
        rows.append((len(rows), None if v is None else [None if x is None else float(np.float32(x)) for x in v]))
    for _ in range(120):
        add(r.normal(size=16))
    for spread in (0.01, 0.1, 0.25, 0.4):  # groups from tight ones to chains
        c = r.normal(size=16)
        for _ in range(90):
            add(c + spread * r.normal(size=16) * np.linalg.norm(c) / 4)
    c = r.normal(size=16)
    for k in range(60):  # copies, some scaled
        add(c * (1 + k % 3))
    for k in range(30):
        add(r.normal(size=5))
    add(rows[-1][1])
    for v in ([0.0] * 16, None, [], [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1e-30] * 16, [3e37] * 16, [-0.0, 1.0], [0.0, 2.0]):
        add(v)
    rows += [(None, rows[0][1]), (None, None), (None, [9.0, 1.0, 1.0]), (None, [9.0, 1.0, 1.0]), (5, rows[5][1]), (5, rows[200][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "k", 2) for i, v in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("sample, block", [(1024, 4 << 20), (5, 256 * 8 * 16), (60, 1)])
def test_links_of_all_pairs(spark, vectors, sample, block):
    """With every vector sampled, and with few cells over many blocks."""
    found = cover_tree.near_vectors(frame(spark, vectors), sample=sample, block_bytes=block)
    assert sorted(map(tuple, found.collect()), key=str) == brute(vectors)


def test_one_group_of_many_near_copies(spark):
    """A group that fills several blocks: linked as a whole where it is tight,
    and vector by vector where its pairs lie around the threshold."""
    r = np.random.default_rng(2)
    rows = []
    for spread, n in ((0.02, 700), (0.33, 700)):
        c = r.normal(size=24)
        c /= np.linalg.norm(c)
        rows += [(len(rows) + k, (c + spread * r.normal(size=24) / math.sqrt(24)).astype(np.float32).tolist()) for k in range(n)]
    want = brute(rows)
    for sample in (2, 300):
        found = cover_tree.near_vectors(frame(spark, rows), sample=sample, block_bytes=1)
        assert sorted(map(tuple, found.collect()), key=str) == want


def test_threshold_and_empty(spark):
    x = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, math.sqrt(1 - 0.81) - 1e-9]), (3, [0.9, math.sqrt(1 - 0.81) + 1e-6])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, cover_tree.near_vectors(x, 0.9).collect())) == [(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)]
    none = cover_tree.near_vectors(x.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "n_links", "component_id", "kept"]
    with pytest.raises(ValueError):
        cover_tree.near_vectors(x, 0.0)


def test_query_against_sql(spark):
    import duckdb
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    found = cover_tree.op12_cover_tree(spark, SF001)
    assert sorted(map(tuple, found.collect())) == sorted(db.sql(cover_tree.OP12_SQL).fetchall())
