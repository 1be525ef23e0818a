"""Sharded Lloyd rounds against whole vectors in exact integers."""

import hashlib
import math

import numpy as np
from tests.conftest import SF001

from ledgerline.llm import lloyd


def brute(rows, k=8, rounds=10, dims=64, seed=3):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [r for r in kept if r[0] is not None]
    named.sort(key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i8").tobytes()))
    centres = [v for _, v in named[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return far.index(min(far)), min(far)
    if not centres:
        return []
    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in kept]
        for c in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centres[c] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *nearest(v)) for i, v in kept]
    sums = [sum(d for _, o, d in last if o == c) for c in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, o, d, sums[o], sum(sums), digest[o]) for i, o, d in last), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 4) for i, v in rows], "vec_id long, embedding array<float>, cluster string, grp long").repartition(3)


def made(n, dims, seed=1):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(5, dims))
    return [(k, (centre[k % 5] + r.normal(size=dims)).astype(np.float32).tolist()) for k in range(n)]


def test_rounds_of_whole_vectors(spark):
    rows = made(150, 64)
    rows += [(i, v) for i, v in rows[:20]] + [(200, rows[3][1]), (None, rows[4][1]), (None, rows[9][1]), (201, None), (202, []), (203, [1.0] * 63),
             (204, [None] + [1.0] * 63), (205, [float("nan")] * 64), (206, [float("inf")] + [0.0] * 63), (207, [0.0] * 64), (7, rows[8][1])]
    assert rows_of(lloyd.report(frame(spark, rows), group=32)) == brute(rows)


def test_other_shapes(spark):
    """Uneven shards, many clusters (some of which run empty), one-row groups."""
    rows = made(40, 7, seed=4) + [(100 + k, [2.0] * 7) for k in range(12)]
    for shards, group in ((3, 1), (7, 16), (1, 100)):
        found = lloyd.report(frame(spark, rows), k=15, rounds=4, dims=7, shards=shards, group=group)
        assert rows_of(found) == brute(rows, k=15, rounds=4, dims=7)


def test_few_or_no_vectors(spark):
    rows = made(3, 64)
    assert rows_of(lloyd.report(frame(spark, rows))) == brute(rows)
    for none in ([(1, None)], []):
        found = lloyd.report(frame(spark, none))
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and found.count() == 0


def test_large_components_stay_in_a_long(spark):
    rows = [(k, [(-1) ** k * 3e38] * 64) for k in range(10)]
    far = {d for _, _, d, *_ in rows_of(lloyd.report(frame(spark, rows)))}
    assert far == {0}


def test_blocks_are_not_shuffled_again(spark):
    """A round brings assignments to the blocks; only they are exchanged."""
    groups = lloyd._numbered(lloyd.integer_vectors(frame(spark, made(300, 64))), 16)
    blocks, name = lloyd._bucketed(spark, lloyd._column_blocks(groups, 64, 4))
    try:
        side = spark.createDataFrame([], "grp long, shard int, clusters binary")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = blocks.join(side, ["grp", "shard"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.sql(f"DROP TABLE {name}")


def test_query_against_sql(spark):
    import duckdb
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    assert rows_of(lloyd.op13_sharded_lloyd(spark, SF001)) == sorted(db.sql(lloyd.OP13_SQL).fetchall(), key=str)
