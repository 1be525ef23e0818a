"""Operator 13: centroid clustering by dimension-sharded Lloyd rounds.

Vectors become integers, floor(1024 x), packed as blocks: ``GROUP`` rows of one
shard's columns each.  A round is one job over the blocks:

1. column-block tasks compute the exact partial distance of each of their rows
   to each centroid's slice (they know no other columns);
2. the parts of a row group are added by key and the nearest centroid is taken;
3. the assignment goes back to the group's block in every shard, each shard
   sums its own columns by cluster, and updates its own slice of the centroids.

The blocks are written once, bucketed by (group, shard), so that assignments
come to them and no round shuffles the vectors again.  All arithmetic is on
64-bit integers; what reaches the driver is the centroids (k times the
dimensions), the cluster sizes and the start vectors.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components are left out; components are held within ``LIMIT`` in
size, so that every squared distance is a long; rows are vectors of their own
even if ids or vectors repeat; a null id is never a start; start vectors of
equal hash (repeated ids) are taken in the order of their packed bytes; fewer
vectors than clusters make as many clusters as vectors with an id, none if
there are none; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.runtime import saved, shared_folder, ship_code, tidied

DIMENSIONS = 64
SHARDS = 4
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Rows of a block.
GROUP = 2048
#: 64 squared differences of twice this size stay below 2^63.
LIMIT = (1 << 27) - 1

_BLOCK = "grp long, shard int, rows int, data binary"


def _slices(dims: int, shards: int) -> list[tuple[int, int]]:
    cut = [dims * s // shards for s in range(shards + 1)]
    return list(zip(cut, cut[1:]))


# -- vectors as integers -----------------------------------------------------

def integer_vectors(df: DataFrame, dims: int = DIMENSIONS, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x binary): the kept vectors' integers, little-endian 64-bit."""
    ship_code(df.sparkSession)
    own = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(F.size("v") == dims)
    kind = own.schema["vec_id"].dataType.simpleString()

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            at = batch.column(1)
            x = at.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)  # null components become NaN
            good = np.isfinite(x).all(1)
            x = np.clip(np.floor(x[good] * scale), -LIMIT, LIMIT).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.array([v.tobytes() for v in x], pa.binary())], names=["vec_id", "x"])

    return own.mapInArrow(scaled, f"vec_id {kind}, x binary")


def _starts(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The k vectors of smallest hash of seed and id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter("vec_id is not null").select(name.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([np.frombuffer(r["x"], "<i8") for r in rows], np.int64).reshape(-1, dims)


# -- blocks ------------------------------------------------------------------

def _numbered(vectors: DataFrame, group: int) -> DataFrame:
    """Vectors in groups of up to ``group`` rows: (grp, ids, x of all rows)."""
    id_type = to_arrow_type(vectors.schema["vec_id"].dataType)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def packed(t: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([t["vec_id"].to_pylist()], pa.list_(id_type)),
                 pa.array([b"".join(t["x"].to_pylist())], pa.binary())], names=["grp", "ids", "x"])

        for batch in tidied(batches):
            held.append(batch)
            while sum(b.num_rows for b in held) >= group:
                t = pa.Table.from_batches(held)
                yield packed(t.slice(0, group))
                number += 1
                held = t.slice(group).to_batches()
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held))

    return vectors.mapInArrow(pack, f"grp long, ids array<{kind}>, x binary")


def _column_blocks(groups: DataFrame, dims: int, shards: int) -> DataFrame:
    cuts = _slices(dims, shards)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(data, "<i8").reshape(-1, dims)
                parts = [x[:, a:b].astype("<i4").tobytes() for a, b in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * shards, pa.int64()), pa.array(range(shards), pa.int32()),
                     pa.array([len(x)] * shards, pa.int32()), pa.array(parts, pa.binary())], names=["grp", "shard", "rows", "data"])

    return groups.select("grp", "x").mapInArrow(split, _BLOCK)


def _bucketed(spark: SparkSession, blocks: DataFrame) -> tuple[DataFrame, str]:
    """The blocks as an external table, bucketed by (grp, shard)."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lloyd_blocks_{uuid.uuid4().hex[:12]}"
    (blocks.repartition(n, "grp", "shard").write.bucketBy(n, "grp", "shard").option("path", shared_folder(spark, "blocks"))
     .format("parquet").saveAsTable(name))
    return spark.table(name), name


# -- a round -----------------------------------------------------------------

def _block(rows: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(rows, -1).astype(np.int64)


def _assigned(blocks: DataFrame, centroids: np.ndarray, shards: int) -> DataFrame:
    """(grp, clusters binary, distances binary): the nearest centroid of each row."""
    k, dims = centroids.shape
    cuts = _slices(dims, shards)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            out = []
            for shard, rows, data in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                a, b = cuts[shard]
                x = _block(rows, data)
                far = np.empty((rows, k), "<i8")
                for c in range(k):
                    gap = x - centroids[c, a:b]
                    far[:, c] = np.einsum("ij,ij->i", gap, gap)
                out.append(far.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["grp", "far"])

    def nearest(parts: pa.Table) -> pa.Table:
        far = np.zeros((0, k), np.int64)
        for i, data in enumerate(parts["far"].to_pylist()):
            part = np.frombuffer(data, "<i8").reshape(-1, k)
            far = part if i == 0 else far + part
        best = far.argmin(1)
        return pa.table({"grp": parts["grp"][:1], "clusters": pa.array([best.astype("<i4").tobytes()], pa.binary()),
                         "distances": pa.array([far[np.arange(len(far)), best].astype("<i8").tobytes()], pa.binary())})

    parts = blocks.select("grp", "shard", "rows", "data").mapInArrow(partial, "grp long, far binary")
    return parts.groupBy("grp").applyInArrow(nearest, "grp long, clusters binary, distances binary")


def _updated(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray, shards: int) -> np.ndarray:
    """The next centroids: each shard sums and divides its own columns."""
    k, dims = centroids.shape
    cuts = _slices(dims, shards)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in tidied(batches):
            for shard, rows, data, clusters in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, own = _block(rows, data), np.frombuffer(clusters, "<i4")
                held = total.setdefault(shard, np.zeros((k, x.shape[1] + 1), np.int64))
                for c in range(k):
                    mine = x[own == c]
                    held[c, 0] += len(mine)
                    held[c, 1:] += mine.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.astype("<i8").tobytes() for t in total.values()], pa.binary())], names=["shard", "sums"])

    def update(parts: pa.Table) -> pa.Table:
        shard = parts["shard"][0].as_py()
        a, b = cuts[shard]
        total = sum(np.frombuffer(p, "<i8").reshape(k, -1) for p in parts["sums"].to_pylist())
        count = total[:, :1]
        new = np.where(count > 0, total[:, 1:] // np.maximum(count, 1), centroids[:, a:b])
        return pa.table({"shard": parts["shard"][:1], "slice": pa.array([new.astype("<i8").tobytes()], pa.binary())})

    to_shards = assigned.select("grp", "clusters", F.explode(F.array(*(F.lit(s) for s in range(shards)))).alias("shard"))
    held = blocks.join(to_shards, ["grp", "shard"]).select("shard", "rows", "data", "clusters")
    done = held.mapInArrow(sums, "shard int, sums binary").groupBy("shard").applyInArrow(update, "shard int, slice binary").collect()
    new = centroids.copy()
    for r in done:  # k x the shard's dimensions
        a, b = cuts[r["shard"]]
        new[:, a:b] = np.frombuffer(r["slice"], "<i8").reshape(k, -1)
    return new


def cluster(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMENSIONS, scale: int = SCALE,
            shards: int = SHARDS, group: int = GROUP, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector (vec_id, cluster, distance), and the centroids."""
    spark = df.sparkSession
    vectors = saved(spark, integer_vectors(df, dims, scale, vec_id, vector), "integers")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = _starts(vectors, k, seed, dims)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), centroids
    groups = saved(spark, _numbered(vectors, group), "groups")
    blocks, name = _bucketed(spark, _column_blocks(groups, dims, shards))
    for _ in range(rounds):
        new = _updated(blocks, _assigned(blocks, centroids, shards), centroids, shards)
        if (new == centroids).all():
            break  # all further rounds would repeat this one
        centroids = new
    last = saved(spark, _assigned(blocks, centroids, shards), "assigned")
    spark.sql(f"DROP TABLE {name}")
    id_type = to_arrow_type(vectors.schema["vec_id"].dataType)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            for ids, clusters, far in zip(*(batch.column(i) for i in range(3))):
                yield pa.RecordBatch.from_arrays(
                    [ids.values.cast(id_type), pa.array(np.frombuffer(clusters.as_py(), "<i4")), pa.array(np.frombuffer(far.as_py(), "<i8"))],
                    names=["vec_id", "cluster", "distance"])

    found = groups.select("grp", "ids").join(last, "grp").select("ids", "clusters", "distances")
    return found.mapInArrow(unpack, f"vec_id {kind}, cluster int, distance long"), centroids


def report(df: DataFrame, **options) -> DataFrame:
    """The vectors with their cluster's and the whole inertia and centroid digest."""
    spark = df.sparkSession
    found, centroids = cluster(df, **options)
    found = saved(spark, found, "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest()) for c, v in enumerate(centroids)]
    few = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return found.join(F.broadcast(few), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def _sql() -> str:
    """The same rounds, one after another, over (vector, component) rows."""
    steps = [f"""
vectors AS MATERIALIZED (SELECT vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (SELECT vec_id, p, floor({SCALE} * (e[p]::DOUBLE))::BIGINT AS x FROM vectors, range(1, {DIMENSIONS + 1}) r(p)),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM vectors QUALIFY cluster < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT cluster, p, x FROM starts JOIN cells USING (vec_id))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, cluster, d FROM (
  SELECT vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM cells v JOIN c{r} c USING (p) GROUP BY vec_id, c.cluster)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT cluster, p, sum(x) AS s, count(*) AS n FROM a{r} JOIN cells USING (vec_id) GROUP BY cluster, p),
c{r + 1} AS MATERIALIZED (SELECT o.cluster, o.p,
  CASE WHEN n IS NULL THEN o.x ELSE ((s - (((s % n) + n) % n)) // n)::BIGINT END AS x FROM c{r} o LEFT JOIN m{r} m ON o.cluster = m.cluster AND o.p = m.p)""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, a.cluster::INTEGER AS cluster, d::BIGINT AS distance,
  (sum(d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{ROUNDS} a JOIN (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS h FROM c{ROUNDS} GROUP BY cluster) USING (cluster)
"""


OP13_SQL = _sql()
