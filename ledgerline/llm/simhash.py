"""Operator 8: SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: 64 bits over word shingles (XXH64, seed 42), a bit set if over
half the shingles' hashes have it.  Links: distinct fingerprints are dealt to
buckets by ``distance + 1`` disjoint bit segments (two fingerprints within
the distance agree on one of them at least), and each bucket is searched by a
Gray-order index: members sorted by Gray rank, runs of them grouped into
nodes whose shared bits are factored out as (mask, pattern), level upon
level.  A query goes down the tree with its differences so far, counting only
the bits new to each node, and leaves a whole group once they exceed the
distance, or once all its members are known to be in the query's component.
A bucket returns a spanning star of each local component, never its pairs.

A bucket over ``bucket_rows`` (a few patterns holding much of the corpus) is
dealt again by another partition of the bits, which loses no pair.

Defined cases: null or wordless text has fingerprint zero and links like any
other; fewer words than the shingle make one shingle of all; equal texts and
repeated rows share fingerprint and component; null ids are skipped when a
component's smallest id is taken (null if it has none); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.runtime import broadcast_if_small, saved, ship_code, tidied

BITS = 64
FAN = 16
BUCKET_ROWS = 1 << 16

_xx = partial(xxhash.xxh64_intdigest, seed=42)


# -- fingerprints -----------------------------------------------------------

def shingle_hashes(data: bytes, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words of lower-cased (A-Z) UTF-8 text."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if n <= width:
        return np.array([_xx(joined)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[:n - width + 1].tolist()
    return np.fromiter((_xx(joined[a:b]) for a, b in zip(starts, ends[width - 1:].tolist())), np.uint64, n - width + 1)


def simhash(data: bytes | None, width: int = 4) -> int:
    """The fingerprint as a signed 64-bit integer."""
    h = shingle_hashes(data or b"", width)
    if not len(h):
        return 0
    count = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 15):
        part = np.ascontiguousarray(h[k:k + (1 << 15)]).view(np.uint8)
        count += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", shingle: int = 4) -> DataFrame:
    """Add ``out`` (long): the fingerprint of the whole text."""
    ship_code(df.sparkSession)

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in tidied(batches):
            yield pa.array([simhash(t, shingle) for t in texts.to_pylist()], pa.int64())

    return df.withColumn(out, fp(F.col(text).cast("binary")))


# -- the index --------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the Gray sequence."""
    g = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(s)
    return g


class GrayIndex:
    """Hierarchy over distinct patterns in Gray order, for one bucket."""

    def __init__(self, patterns: np.ndarray):
        x = patterns[np.argsort(gray_rank(patterns), kind="stable")]
        self.x = x
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        low, high = x, x  # AND and OR of a node's members
        self.pattern, self.mask = [x], [np.full(len(x), every)]
        while len(low) > FAN:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.pattern.append(low)
            self.mask.append(~(low ^ high))
        #: the bits that a node shares and its parent doesn't
        self.new = [m & ~np.repeat(up, FAN)[:len(m)] for m, up in zip(self.mask, self.mask[1:])] + [self.mask[-1]]
        self.label = np.arange(len(x))
        self._sum_labels()

    def _sum_labels(self) -> None:
        """Per node: the component that all its members are in, or -1."""
        low = high = self.label
        self.of = [low]
        while len(low) > FAN:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.of.append(np.where(low == high, low, -1))

    def _search(self, q: np.ndarray, distance: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) positions within the distance, member after query,
        and not yet known to be in one component."""
        top = len(self.pattern) - 1
        width = len(self.pattern[top])
        who, node = np.repeat(q, width), np.tile(np.arange(width), len(q))
        stack = [(top, who, node, np.zeros(len(who), np.uint8))]
        while stack:
            level, who, node, acc = stack.pop()
            acc = acc + np.bitwise_count((self.x[who] ^ self.pattern[level][node]) & self.new[level][node])
            last = np.minimum((node + 1) * FAN ** level, len(self.x)) - 1
            keep = (acc <= distance) & (last > who) & (self.of[level][node] != self.label[who])
            who, node, acc = who[keep], node[keep], acc[keep]
            if not len(who):
                continue
            if level == 0:
                yield who, node
                continue
            below = len(self.pattern[level - 1])
            for k in range(0, len(who), step):
                w, c, a = (np.repeat(v[k:k + step], FAN) for v in (who, node * FAN, acc))
                c = c + np.tile(np.arange(FAN), len(c) // FAN)
                real = c < below
                stack.append((level - 1, w[real], c[real], a[real]))

    def _unite(self, a: np.ndarray, b: np.ndarray) -> bool:
        pairs = np.unique(np.stack([self.label[a], self.label[b]], 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            return False
        up: dict[int, int] = {}

        def root(i: int) -> int:
            while (j := up.get(i, i)) != i:
                up[i] = up.get(j, j)
                i = j
            return i

        for i, j in pairs.tolist():
            i, j = root(i), root(j)
            if i != j:
                up[max(i, j)] = min(i, j)
        to = np.arange(len(self.x))
        for i in up:
            to[i] = root(i)
        self.label = to[self.label]
        return True

    def components(self, distance: int) -> np.ndarray:
        """Label of each member of ``self.x``: the first member of its component."""
        k, step = 0, FAN
        while k < len(self.x):
            q = np.arange(k, min(len(self.x), k + step))
            grown = False
            for a, b in self._search(q, distance, 1 << 12):
                grown |= self._unite(a, b)
            if grown:
                self._sum_labels()
            k, step = k + step, min(2 * step, 512)
        return self.label


def local_stars(patterns: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its component) for members with links."""
    patterns = np.unique(patterns)
    if len(patterns) < 2:
        return patterns[:0], patterns[:0]
    index = GrayIndex(patterns)
    label = index.components(distance)
    order = np.argsort(index.x, kind="stable")
    low: np.ndarray = np.zeros(len(label), np.uint64)
    low[label[order[::-1]]] = index.x[order[::-1]]  # the last write is the smallest
    root = low[label]
    linked = root != index.x
    return index.x[linked], root[linked]


# -- links of a whole table --------------------------------------------------

def _partition(level: int, classes: int) -> list[int]:
    """Masks that split the 64 bits into classes, another way on each level."""
    def of(b: int) -> int:
        return (b * classes // BITS, b % classes, (b // classes) % classes)[level]
    return [sum(1 << b for b in range(BITS) if of(b) == c) for c in range(classes)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(level: int, classes: int, above: Column) -> Column:
    return F.array(*(F.xxhash64(above, F.lit(c), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")))
                     for c, m in enumerate(_partition(level, classes))))


def links(spark: SparkSession, fps: DataFrame, distance: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Distinct ``fp`` (long) -> edges (u, v) whose components are those of all
    pairs within the distance."""
    ship_code(spark)
    keyed = fps.select("fp", F.explode(_keys(0, distance + 1, F.lit(0).cast("long"))).alias("bucket"))
    for level in (1, 2):
        hot = saved(spark, keyed.groupBy("bucket").count().filter(F.col("count") > bucket_rows).select("bucket"), "hot-buckets")
        if hot.isEmpty():
            break
        marked = keyed.join(broadcast_if_small(hot.withColumn("hot", F.lit(True))), "bucket", "left")
        own = F.when(F.col("hot"), _keys(level, distance + 1, F.col("bucket"))).otherwise(F.array("bucket"))
        keyed = marked.select("fp", F.explode(own).alias("bucket"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        held_b, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
        out_u: list[np.ndarray] = []
        out_v: list[np.ndarray] = []

        def buckets(b: np.ndarray, f: np.ndarray) -> None:
            at = np.flatnonzero(np.diff(b)) + 1
            for part in np.split(f, at):
                if len(part) > 1:
                    u, v = local_stars(part.view(np.uint64), distance)
                    out_u.append(u.view(np.int64))
                    out_v.append(v.view(np.int64))

        def flush() -> pa.RecordBatch:
            u, v = (np.concatenate(o) if o else np.empty(0, np.int64) for o in (out_u, out_v))
            out_u.clear()
            out_v.clear()
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for batch in tidied(batches):
            b = np.concatenate([held_b, batch.column(0).to_numpy()])
            f = np.concatenate([held_f, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(b, b[-1])) if len(b) else 0  # the last bucket may go on
            buckets(b[:cut], f[:cut])
            held_b, held_f = b[cut:], f[cut:]
            yield flush()
        if len(held_b):
            buckets(held_b, held_f)
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (keyed.select("bucket", "fp").repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(search, "u long, v long"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                distance: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp, component_id)."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = saved(spark, fingerprints(own, "text", "fp", shingle).select("doc_id", "fp"), "fingerprints")
    uniq = saved(spark, own.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(spark, links(spark, uniq.select("fp"), distance, bucket_rows))
    # Stars list every node but the root itself.
    every = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = every.join(uniq, F.col("node") == F.col("fp")).select("fp", "root", "low")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = saved(spark, linked.join(lows, "root").select("fp", "component_id"), "components")
    of_fp = saved(spark, uniq.join(named, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id")), "components")
    return own.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_groups(docs).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
