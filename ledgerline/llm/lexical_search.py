"""Operator 11: ranked lexical search over range-maximum sparse tables.

Every document is read once and kept as its length and the counts of the
terms that some query has.  Blocks of documents then become posting lists in
document order, each with a sparse table of its range maxima.  A query is
answered best-first: an interval of documents is bounded by the sum, over the
query's terms, of the largest impact in it (one table look-up a term); the
best intervals are split at the document of their largest impact, which is
scored, and what remains left and right of it goes back with its own bounds.
A block is done when no interval's bound reaches the least of the best
scores.  The best scores of the earlier blocks of a task start the next.

The queries' terms are the only thing sent to all tasks; they go in batches of
about ``QUERY_BYTES`` of text, each a pass of its own, so that no broadcast
grows with the number of queries.

Scores are 64-bit integers: a term's weight is floor(1000 ln((2N+2)/(2df+1))),
a document's m is 75 + (25 n N) div L, and a term adds
weight * ((10^9 tf) div (1000 tf + 12 m)) each time the query names it.

Defined cases: null or termless documents are in no list and not counted in N;
null or termless queries give no rows; query rows repeated in full are one
query; documents with equal scores are ranked by ascending id, null ids last;
rows that share an id are ranked each by itself; extra columns are ignored;
empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.runtime import saved, ship_code, tidied

TOP = 20
#: Documents of a block: bounds the memory of a task, not the result.
BLOCK_DOCS = 8192
QUERY_BYTES = 4 << 20
#: Intervals split at a time, doubling up to this many.
BATCH = 512

#: Letters, digits and everything beyond ASCII make terms; A-Z lower-cased.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_BYTES).split()


# -- counting ---------------------------------------------------------------

def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: all its terms
    with repeats, and those of the vocabulary with their counts."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in tidied(batches):
            kept, n, at, which, tf = [], [], [0], [], []
            for i, data in enumerate(batch.column(1)):
                words = terms(data.as_py())
                if not words:
                    continue
                counts = Counter(words)
                found = counts.keys() & number.keys()
                kept.append(i)
                n.append(len(words))
                which.extend(number[w] for w in found)
                tf.extend(counts[w] for w in found)
                at.append(len(which))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    return own.mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


# -- one block of documents --------------------------------------------------

class Block:
    """Posting lists of a block, one after another, with one sparse table over
    all of them: a look-up never crosses the end of a list."""

    def __init__(self, n: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weight: np.ndarray, documents: int, length: int):
        m = 75 + (25 * n * documents) // length
        doc = np.repeat(np.arange(len(n)), np.diff(at))
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        # Documents that share their commonest term stand together, shorter ones first.
        common = np.full(len(n), len(weight))
        rank = np.empty(len(weight), np.int64)
        rank[np.argsort(weight, kind="stable")] = np.arange(len(weight))
        np.minimum.at(common, doc, rank[term])
        self.row = np.lexsort((m, common))
        place = np.empty(len(n), np.int64)
        place[self.row] = np.arange(len(n))
        doc = place[doc]
        self.size = len(n)
        key = term.astype(np.int64) * self.size + doc
        order = np.argsort(key, kind="stable")
        self.key, self.doc, self.impact = key[order], doc[order], impact[order]
        self.first = np.searchsorted(self.key, np.arange(len(weight) + 1) * self.size)
        longest = int(np.diff(self.first).max(initial=1))
        self.best = [np.arange(len(order), dtype=np.int32)]
        for k in range(longest.bit_length() - 1):
            low = self.best[-1][:-(1 << k)]
            high = self.best[-1][1 << k:]
            self.best.append(np.where(self.impact[high] > self.impact[low], high, low))
        width = len(order)
        self.table = np.zeros((len(self.best), width), np.int32)
        for k, level in enumerate(self.best):
            self.table[k, :len(level)] = level
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, longest.bit_length()):
            self.log[1 << k:] = k

    def maxima(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Position of the largest impact in each non-empty range of a list."""
        k = self.log[right - left]
        a, b = self.table[k, left], self.table[k, right - (1 << k)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def search(self, term: np.ndarray, repeats: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Best-first: yields (rows, scores) of scored documents and is sent the
        score that a document must reach from then on."""
        q = np.flatnonzero(self.first[term] < self.first[term + 1])
        left, right = self.first[term[q]], self.first[term[q] + 1]
        if not len(q):
            return
        top = self.maxima(left, right)
        #: ranges (of a term's list) of all waiting intervals, and where each one's begin
        bound = np.array([(self.impact[top] * repeats[q]).sum()])
        waiting = [(bound, np.array([0, len(q)]), q, left, right, top)]
        step = 16
        while True:
            bounds = [w[0] for w in waiting]
            if not bounds:
                return
            every = np.concatenate(bounds)
            chosen = every >= least
            if not chosen.any():
                return
            if chosen.sum() > step:
                cut = np.partition(every, len(every) - step)[-step]
                chosen = every >= max(cut, least)
            picked, rest, k = [], [], 0
            for part in waiting:
                mine = chosen[k:k + len(part[0])]
                k += len(mine)
                if mine.all():
                    picked.append(part)
                elif not mine.any():
                    rest.append(part)
                else:
                    picked.append(_only(part, mine))
                    rest.append(_only(part, ~mine & (part[0] >= least)))
            step = min(2 * step, BATCH)
            waiting = [r for r in rest if len(r[0])]
            bound, at, q, left, right, top = _joined(picked)
            size = np.diff(at)
            own = np.repeat(np.arange(len(bound)), size)
            value = self.impact[top] * repeats[q]
            # Split at the document of the largest impact.
            is_top = np.flatnonzero(value == np.maximum.reduceat(value, at[:-1])[own])[::-1]
            split = np.empty(len(bound), np.int64)
            split[own[is_top]] = self.doc[top[is_top]]
            here = np.searchsorted(self.key, term[q] * self.size + split[own])
            has = (here < right) & (self.doc[np.minimum(here, len(self.doc) - 1)] == split[own])
            score = np.add.reduceat(np.where(has, self.impact[np.minimum(here, len(self.doc) - 1)] * repeats[q], 0), at[:-1])
            least = max(least, (yield self.row[split], score) or 0)
            for lo, hi in ((left, here), (here + has, right)):
                some = lo < hi
                if not some.any():
                    continue
                lo, hi, mine, whose = lo[some], hi[some], q[some], own[some]
                best = self.maxima(lo, hi)
                start = np.flatnonzero(np.diff(whose, prepend=-1))
                sums = np.add.reduceat(self.impact[best] * repeats[mine], start)
                part = (sums, np.append(start, len(whose)), mine, lo, hi, best)
                good = sums >= least
                if good.all():
                    waiting.append(part)
                elif good.any():
                    waiting.append(_only(part, good))
            if len(waiting) > 24:
                waiting = [_joined(waiting)]


def _only(part: tuple, keep: np.ndarray) -> tuple:
    """The kept intervals of a set of intervals."""
    bound, at, *flat = part
    size = np.diff(at)
    return (bound[keep], np.append(0, np.cumsum(size[keep])), *(f[np.repeat(keep, size)] for f in flat))


def _joined(parts: list[tuple]) -> tuple:
    if len(parts) == 1:
        return parts[0]
    bound = np.concatenate([p[0] for p in parts])
    at = np.append(0, np.cumsum(np.concatenate([np.diff(p[1]) for p in parts])))
    return (bound, at, *(np.concatenate([p[i] for p in parts]) for i in range(2, 6)))


class Best:
    """The best documents of one query so far."""

    def __init__(self, top: int):
        self.top, self.held, self.least = top, [], 1

    def add(self, scores: list[int], ids: list) -> None:
        self.held += [(-s, i is None, i if i is not None else 0, i) for s, i in zip(scores, ids)]
        self.held.sort(key=lambda x: x[:3])
        del self.held[self.top:]
        if len(self.held) == self.top:
            self.least = -self.held[-1][0]


def search_block(block: Block, ids: pa.Array, queries: list, best: list[Best]) -> None:
    for (term, repeats), held in zip(queries, best):
        run = block.search(term, repeats, held.least)
        found = next(run, None)
        while found is not None:
            rows, scores = found
            good = scores >= held.least
            if good.any():
                held.add(scores[good].tolist(), ids.take(pa.array(rows[good])).to_pylist())
            try:
                found = run.send(held.least)
            except StopIteration:
                break


# -- the whole table ---------------------------------------------------------

def rank(docs: DataFrame, queries: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
         query_id: str = "item_id", query: str = "text", block_docs: int = BLOCK_DOCS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``top`` best documents of every query: (item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    ship_code(spark)
    asked = queries.select(F.col(query_id).alias("item_id"), F.col(query).cast("binary").alias("query")).dropDuplicates()
    asked = saved(spark, asked, "queries")
    total = asked.agg(F.sum(F.octet_length("query")).alias("b")).head()["b"] or 0
    batches = max(1, math.ceil(total / query_bytes))
    out = None
    for k in range(batches):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "query"), F.lit(batches)) == k)
        found = _rank_batch(spark, docs, own, top, doc_id, text, block_docs)
        out = found if out is None else out.unionByName(found)
    return out


def _rank_batch(spark: SparkSession, docs: DataFrame, asked: DataFrame, top: int, doc_id: str, text: str, block_docs: int) -> DataFrame:
    rows = asked.collect()  # a batch: about QUERY_BYTES
    counts = [Counter(terms(bytes(r["query"] or b""))) for r in rows]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*counts)))}
    held = saved(spark, term_counts(docs, vocabulary, doc_id, text), "term-counts")
    sums = held.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).head()
    documents, length = sums["documents"], sums["length"] or 1
    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").count()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in frequency.collect():  # one row a query term
        weight[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["count"] + 1)))
    items = [r["item_id"] for r in rows]
    asks = [(np.array([vocabulary[w] for w in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]
    shared = spark.sparkContext.broadcast((asks, weight))
    doc_type = held.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(top) for _ in queries]

        def answer(parts: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(parts).combine_chunks()
            listed = t.column("terms").combine_chunks()
            listed = listed.chunk(0) if isinstance(listed, pa.ChunkedArray) else listed
            counted = t.column("counts").combine_chunks()
            counted = counted.chunk(0) if isinstance(counted, pa.ChunkedArray) else counted
            at = np.append(0, np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False)))
            block = Block(t.column("n").to_numpy(), at, listed.flatten().to_numpy(), counted.flatten().to_numpy(), weights, documents, length)
            search_block(block, t.column("doc_id"), queries, best)

        parts: list[pa.RecordBatch] = []
        for batch in tidied(batches):
            if batch.num_rows:
                parts.append(batch)
            if sum(p.num_rows for p in parts) >= block_docs:
                answer(parts)
                parts = []
        if parts:
            answer(parts)
        which = [q for q, b in enumerate(best) for _ in b.held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int64()), pa.array([h[3] for b in best for h in b.held], id_type),
             pa.array([-h[0] for b in best for h in b.held], pa.int64())], names=["q", "doc_id", "score"])

    id_type = to_arrow_type(held.schema["doc_id"].dataType)
    found = held.filter(F.size("terms") > 0).mapInArrow(search, f"q long, doc_id {doc_type}, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(items)), f"q long, item_id {asked.schema['item_id'].dataType.simpleString()}")
    return ranked.join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return rank(docs, bench)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

#: The same scores over all documents that share a term with an item.
OP11_SQL = f"""
WITH words AS (SELECT doc_id, unnest({_SPLIT}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths),
asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_SPLIT}) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))) AS impact
  FROM tf JOIN weights USING (term) JOIN lengths USING (doc_id), whole),
scores AS (SELECT item_id, doc_id, sum(repeats * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
