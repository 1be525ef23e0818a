"""Operator 5: toxicity from the nearest labelled examples by exact TF-IDF cosine.

Fit: of the labelled training texts the ``PER_CLASS`` of either class with the
smallest hash are the examples, each distinct text once and near copies (most
of their sketch's minima equal) once; texts of more than ``EXAMPLE_CHARS``
characters are none, so what is collected is bounded.  A word weighs
(1 + log tf) idf (1 + r^2): idf over all documents, and r the log of how much
likelier one class's examples hold it, drawn towards 0 by ``PRIOR`` examples.
Words that no example has weigh their TF-IDF (r is 0) and count in the norms.

Search: the examples lie in an inverted index.  Short lists are added up in
full; words that many examples have are cut into blocks with their largest
weight in each.  A query adds these up to a bound per block, scores the blocks
in falling order of their bounds, some at a time, and drops all whose bound is
below its k-th best cosine, so the k nearest are exact.  All documents are
searched this way.

Score: the neighbours vote for their labels, weighted by the inverse of their
distance; a logistic curve of the vote, fitted to the examples' own
leave-one-out votes and weighted to the classes' shares in all training rows,
makes it a probability.  A text that shares no word with any example has no
neighbour; it scores the toxic share among such examples.  The neighbours and
their cosines are returned as evidence.

Defined cases: null text is empty; repeated rows are scored alike; rows with a
null label or id teach nothing; a text with both labels is an example of
either; neighbours that tie are taken in the order of their text's hash; a word
that all documents have weighs nothing; without labelled rows of both classes
every score is the share of toxic training rows (0 without any); extra columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.runtime import broadcast_if_small, doc_crc, saved, ship_code, tidied

PER_CLASS = 1500
EXAMPLE_CHARS = 100_000
PRIOR = 5
NEIGHBOURS = 15
BLOCK = 64
#: A word that more than 1 / OFTEN of the examples have is kept in blocks.
OFTEN = 16
#: Blocks that are scored at once.
AT_ONCE = 6
#: A word that one in this many texts has is common.
COMMON = 50
#: Minima of an example's sketch, and how many near copies share.
MINIMA, SHARED = 16, 13

#: Runs of letters and digits.
_words = re.compile(r"[^\W_]+").findall


class BlockMaxIndex:
    """Exact top-k dot products with vectors given as (terms, weights)."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK):
        self.size, self.block = len(vectors), block
        self.blocks = -(-self.size // block)
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]).astype(np.int64)
        weights = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        ids = np.repeat(np.arange(self.size, dtype=np.int32), [len(t) for t, _ in vectors])
        order = np.argsort(terms, kind="stable")
        width = int(terms.max()) + 1 if len(terms) else 0
        self.first = np.searchsorted(terms[order], np.arange(width + 1))
        self.ids, self.weights = ids[order], weights[order]
        often = np.flatnonzero(np.diff(self.first) * OFTEN > self.size)
        self.row = np.full(width, -1)
        self.row[often] = np.arange(len(often))
        #: the long lists, block by block, and their largest weight in each block
        self.often = np.zeros((self.blocks, len(often), block))
        for r, t in enumerate(often.tolist()):
            own = slice(self.first[t], self.first[t + 1])
            self.often[self.ids[own] // block, r, self.ids[own] % block] = self.weights[own]
        self.most = np.ascontiguousarray(self.often.max(2).T) if self.blocks else np.zeros((len(often), 0))

    def short_lists(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(products over the short lists, rows and weights of the long ones)."""
        inside = terms < len(self.row)
        t, w = terms[inside], weights[inside]
        rows = self.row[t]
        few, many = rows < 0, rows >= 0
        at = self.first[t[few]]
        n = self.first[t[few] + 1] - at
        where = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.ids[where], self.weights[where] * np.repeat(w[few], n), self.blocks * self.block), rows[many], w[many]

    def search(self, terms, weights, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The k largest (product, example), ties by example; zeros are none."""
        if not self.size:
            return []
        score, rows, w = self.short_lists(np.asarray(terms, np.int64), np.asarray(weights, float))
        score = score.reshape(self.blocks, self.block)
        bound = score.max(1) + w @ self.most[rows]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, who = np.empty(0), np.empty(0, np.int64)
        least, at = 0.0, 0
        while at < len(order):
            part = order[at:at + AT_ONCE]
            part = part[bound[part] >= least * (1 - 1e-9)]
            if not len(part):
                break  # so are all bounds that follow
            own = score[part] + np.einsum("t,btj->bj", w, self.often[part[:, None], rows])
            ids = (part[:, None] * self.block + np.arange(self.block)).ravel()
            own = own.ravel()
            good = (own > 0) & (own >= least) & (ids != skip)
            best, who = np.concatenate([best, own[good]]), np.concatenate([who, ids[good]])
            if len(best) > k:
                keep = np.lexsort((who, -best))[:k]
                best, who = best[keep], who[keep]
            if len(best) == k:
                least = float(best.min())
            at += AT_ONCE
        order = np.lexsort((who, -best))
        return list(zip(best[order].tolist(), who[order].tolist()))


@dataclass
class Model:
    words: dict[str, int]  # the words of the examples
    scale: np.ndarray  # idf (1 + r^2) of each
    index: BlockMaxIndex
    labels: np.ndarray
    ids: list[int]
    curve: np.ndarray
    empty: float

    def weighed(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(counts)) * self.scale[terms]
        return terms[w > 0], w[w > 0]

    def vote(self, cosines: list[float], near: list[int]) -> float:
        """Log odds of label 1 among the neighbours, the nearer the more."""
        w = 1 / (1 - np.minimum(np.array(cosines), 1.0) + 0.05)
        share = ((w * self.labels[near]).sum() + 0.1) / (w.sum() + 0.2)
        return math.log(share / (1 - share))

    def score(self, cosines: list[float], near: list[int]) -> float:
        if not near:
            return self.empty
        z = self.curve[0] + self.curve[1] * self.vote(cosines, near)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (y - p)) - 1e-2 * b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def relevance(toxic: np.ndarray, clean: np.ndarray, size: dict[int, int], prior: float = PRIOR) -> np.ndarray:
    """Size of the log odds that a word, held by so many examples of either
    class, gives for one of them; 0 for a word that no example has."""
    n = size[0] + size[1]
    a, b = toxic + prior * size[1] / n, clean + prior * size[0] / n
    return np.abs(np.log(a / b * size[0] / size[1]))


def _distinct_texts(sketches: np.ndarray) -> list[int]:
    """Rows that share fewer than ``SHARED`` minima with every row kept before."""
    kept: list[int] = []
    held = np.zeros((0, sketches.shape[1]), np.int64)
    for i, x in enumerate(sketches):
        if not len(held) or (held == x).sum(1).max() < SHARED:
            kept.append(i)
            held = sketches[kept]
    return kept


def examples(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """((doc_id, toxic, h) of the examples, training rows per class).

    Texts are drawn by the smallest hashes of distinct texts, so that copies
    neither take a place nor thin a class out; while near copies leave fewer
    than ``per_class``, twice as many are drawn, up to all."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.xxhash64(text).alias("h"), F.length(text).alias("n"))
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(doc_crc() % 5 != 0).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    train = saved(spark, own.join(marked.distinct(), "doc_id").distinct(), "labelled")
    shares = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}  # two labels
    texts = saved(spark, train.filter(F.col("n") <= EXAMPLE_CHARS).groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id")), "labelled-texts")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    kept: list[tuple] = []
    for c, n in sorted(sizes.items()):
        spare = 1.5
        while True:
            upto = int(min(2 ** 63 - 1, -2 ** 63 + min(1.0, spare * per_class / n) * 2 ** 64))
            drawn = saved(spark, texts.filter((F.col("toxic") == c) & (F.col("h") <= F.lit(upto))).select("h", "doc_id"), "drawn")
            rows = sorted((r for r in _sketched(docs, drawn).collect()), key=lambda r: (r["h"], r["doc_id"]))  # about spare x per_class
            mine = _distinct_texts(np.array([r["sketch"] for r in rows], np.int64).reshape(-1, MINIMA))
            if len(mine) >= per_class or spare * per_class >= n:
                break
            spare *= 2
        kept += [(rows[i]["doc_id"], c, rows[i]["h"]) for i in mine[:per_class]]
    return spark.createDataFrame(kept, "doc_id long, toxic int, h long"), shares


def _sketched(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """(h, doc_id, sketch): minima of the drawn texts' runs of three words."""
    ship_code(docs.sparkSession)

    @F.arrow_udf("array<long>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash
        salts = np.random.default_rng(7).integers(1, 2 ** 62, MINIMA).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for texts in tidied(batches):
            out = []
            for t in texts.to_pylist():
                own = _words(t.lower())
                runs = {" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))}
                h = np.array([xxhash.xxh64_intdigest(x) for x in runs], np.uint64)
                mixed = h[:, None] * salts
                out.append((mixed ^ (mixed >> np.uint64(29))).min(0).view(np.int64).tolist())
            yield pa.array(out, pa.list_(pa.int64()))

    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    return own.join(broadcast_if_small(drawn), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("h", "doc_id", sketch("text").alias("sketch"))


def _counted(text: str | None) -> Counter:
    return Counter(_words(text.lower())) if text else Counter()


def bags(docs: DataFrame, words: dict[str, int], keep: list[str]) -> DataFrame:
    """(keep..., row, ids, counts, rest, rest_counts, common): the words of each
    whole text, those of the examples by number, the others by hash.  Every text
    is read here once.  ``common``, on a batch's first row, are the other words
    that one in ``COMMON`` of the batch's texts has: a word that one in
    ``COMMON`` of all texts has is among them in one batch at least."""
    spark = docs.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(words)

    @F.arrow_udf("ids array<int>, counts array<int>, rest array<string>, rest_counts array<int>, common array<string>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = handle.value.get
        for texts in tidied(batches):
            parts: list[list] = [[], [], [], []]
            at: list[list[int]] = [[0], [0]]
            for t in texts.to_pylist():
                for w, n in _counted(t).items():
                    i = number(w)
                    parts[0 if i is not None else 2].append(i if i is not None else w)
                    parts[1 if i is not None else 3].append(n)
                at[0].append(len(parts[0]))
                at[1].append(len(parts[2]))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32())
            lists = [pa.ListArray.from_arrays(pa.array(at[j // 2], pa.int32()), pa.array(parts[j], kinds[j])) for j in range(4)]
            n = len(texts)
            often = [w for w, c in Counter(parts[2]).items() if c * COMMON >= n]
            common = pa.array([often] + [[]] * (n - 1) if n else [], pa.list_(pa.string()))
            yield pa.StructArray.from_arrays([*lists, common], ["ids", "counts", "rest", "rest_counts", "common"])

    out = docs.select(*keep, count(F.col("text")).alias("b")).select(*keep, F.monotonically_increasing_id().alias("row"), "b.*")
    return out.withColumns({c: F.transform(c, lambda w: F.xxhash64(w)) for c in ("rest", "common")})


def _rest_norms(counted: DataFrame, documents: int) -> DataFrame:
    """(row, rest_norm): squares of the weights of the words that no example has."""
    spark = counted.sparkSession
    rest = counted.select("row", F.explode(F.arrays_zip("rest", "rest_counts")).alias("w")).select("row", F.col("w.rest").alias("word"), F.col("w.rest_counts").alias("tf"))
    # Common words (COMMON times the words of a text at most) are counted map-side and
    # sent to their rows; of the others no word has more than a COMMON-th of the rows.
    maybe = broadcast_if_small(saved(spark, counted.select(F.explode("common").alias("word")).distinct(), "maybe-common"))
    often = rest.join(maybe, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") * COMMON >= documents)
    often = broadcast_if_small(saved(spark, often, "common"))
    each = rest.join(often.select("word"), "word", "left_anti").withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("word")))
    every = each.select("row", "tf", "df").unionByName(rest.join(often, "word").select("row", "tf", "df"))
    squares = every.select("row", F.pow((1 + F.log("tf")) * F.log(F.lit(1.0 + documents) / (1 + F.col("df"))), 2).alias("x"))
    # Whole numbers, so that the order of the sum does not show.
    return squares.groupBy("row").agg(F.sum((F.col("x") * 1e9).cast("long")).alias("rest_norm"))


def search(counted: DataFrame, model: Model, documents: int, keep: list[str]) -> DataFrame:
    """(keep..., cosines, near): the nearest examples of each text."""
    spark = counted.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(model)

    @F.arrow_udf("products array<double>, near array<int>, known double")
    def nearest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = handle.value
        for ids, counts in tidied(batches):
            terms, tf = ids.flatten().to_numpy(), counts.flatten().to_numpy()
            at = np.append(0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))
            out = []
            for a, b in zip(at.tolist(), at[1:].tolist()):
                t, w = own.weighed(terms[a:b], tf[a:b])
                found = own.index.search(t, w, NEIGHBOURS)
                out.append(([s for s, _ in found], [i for _, i in found], float((w * w).sum())))
            kinds = [pa.list_(pa.float64()), pa.list_(pa.int32()), pa.float64()]
            yield pa.StructArray.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)], ["products", "near", "known"])

    found = saved(spark, counted.select(*keep, "row", nearest("ids", "counts").alias("s")).select(*keep, "row", "s.*"), "nearest")
    norms = broadcast_if_small(saved(spark, _rest_norms(counted, documents), "norms"))
    size = F.sqrt(F.col("known") + F.coalesce(F.col("rest_norm") / 1e9, F.lit(0.0)))
    return (found.join(norms, "row", "left").withColumn("length", size)
            .select(*keep, F.transform("products", lambda x: x / F.col("length")).alias("cosines"), "near"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Model, DataFrame]:
    """(model, nearest examples of all documents)."""
    spark = docs.sparkSession
    ship_code(spark)
    chosen, shares = examples(docs, labels, per_class)
    hashed = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    # 2 x per_class rows at most, of EXAMPLE_CHARS at most.
    drawn = hashed.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h", "toxic"]) if len(shares) > 1 else hashed.limit(0).withColumn("toxic", F.lit(0))
    rows = [(r["doc_id"], r["toxic"], _counted(r["text"])) for r in drawn.select("doc_id", "toxic", "h", "text").orderBy("h", "doc_id", "toxic").toLocalIterator()]
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, _, bag in rows for w in bag}))}
    counted = saved(spark, bags(docs, vocabulary, ["doc_id"]), "bags")
    documents = counted.count()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("ids").alias("i")).groupBy("i").count().collect():  # a row a word of the examples
        df[r["i"]] = r["count"]
    labels_of = np.array([t for _, t, _ in rows], int)
    held = np.zeros((2, len(vocabulary)))
    plain = []
    for _, t, bag in rows:
        terms = np.array([vocabulary[w] for w in bag], np.int64)
        held[t, terms] += 1
        plain.append((terms, np.array(list(bag.values()), float)))
    size = {c: int((labels_of == c).sum()) for c in (0, 1)}
    scale = np.log((1 + documents) / (1 + df))
    if size[0] and size[1]:
        scale = scale * (1 + relevance(held[1], held[0], size) ** 2)
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    model = Model(vocabulary, scale, BlockMaxIndex([]), labels_of, [i for i, _, _ in rows], np.zeros(2), share)
    vectors = []
    for terms, counts in plain:
        t, w = model.weighed(terms, counts)
        vectors.append((t, w / math.sqrt((w * w).sum()) if len(w) else w))
    model.index = BlockMaxIndex(vectors)
    weight = {c: shares[c] / max(1, size[c]) for c in shares}
    x, y, w, none = [], [], [], {0: 0.0, 1: 0.0}
    for i, (t, v) in enumerate(vectors):
        found, c = model.index.search(t, v, NEIGHBOURS, skip=i), int(labels_of[i])
        if found:
            x.append([1.0, model.vote([s for s, _ in found], [j for _, j in found])])
            y.append(c)
            w.append(weight[c])
        else:
            none[c] += weight[c]
    if x:
        model.curve = _logistic(np.array(x), np.array(y, float), np.array(w))
    if sum(none.values()):
        model.empty = none[1] / sum(none.values())
    return model, search(counted, model, documents, ["doc_id"])


def held_out() -> Column:
    return doc_crc() % 5 == 0


def score(found: DataFrame, model: Model) -> DataFrame:
    """Add score and evidence (ids of the nearest examples) to searched rows."""
    spark = found.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(model)

    @F.arrow_udf("score double, evidence array<long>")
    def scored(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        own = handle.value
        for cosines, near in tidied(batches):
            rows = list(zip(cosines.to_pylist(), near.to_pylist()))
            yield pa.StructArray.from_arrays([pa.array([own.score(*r) for r in rows], pa.float64()),
                                              pa.array([[own.ids[i] for i in n] for _, n in rows], pa.list_(pa.int64()))], ["score", "evidence"])

    rest = [c for c in found.columns if c != "near"]
    return found.select(*rest, scored("cosines", "near").alias("s")).select(*rest, "s.score", "s.evidence")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model, found = fit(docs, labels)
    return score(found, model).select("doc_id", held_out().alias("held_out"), "score",
                                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "cosines")
