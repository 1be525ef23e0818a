"""Operator 2: benchmark decontamination by winnowing, in SQL functions only.

A text becomes words; each run of k words is hashed, and of every w
consecutive hashes the smallest is kept as a fingerprint.  With w + k - 1 = n
any span of n words that document and item share has the same window of
hashes in both, hence the same minimum: the fingerprints' join finds every
document that can hold a window of n item words.  Hits are then extended: the
windows around each hit of those documents are compared word for word with
the items' windows, and all words inside an occurrence are marked.

An item shorter than n words is one window of its own length m; the same
scheme runs with n = m for each such length.

Both text passes are scans; what is shuffled is fingerprints, hits and the
documents with hits.  Documents are keyed by id and a hash of their text, so
repeated rows and rows that share an id get each their own result.

Defined cases: null or empty text has no words and is clean; items without
words match nothing; an item whose id is null marks words but is not counted
or listed; repeated item ids are listed once; extra columns are ignored (the
pipeline stage keeps them); empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.runtime import broadcast_if_small, saved

WINDOW = 10
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; other letters keep their case."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _config(n: int) -> tuple[int, int]:
    """(k, w): words in a hashed run, runs in a window; k + w - 1 = n."""
    k = (n + 1) // 2
    return k, n - k + 1


def _runs(hashes: str, k: int) -> str:
    """SQL: hash of each run of k words; an array of size(words) - k + 1."""
    args = ", ".join(f"get({hashes}, i + {j})" for j in range(k))
    return f"if(size({hashes}) < {k}, cast(array() as array<bigint>), transform(sequence(0, size({hashes}) - {k}), i -> xxhash64({args})))"


def _minima(runs: str, w: int) -> str:
    """SQL: the distinct minima of each w consecutive hashes."""
    return (f"if(size({runs}) < {w}, cast(array() as array<bigint>), "
            f"array_distinct(transform(sequence(1, size({runs}) - {w - 1}), i -> array_min(slice({runs}, i, {w})))))")


def _fingerprints(df: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """(keep..., n, fp) for each window length; needs a column ``words``."""
    df = df.selectExpr(*keep, "transform(words, x -> xxhash64(x)) AS h")
    df = df.selectExpr(*keep, *(f"{_runs('h', _config(n)[0])} AS r{n}" for n in lengths))
    df = df.selectExpr(*keep, *(f"{_minima(f'r{n}', _config(n)[1])} AS m{n}" for n in lengths))
    tagged = ", ".join(f"transform(m{n}, x -> struct({n} AS n, x AS fp))" for n in lengths)
    return df.selectExpr(*keep, f"explode(concat({tagged})) AS f").selectExpr(*keep, "f.n AS n", "f.fp AS fp")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n, window): each run of ``window`` item words, or the whole of
    a shorter item, as space-joined text."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    return (items.withColumn("n", F.least(F.size("words"), F.lit(window)))
            .select("item_id", "n", F.explode(F.expr("transform(sequence(1, size(words) - n + 1), i -> array_join(slice(words, i, n), ' '))")).alias("window"))
            .distinct())


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_hit, n_items, items_sha256) of the documents with hits."""
    windows = saved(spark, item_windows(benchmark, window), "item-windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``window`` values
    if not lengths:
        return spark.createDataFrame([], "doc_id long, text_key long, n_hit long, n_items long, items_sha256 string")
    grams = windows.select("n", "window").distinct().withColumn("words", F.split("window", " "))
    marks = None
    for n in lengths:  # a window's fingerprints: its only minimum
        own = _fingerprints(grams.filter(F.col("n") == n).select(F.col("n").alias("m"), "words"), ["m"], [n]).select("n", "fp")
        marks = own if marks is None else marks.union(own)
    marks = broadcast_if_small(saved(spark, marks.distinct(), "item-fingerprints"))

    keyed = _keyed(docs)
    found = _fingerprints(keyed.select("doc_id", "text_key", words(F.col("text")).alias("words")), ["doc_id", "text_key"], lengths)
    found = found.join(marks, ["n", "fp"], "left_semi")
    hits = saved(spark, found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("n", "fp")).alias("fps")), "hits")

    # Extend: the documents with hits, their words around each hit.
    same = keyed.doc_id.eqNullSafe(F.col("hit_id")) & (keyed.text_key == F.col("hit_key"))
    small = broadcast_if_small(hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "fps"))
    hit_docs = (keyed.join(small, same).select("doc_id", "text_key", words(F.col("text")).alias("words"), "fps")
                .dropDuplicates(["doc_id", "text_key"]))
    hit_docs = saved(spark, hit_docs.withColumn("h", F.expr("transform(words, x -> xxhash64(x))")), "hit-documents")
    parts = []
    for n in lengths:
        k, w = _config(n)
        runs = hit_docs.selectExpr("doc_id", "text_key", "words", f"transform(filter(fps, f -> f.n = {n}), f -> f.fp) AS own", f"{_runs('h', k)} AS r")
        at = runs.filter("size(own) > 0 AND size(r) > 0").selectExpr(
            "doc_id", "text_key", "words", "filter(sequence(1, size(r)), i -> array_contains(own, r[i - 1])) AS at")
        starts = at.selectExpr("doc_id", "text_key", "words", f"""
            array_distinct(flatten(transform(at, p -> sequence(greatest(1, p - {w - 1}), p)))) AS starts""")
        parts.append(starts.selectExpr("doc_id", "text_key", f"""
            explode(transform(filter(starts, s -> s + {n - 1} <= size(words)), s -> struct(s AS start, array_join(slice(words, s, {n}), ' ') AS window))) AS z""")
            .selectExpr("doc_id", "text_key", f"{n} AS n", "z.start", "z.window"))
    near = parts[0]
    for p in parts[1:]:
        near = near.unionByName(p)
    # Many items may share a window: first the windows themselves, one to one.
    by_window = saved(spark, windows.groupBy("n", "window").agg(F.collect_set("item_id").alias("items")), "windows")
    matched = saved(spark, near.join(broadcast_if_small(by_window.select("n", "window")), ["n", "window"], "left_semi"), "matches")
    own = ["doc_id", "text_key"]
    spans = matched.groupBy(*own).agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("s"))
    # Length of the union of sorted spans.
    n_hit = spans.select(*own, F.expr("""aggregate(s, struct(0L AS n, 0 AS upto), (a, x) -> struct(
        a.n + greatest(0, x.end - greatest(x.start, a.upto)) AS n, greatest(a.upto, x.end) AS upto)).n""").alias("n_hit"))
    listed = (matched.select(*own, "n", "window").distinct().join(broadcast_if_small(by_window), ["n", "window"])
              .select(*own, F.explode("items").alias("item_id")).distinct()
              .groupBy(*own).agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("ids")))
    id_ = [n_hit[c].eqNullSafe(listed[c]) for c in own]
    return (n_hit.join(listed, id_[0] & id_[1], "left")
            .select(n_hit.doc_id, n_hit.text_key, "n_hit", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256")))


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(spark, docs, benchmark, window)
    hit = saved(spark, found.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "n_hit", "n_items", "items_sha256"), "contaminated")
    own = _keyed(docs).select("doc_id", "text_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    same = own.doc_id.eqNullSafe(F.col("hit_id")) & (own.text_key == F.col("hit_key"))
    none = F.sha2(F.lit(""), 256)
    return (own.join(broadcast_if_small(hit), same, "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", none).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return report(spark, docs, bench)


#: The same rows by comparing every window of every document with every window
#: of the items.
OP2_SQL = r"""
WITH d0 AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i0 AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i0 WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d0, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.n, dw.p, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d0.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d0 LEFT JOIN hw ON d0.doc_id = hw.doc_id LEFT JOIN it ON d0.doc_id = it.doc_id
"""
