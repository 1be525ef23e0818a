"""Operator 3: language identification, words first, then shorter and shorter n-grams.

Fit (Spark aggregations over a bounded sample): per language the log frequency
of words seen at least ``min_count`` times, and of character 1- to 4-grams of
all sample words, padded at both ends.  The sample is the distinct training
texts of each language whose hash is in the lowest share that holds
``per_lang`` of its distinct texts: a documented bound, so the model's size
does not grow with the corpus, and copies don't thin a language out.
Frequencies are mixed with an even share, so a language of few texts neither
gains nor loses by its size.

Score: a known word adds its log frequency under each language; an unknown one
adds, from each of its positions, the longest known n-gram that starts there,
4 characters falling back to 3, 2 and 1, averaged over the positions.  Each
distinct word of a document is looked up once.  The best language is the
largest sum (the first in alphabetical order of those that tie); its score is
its share in the softmax of the mean per word times at most ``evidence`` words.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
so is every text if there is nothing to learn from; null languages are not
learned; repeated rows are scored alike; extra columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.runtime import broadcast_if_small, doc_crc, saved, ship_code, tidied

UNDETERMINED = "und"
PER_LANG = 1500
LONGEST = 4
EVIDENCE = 20
#: Weight of the even share in a word's or n-gram's frequency.
EVEN = 0.05
REMEMBERED = 1 << 18

_letters = regex.compile(r"\p{L}+").findall


@dataclass
class Model:
    """Languages, and rows of log frequencies for words and for n-grams."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    floor: np.ndarray

    def start(self) -> None:
        """Room for the words met while scoring, for the time of a task."""
        self.rows = np.concatenate([self.word_logs, np.zeros((REMEMBERED, len(self.langs)))])
        self.met: dict[str, int] = {}

    def stop(self) -> None:
        del self.rows, self.met

    def backed_off(self, word: str) -> np.ndarray:
        """Mean over the positions of the longest known n-gram from there."""
        padded = f"^{word}$"
        found = []
        for i in range(len(padded)):
            for n in range(min(LONGEST, len(padded) - i), 0, -1):
                k = self.grams.get(padded[i:i + n])
                if k is not None:
                    found.append(k)
                    break
        missed = len(padded) - len(found)
        return (self.gram_logs[found].sum(0) + missed * self.floor) / len(padded)

    def row(self, word: str) -> int:
        k = self.words.get(word)
        if k is None:
            k = self.met.get(word)
            if k is None:
                if len(self.met) >= REMEMBERED:
                    self.met.clear()
                k = len(self.words) + len(self.met)
                self.rows[k] = self.backed_off(word)
                self.met[word] = k
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _letters(text.lower()) if text else ()
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.langs))
        counts = Counter(words)
        items = list(counts.items())
        for k in range(0, len(items), REMEMBERED // 2):  # the memory may be cleared between parts
            part = items[k:k + REMEMBERED // 2]
            if len(self.met) + len(part) > REMEMBERED:
                self.met.clear()
            total += np.array([c for _, c in part], float) @ self.rows[[self.row(w) for w, _ in part]]
        mean = total / len(words)
        best = int(mean.argmax())
        share = np.exp((mean - mean[best]) * min(len(words), EVIDENCE))
        return self.langs[best], float(1 / share.sum())


def fit(spark: SparkSession, train: DataFrame, per_lang: int = PER_LANG, min_count: int = 2) -> Model:
    """``train`` (text, lang) -> the model."""
    own = train.select("text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    # Distinct texts are counted: copies neither fill the sample nor thin a language out.
    share = F.least(F.lit(1.0), F.lit(float(per_lang)) / F.count_distinct("h"))
    upto = own.groupBy("lang").agg(share.alias("share")).withColumn("upto", (F.lit(-2.0 ** 63) + F.col("share") * F.lit(2.0 ** 64)).try_cast("long"))
    upto = saved(spark, upto.select("lang", F.coalesce("upto", F.lit(2 ** 63 - 1)).alias("upto")), "sample-bounds")
    sample = own.join(broadcast_if_small(upto), "lang").filter("h <= upto").dropDuplicates(["lang", "h"])
    words = sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter("word <> ''")
    counts = saved(spark, words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    padded = counts.withColumn("p", F.concat(F.lit("^"), "word", F.lit("$")))
    spread = F.expr(f"flatten(transform(sequence(1, {LONGEST}), n -> if(length(p) < n, cast(array() as array<string>), "
                    "transform(sequence(1, length(p) - n + 1), i -> substring(p, i, n)))))")
    grams = padded.select("lang", "n", F.explode(spread).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    word_rows = counts.filter(F.col("n") >= min_count).collect()  # both bounded by the sample
    gram_rows = grams.filter(F.col("n") >= min_count).collect()
    langs = sorted({r["lang"] for r in upto.collect()})
    at = {x: i for i, x in enumerate(langs)}

    def table(rows: list, key: str, group) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        names = sorted({r[key] for r in rows})
        where = {x: i for i, x in enumerate(names)}
        c = np.zeros((len(names), len(langs)))
        for r in rows:
            c[where[r[key]], at[r["lang"]]] += r["n"]
        of = np.array([group(x) for x in names], int) if names else np.zeros(0, int)
        logs, floor = np.zeros_like(c), np.full(len(langs), math.log(1e-7))
        for g in set(of.tolist()):
            own_rows = of == g
            # Mixed with an even share that is the same in every language: what a
            # language lacks can't count for it because its sample is small.
            seen = c[own_rows] / np.maximum(c[own_rows].sum(0), 1)
            logs[own_rows] = np.log((1 - EVEN) * seen + EVEN / own_rows.sum())
        return where, logs, floor

    word_at, word_logs, _ = table(word_rows, "word", lambda x: 0)
    gram_at, gram_logs, floor = table(gram_rows, "gram", len)
    return Model(langs, word_at, word_logs, gram_at, gram_logs, floor)


def identify(df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add ``pred`` and ``score`` of the whole text."""
    spark = df.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = handle.value
        own.start()
        for texts in tidied(batches):
            found = [own.predict(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                                             ["lang_pred", "score"])
        own.stop()

    kept = [F.col(f"`{c}`") for c in df.columns if c not in (pred, score)]
    found = df.select(*kept, predict(F.col(text)).alias("_found"))
    return found.select(*kept, F.col("_found.lang_pred").alias(pred), F.col("_found.score").alias(score))


def held_out():
    return doc_crc() % 3 == 1


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(spark, docs.filter(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
