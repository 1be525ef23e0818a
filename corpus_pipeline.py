"""Training-data pipeline over ``documents``: each stage calls one operator.

Every stage reads what its predecessor kept and returns the columns of
``documents`` (the last returns tokens), all others passed through untouched,
whatever their names: the stages' own columns take names that no column has.

Defined cases: nulls in any column are kept unless a stage's rule says
otherwise; null and empty texts are undetermined and go with the language
stage; very long texts are read whole; rows that share an id are told apart by
their text's hash, and of rows equal in both one stays after the near-duplicate
stage; of documents that tie as a group's smallest id, the one whose text has
the smaller hash stays; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, language_id, pii, simhash
from ledgerline.llm.runtime import broadcast_if_small, saved


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Each name, lengthened until no column has it (in any case)."""
    taken = {c.lower() for c in docs.columns}
    return [next(x for x in (n + "_" * k for k in range(len(taken) + 1)) if x.lower() not in taken) for n in names]


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; ``und`` ones go."""
    model = language_id.fit(spark, docs.filter(~language_id.held_out()))
    pred, score = free_names(docs, "_lang_pred", "_lang_score")
    known = language_id.identify(docs, model, pred=pred, score=score)
    return known.filter(F.col(pred) != language_id.UNDETERMINED).select(_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id (rows without an id last),
    of rows that share it the one whose text has the smallest hash."""
    same_text = F.xxhash64(F.coalesce("text", F.lit("")))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", same_text.alias("text_key"))
    groups = simhash.near_groups(docs.select(key.alias("doc_id"), "text"))
    own_id, own_key, copies = free_names(docs, "_id", "_key", "_n")
    text_key, = free_names(docs, "_text_key")
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias(copies))
    kept = saved(spark, kept.select(F.col("doc_id.doc_id").alias(own_id), F.col("doc_id.text_key").alias(own_key), copies), "kept")
    here = docs.withColumn(text_key, same_text)

    def rows(which: Column) -> DataFrame:
        own = broadcast_if_small(kept.filter(which).select(own_id, own_key))
        return here.join(own, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(text_key) == F.col(own_key)), "left_semi")

    # Only rows repeated in full need to be brought together.
    repeated = rows(F.col(copies) > 1).dropDuplicates(["doc_id", text_key])
    return rows(F.col(copies) == 1).unionByName(repeated).select(_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(spark, docs.select("doc_id", "text"), bench)
    own_id, own_key, text_key = free_names(docs, "_id", "_key", "_text_key")
    found = saved(spark, found.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)), "contaminated")
    here = docs.withColumn(text_key, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(text_key) == F.col(own_key))
    return here.join(broadcast_if_small(found), same, "left_anti").select(_columns(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind's name."""
    clean = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return clean.select(_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, checked by decoding them again."""
    own = [c for c in ("doc_id", "lang", "source", "text") if c in docs.columns]
    return bpe.token_digests(docs.select(own), ids=True).drop("text")


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("bpe", tokens),
]

#: Language model, LSTM and merges can't be put in SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(spark, docs, f"stage-{k}-{name}")
    return docs
