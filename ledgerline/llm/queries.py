"""The operators' registered queries and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, cover_tree, decontaminate, edit_fingerprint, html_extract, language_id, lexical_search, lloyd, pii, sharding, simhash, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_embedding": edit_fingerprint.op1_edit_embedding,
    "op2_winnowing": decontaminate.op2_winnowing,
    "op3_language_id": language_id.op3_language_id,
    "op4_html_extract": html_extract.op4_html_extract,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_warc": warc.op6_warc,
    "op7_pii": pii.op7_pii,
    "op8_simhash": simhash.op8_simhash,
    "op9_sharding": sharding.op9_sharding,
    "op10_bpe": bpe.op10_bpe,
    "op11_rmq_search": lexical_search.op11_rmq_search,
    "op12_cover_tree": cover_tree.op12_cover_tree,
    "op13_sharded_lloyd": lloyd.op13_sharded_lloyd,
}

ORACLE_SQL: dict[str, str] = {
    "op2_winnowing": decontaminate.OP2_SQL,
    "op6_warc": warc.OP6_SQL,
    "op11_rmq_search": lexical_search.OP11_SQL,
    "op12_cover_tree": cover_tree.OP12_SQL,
    "op13_sharded_lloyd": lloyd.OP13_SQL,
}
