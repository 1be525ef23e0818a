"""The pipeline's stages against plain Python over a small corpus."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm import test_decontaminate as D
from tests.llm import test_pii as P
from tests.llm import test_simhash as S
from tests.llm.conftest import EN, FR, make_text
from tests.llm.test_bpe import expected as token_ids

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    words = {"en": [a + b for a in EN for b in EN], "fr": [a + b for a in FR for b in FR]}
    bench = [(k, make_text(r, words["en"], 25)) for k in range(5)] + [(9, None)]
    rows = []
    for i in range(90):
        lang = "en" if i % 3 else "fr"
        text = make_text(r, words[lang], r.randint(60, 120))
        if i % 9 == 4:
            text = f"{text} {bench[i % 5][1]} {text[:50]}"
        if i % 7 == 2:
            text += f" write to user{i}@mail.example.com or +1 (212) 555-01{i:02d}"
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    rows += [(200 + k, rows[10][1], "en", "s", len(rows[10][1])) for k in range(6)]  # copies
    rows += [(300, rows[20][1] + " tail", "en", "s", None), (301, None, "en", "s", None), (302, "", "en", "s", 0), (303, "12 ... 34", "en", "s", 9),
             rows[30], rows[30], (40, "another english text of the kind that is here under a used id", "en", "s", 60), (None, rows[50][1], None, None, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, bench


def stage(name):
    return dict(C.STAGES)[name]


def test_the_stages_and_their_order():
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "pii", "bpe"]


def test_language_stage(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = stage("language_id")(spark, docs, path)
    assert out.columns == docs.columns
    kept = sorted(map(repr, map(tuple, out.collect())))
    assert kept == sorted(map(repr, (r for r in rows if r[1] and any(c.isalpha() for c in r[1]))))


def test_the_number_of_languages_rejects_nothing(spark, folder):
    """Names and codes that five languages share lie near a tie, however long."""
    r = random.Random(9)
    shared = [a + b for a in EN for b in FR]
    rows = [(i, make_text(r, shared, 400), f"l{i % 5}", "s", None) for i in range(60)]
    out = stage("language_id")(spark, spark.createDataFrame(rows, COLUMNS), folder[0])
    assert sorted(x["doc_id"] for x in out.collect()) == list(range(60))


def test_near_duplicate_stage(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [tuple(r) for r in stage("simhash_near_dedup")(spark, docs, path).collect()]
    root = S.naive_roots([S.naive_fp(r[1]) for r in rows])
    groups = {}
    for r, g in zip(rows, root):
        groups.setdefault(g, []).append(r)
    assert len(out) == len(groups)
    for g in groups.values():
        kept = [r for r in out if r in g]
        assert len(kept) >= 1 and kept[0][0] == min((r[0] for r in g if r[0] is not None), default=None)


def test_decontamination_stage(spark, folder):
    path, rows, bench = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = stage("decontamination")(spark, docs, path)
    assert out.columns == docs.columns
    want = [r for r in rows if not D.brute(r[1], bench)[4]]
    assert len(want) < len(rows)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_personal_data_stage(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = stage("pii")(spark, docs, path)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert not P.naive(r["text"] or "")
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"] or "")
    plain = {r[1] for r in rows if r[1] is not None and not re.search("[0-9@]", r[1])}
    assert plain <= {r["text"] for r in got}


def test_run_and_an_empty_corpus(spark, folder, tmp_path):
    path, rows, bench = folder
    out = C.run(spark, path).collect()
    ids = [r["doc_id"] for r in out]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < len(rows)
    assert not set(ids) & {i for i, t, *_ in rows if t and D.brute(t, bench)[4] and i is not None and i < 90 and i != 40}
    for r in out:
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    clean = {r[0]: r[1] for r in rows if r[1] and not re.search("[0-9@]", r[1])}
    same = [r for r in out if r["doc_id"] in clean and r["doc_id"] not in (40,)]
    assert same and all(r["ids"] == token_ids(clean[r["doc_id"]]) for r in same)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


CLASHING = ["_text_key", "_id", "_key", "_n", "_lang_pred", "_lang_score", "text_key", "fp", "component_id", "lang_pred", "score", "h", "pii", "a.b", "_TEXT_KEY_"]


def test_columns_of_the_stages_own_names_pass_through(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in CLASHING])
    plain = docs
    for name, run in C.STAGES[:-1]:
        wide, plain = run(spark, wide, path), run(spark, plain, path)
        assert wide.columns == [*docs.columns, *CLASHING], name
        got = [tuple(r) for r in wide.collect()]
        for r in got:
            own = "?" if r[0] is None else str(r[0])
            assert list(r[len(docs.columns):]) == [f"{c}:{own}" for c in CLASHING], name
        assert sorted(repr(r[:len(docs.columns)]) for r in got) == sorted(repr(tuple(r)) for r in plain.collect()), name
    assert C.STAGES[-1][1](spark, wide, path).count() == len(got)


def test_ties_long_texts_and_repeated_rows(spark, folder):
    path = folder[0]
    r = random.Random(12)
    long = make_text(r, [a + b for a in EN for b in EN], 30_000)
    made = [(1, long, "en", "s", 5), (1, long, "en", "s", 5), (1, long, "en", "t", 6), (1, make_text(r, EN, 60), "en", "s", 1),
            (None, make_text(r, FR, 60), "fr", None, None), (None, make_text(r, FR, 70), None, None, None)]
    docs = spark.createDataFrame(made, COLUMNS)
    kept = stage("simhash_near_dedup")(spark, docs, path).collect()
    assert sum(x["text"] == long for x in kept) == 1 and len(kept) == 4
    for name, run in C.STAGES[2:4]:
        docs = run(spark, docs, path)
        assert docs.count() == 6, name
