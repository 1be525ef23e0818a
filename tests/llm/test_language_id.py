import random

from ledgerline.llm import language_id as L
from tests.llm.conftest import EN, FR, make_text


def test_held_out_accuracy_on_the_tables(spark):
    from tests.conftest import SF01
    got = L.op3_language_id(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and len(held) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_unseen_words_back_off_to_ngrams(spark):
    r = random.Random(1)
    rows = [(make_text(r, EN, 40), "en") for _ in range(30)] + [(make_text(r, FR, 40), "fr") for _ in range(30)]
    model = L.fit(spark, spark.createDataFrame(rows, "text string, lang string"))
    model.start()
    assert "thisfrom" not in model.words and model.predict("thisfrom withhave")[0] == "en"
    assert model.predict("dansune mêmeêtre lessont")[0] == "fr"
    # the longest known n-gram at each position, against a plain walk
    for word in ("thave", "zzz", "êtres", "t"):
        padded = f"^{word}$"
        total = 0
        for i in range(len(padded)):
            hit = next((model.grams[padded[i:i + n]] for n in (4, 3, 2, 1) if len(padded) - i >= n and padded[i:i + n] in model.grams), None)
            total = total + (model.floor if hit is None else model.gram_logs[hit])
        assert abs(model.backed_off(word) - total / len(padded)).max() < 1e-9


def test_memory_of_words_does_not_change_results(spark, monkeypatch):
    r = random.Random(1)
    rows = [(make_text(r, EN, 40), "en") for _ in range(9)] + [(make_text(r, FR, 40), "fr") for _ in range(9)]
    model = L.fit(spark, spark.createDataFrame(rows, "text string, lang string"))
    texts = [" ".join("".join(r.choice("aehinorstué") for _ in range(6)) for _ in range(50)) for _ in range(20)]
    model.start()
    want = [model.predict(t) for t in texts]
    monkeypatch.setattr(L, "REMEMBERED", 16)
    model.start()
    for (a, s), (b, t) in zip(want, (model.predict(t) for t in texts)):
        assert a == b and abs(s - t) < 1e-9


def test_table(spark, docs, no_docs, doc_rows):
    model = L.fit(spark, docs.filter("lang IS NOT NULL"))
    got = L.identify(docs, model).collect()
    assert len(got) == len(doc_rows) and got[0]["fp"] == "x"
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1
    assert len({(r["lang_pred"], r["score"]) for r in got if r["text"] == doc_rows[5][1]}) == 1
    empty = L.fit(spark, no_docs)
    assert {r["lang_pred"] for r in L.identify(docs, empty).collect()} == {"und"}
    assert L.identify(no_docs, model).count() == 0


def test_the_sample_is_bounded(spark):
    rows = [(f"word{i} here", "en") for i in range(50)] + [("same text", "en")] * 200
    model = L.fit(spark, spark.createDataFrame(rows, "text string, lang string"), per_lang=10, min_count=1)
    assert len(model.words) <= 12


def test_small_languages_in_many_copies_beside_a_large_one(spark):
    """Two languages of 15 texts, each in 2,000 copies, beside 10,000 distinct
    English texts: fresh texts of all three are told apart."""
    r = random.Random(9)
    de = "der die das und ist nicht mit auf für von den dem eine auch sich werden wurde über nach bei".split()
    def grown(words):  # a large vocabulary of compounds
        return words + [a + b for a in words for b in words]
    vocab = {"en": grown(EN), "fr": grown(FR), "de": grown(de)}
    rows = [(make_text(r, vocab["en"], 40), "en") for _ in range(10_000)]
    few = [(make_text(r, vocab[x], 40), x) for x in ("fr", "de") for _ in range(15)]
    small = spark.createDataFrame(few, "text string, lang string").crossJoin(spark.range(2000)).drop("id")
    model = L.fit(spark, spark.createDataFrame(rows, "text string, lang string").unionByName(small))
    model.start()
    for x, words in vocab.items():
        fresh = [model.predict(make_text(r, words, 40))[0] for _ in range(200)]
        assert sum(p == x for p in fresh) / 200 >= 0.97, x
    assert set(model.langs) == {"en", "fr", "de"}


def test_predictions_are_the_largest_plain_sums(spark):
    """Every word's row added up one by one, in plain Python."""
    import math
    r = random.Random(6)
    rows = [(make_text(r, EN, 40), "en") for _ in range(30)] + [(make_text(r, FR, 40), "fr") for _ in range(30)]
    model = L.fit(spark, spark.createDataFrame(rows, "text string, lang string"))
    model.start()
    for _ in range(60):
        text = make_text(r, EN + FR + ["thwith", "unedes", "zz", "12", "ê"], r.randint(1, 30))
        words = [w for w in L._letters(text.lower())]
        if not words:
            assert model.predict(text) == ("und", 0.0)
            continue
        total = [sum(float((model.word_logs[model.words[w]] if w in model.words else model.backed_off(w))[k]) for w in words) for k in range(2)]
        mean = [t / len(words) for t in total]
        best = max(range(2), key=lambda k: mean[k])
        share = sum(math.exp((m - mean[best]) * min(len(words), L.EVIDENCE)) for m in mean)
        lang, score = model.predict(text)
        assert abs(score - 1 / share) < 1e-9 and (lang == model.langs[best] or abs(mean[0] - mean[1]) < 1e-12)
