"""Awkward documents shared by the operators' tests."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, score string"


def make_text(r, words, n):
    return " ".join(r.choice(words) for _ in range(n))


EN = "the of and to in is that for it with on as was be by are this from at have".split()
FR = "le la les des une est dans que pour sur avec pas qui au ce il sont mais être très".split()


@pytest.fixture(scope="session")
def doc_rows():
    """(doc_id, text, lang): nulls, empty and long texts, copies, near copies,
    repeated rows, shared ids and ties."""
    r = random.Random(5)
    rows = []
    for i in range(40):
        rows.append((i, make_text(r, EN if i % 2 else FR, r.randint(30, 80)).capitalize(), "en" if i % 2 else "fr"))
    long = make_text(r, [a + b for a in EN for b in EN], 4000)
    rows += [(100, long, "en"), (101, long + " end", "en"), (102, None, "en"), (103, "", None), (104, "  \n\t ", "fr"), (105, "12 34 !!", "en"),
             (106, rows[3][1], "en"), (107, rows[3][1], None), (108, "one two", "en"), (109, "one two", "en"), (110, "Ünï ÇÖDÉ 漢字 😀 x", "en"),
             (None, "a row without an id and with some words", "en"), (None, None, None), (111, "a" * 3000, "en")]
    rows += [rows[5], rows[5], (7, "another text under a used id", "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    """The documents, with extra columns whose names clash with operators' own."""
    rows = [(i, t, lang, "s", None if t is None else len(t), "x", "y") for i, t, lang in doc_rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
