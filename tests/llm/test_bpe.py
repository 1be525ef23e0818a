import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import bpe

LIB = Tokenizer.from_file(bpe.default_path())
with open(bpe.default_path(), encoding="utf-8") as f:
    CODEC = bpe.Codec(f.read())


def expected(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab 's\n\t1é漢!"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_matches_the_library(text):
    ids = CODEC.encode(text)
    assert ids == expected(text)
    assert CODEC.decode(ids) == LIB.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "<|endof", "aaaa" * 5000, "ab" * 20000, "!" * 9000, " " * 3000, "\x85\xa0​  x"])
def test_added_tokens_and_long_pieces(text):
    assert CODEC.encode(text) == expected(text)


def test_decoding_bytes_that_are_no_text():
    ids = CODEC.encode("é漢")[:1] + CODEC.encode("x")
    assert CODEC.decode(ids) == LIB.decode(ids, skip_special_tokens=False)


def test_root_is_the_leftmost_lowest_rank():
    # naive merging: scan for the lowest rank, leftmost first
    def naive(data):
        sym = [CODEC.base[b] for b in data]
        while True:
            ranks = [(CODEC.rank.get(a << 32 | b, 1 << 60), i) for i, (a, b) in enumerate(zip(sym, sym[1:]))]
            if not ranks or min(ranks)[0] == 1 << 60:
                return sym
            r, i = min(ranks)
            sym[i:i + 2] = [CODEC.made[r >> 32]]

    for word in (b"internationalisation", b"aaaaaaa", b"thethethe", b"x", b"", b"zqzqzq" * 9):
        assert CODEC.merge(word) == naive(word)


def test_table(spark, docs, no_docs, doc_rows):
    rows = bpe.token_digests(docs, ids=True).collect()
    assert len(rows) == len(doc_rows) and "fp" in rows[0].asDict()
    for r in rows:
        ids = expected(r["text"])
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.token_digests(no_docs).count() == 0
    back = bpe.decode(bpe.encode(docs.select("doc_id", "text"))).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
