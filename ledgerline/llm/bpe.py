"""Operator 10: byte-level BPE encoding and decoding with a segment tree.

Text is cut at the added tokens and then by the pre-tokenizer pattern; each
piece is merged by a segment tree over its adjacent pairs.  A leaf holds the
pair's merge rank packed with its position, an inner node the minimum of its
children, so the root is the leftmost lowest-rank merge.  A merge changes at
most three leaves, each updated in O(log n); it ends when the root holds no
mergeable pair.  A piece of n bytes costs O(n log n) whatever its length.

Defined cases: null text counts as empty (no ids); the texts of added tokens
(``<|endoftext|>``) inside a document become their ids, as the tokenizers
library does by default; repeated rows and ties are encoded row by row; extra
columns pass through untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.runtime import ship_code, tidied

#: Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces remembered by a Python worker, in two halves: the older half goes when
#: the younger is full.  This changes the speed only.
REMEMBERED = 1 << 19

_NONE = 1 << 62
_POS = 32
_POS_MASK = (1 << _POS) - 1


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies (char -> byte)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(x for x in range(256) if x not in set(plain)):
        out[chr(256 + k)] = b
    return out


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        chars = byte_alphabet()
        vocab = model["model"]["vocab"]
        self.base = [0] * 256
        self.token_bytes: dict[int, bytes] = {}
        for tok, i in vocab.items():
            self.token_bytes[i] = bytes(chars[c] for c in tok)
        for ch, b in chars.items():
            self.base[b] = vocab[ch]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << 32 | vocab[b], r << _POS)
            self.made.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pieces = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece, by the segment tree."""
        base, rank, made = self.base, self.rank.get, self.made
        sym = [base[b] for b in data]
        n = len(sym)
        if n < 2:
            return sym
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [_NONE] * size
        a = sym[0]
        for i in range(1, n):
            b = sym[i]
            tree.append(rank(a << 32 | b, _NONE) | i - 1)
            a = b
        tree += [_NONE] * (2 * size - len(tree))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        nxt = list(range(1, n + 1))
        prev = list(range(-1, n - 1))
        while (top := tree[1]) < _NONE:
            i = top & _POS_MASK
            j = nxt[i]
            k = nxt[j]
            sym[i] = new = made[top >> _POS]
            nxt[i] = k
            if k < n:  # the pair to the right now starts at i, none at j
                prev[k] = i
                changed = [(size + i, rank(new << 32 | sym[k], _NONE) | i), (size + j, _NONE)]
            else:
                changed = [(size + i, _NONE)]
            h = prev[i]
            if h >= 0:
                changed.append((size + h, rank(sym[h] << 32 | new, _NONE) | h))
            for p, low in changed:
                tree[p] = low
                while p > 1:  # up to the root, as far as a minimum changes
                    other = tree[p ^ 1]
                    p >>= 1
                    if other < low:
                        low = other
                    if tree[p] == low:
                        break
                    tree[p] = low
        out, i = [], 0
        while i < n:
            out.append(sym[i])
            i = nxt[i]
        return out

    def _plain(self, text: str, out: list[bytes]) -> None:
        known = self.known
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    ids = np.array(self.merge(piece.encode("utf-8", "replace")), "<u4").tobytes()
                if len(known) >= REMEMBERED // 2:
                    self.older, self.known = known, {}
                    known = self.known
                if len(piece) <= 64:
                    known[piece] = ids
            out.append(ids)

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if text:
            if self.cut is None:
                self._plain(text, out)
            else:
                for k, part in enumerate(self.cut.split(text)):
                    if k % 2:
                        out.append(np.array([self.added[part]], "<u4").tobytes())
                    elif part:
                        self._plain(part, out)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; byte sequences that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(spec: str) -> Codec:
    """One codec per worker and vocabulary, kept across tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids of each row as an Arrow list array."""
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int64).astype(np.int32)
    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def vocabulary(spark: SparkSession, path: str):
    """Broadcast of a vocabulary file (a few MB at most; its size is checked)."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > 64 * 1024 * 1024:
        raise ValueError(f"{path}: {len(spec)} characters is no vocabulary file")
    return spark.sparkContext.broadcast(spec)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """Add ``out`` (array<int>): the ids of the whole text."""
    spark = df.sparkSession
    ship_code(spark)
    spec = vocabulary(spark, path or default_path())

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(spec.value)
        for texts in tidied(batches):
            yield _lists([codec.encode_packed(t) for t in texts.to_pylist()])

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add ``out`` (string): the text that the ids stand for; null ids give ''."""
    spark = df.sparkSession
    ship_code(spark)
    spec = vocabulary(spark, path or default_path())

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(spec.value)
        for rows in tidied(batches):
            yield pa.array([codec.decode(r or []) for r in rows.to_pylist()], pa.string())

    return df.withColumn(out, text(F.col(ids)))


def token_digests(df: DataFrame, text: str = "text", path: str | None = None, ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, and add n_tokens,
    ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256
    (decoded text in UTF-8) and, if asked for, the ids."""
    spark = df.sparkSession
    ship_code(spark)
    spec = vocabulary(spark, path or default_path())

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    @F.arrow_udf(kind)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(spec.value)
        for texts in tidied(batches):
            n, ids_hex, text_hex, flat = [], [], [], []
            for t in texts.to_pylist():
                packed = codec.encode_packed(t)
                back = codec.decode(np.frombuffer(packed, "<u4").tolist())
                n.append(len(packed) // 4)
                ids_hex.append(hashlib.sha256(packed).hexdigest())
                text_hex.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
                if ids:
                    flat.append(packed)
            made = [pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            if ids:
                made.append(_lists(flat))
            yield pa.StructArray.from_arrays(made, list(names))

    names = ("n_tokens", "ids_sha256", "decoded_sha256") + ("ids",) * ids
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*kept, digests(F.col(text)).alias("_d")).select(*kept, *(F.col(f"_d.{c}").alias(c) for c in names))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_digests(docs).drop("text")
