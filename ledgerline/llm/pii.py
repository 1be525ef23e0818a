"""Operator 7: personal data by a character BiLSTM-CRF over overlapping windows.

Base spans are found by fixed patterns with their checks.  The tagger
(``pii_model.py``) is trained on windows whose labels are those base spans,
together with windows in which a span is rewritten the ways people write them
(phones without the plus, cards grouped by dots, accented e-mail names), so it
adds spans that the patterns miss.

Every span of these kinds holds a digit or an ``@``.  Windows of ``WINDOW``
characters, ``STRIDE`` apart, cover each stretch of text within ``CONTEXT``
characters of one and on to the next white space; elsewhere no span can be.
Windows overlap: each character's scores are averaged over its windows,
weighted towards their middle, and one Viterbi pass over the whole stretch
reconciles them.  Stretches of more than ``SEGMENT`` characters are read in
parts that end at white space and overlap by ``LAP``; only a run of more than
``SEGMENT`` characters without any is cut inside, and of spans that two parts
read differently the longer counts.  A found span is added if it has the parts
its kind needs, beats the reading without it by ``MARGIN`` in log score, and
meets no base span; or if it beats it at all and holds the base spans that it
meets (an address around the part of it that the pattern takes).  Base spans
stay.

Fit: the windows of the ``SAMPLE_DOCS`` documents with a digit or ``@`` whose
text has the smallest hash, ``WINDOWS_PER_DOC`` each at most: a documented
bound.

Defined cases: null text is empty and has no spans; repeated rows get equal
spans; spans of different kinds may overlap, and an added one may hold a base
one; else those of one kind don't; extra columns pass through; with nothing to learn from, the base spans alone remain.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import pii_model as net
from ledgerline.llm.runtime import ship_code, tidied

KINDS = net.KINDS
WINDOW, STRIDE, CONTEXT = 96, 64, 24
SAMPLE_DOCS, WINDOWS_PER_DOC = 600, 4
MARGIN = 4.0
SEGMENT, LAP = 1 << 14, 1 << 10

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_RUN = re.compile(r"[0-9@]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SPACE = re.compile(r"\s")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        else:
            end = max(end, at + 1) if start == at else end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns, sorted."""
    if not text or not _ANCHOR.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# -- labelled windows -------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within CONTEXT characters of a digit or @, on either
    side up to white space."""
    out: list[tuple[int, int]] = []
    for m in _RUN.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        before = out[-1][1] if out else 0
        while a > before and not text[a - 1].isspace():
            a -= 1
        if b > before and (found := _SPACE.search(text, b)):
            b = found.start()
        elif b > before:
            b = len(text)
        if out and a <= before:
            out[-1] = (out[-1][0], max(before, b))
        else:
            out.append((a, b))
    return out


def segments(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """The parts in which a stretch is read: they end at white space where there
    is any, and begin LAP characters before the end of the last."""
    while b - a > SEGMENT + LAP:
        cut = a + SEGMENT
        spaces = [m.end() for m in _SPACE.finditer(text, cut - SEGMENT // 2, cut)]
        cut = spaces[-1] if spaces else cut
        yield a, cut + (0 if spaces else LAP)
        a = cut - LAP if spaces else cut
        start = _SPACE.search(text, a, cut) if spaces else None
        a = start.end() if start else a
    yield a, b


def tag_window(spans: list[tuple[int, int, int]], a: int, b: int) -> list[int]:
    """Tags of the characters a..b; of spans that overlap, the first counts."""
    tags, upto = [0] * (b - a), -1
    for s, k, e in spans:
        if s >= a and e <= b and s > upto:
            tags[s - a:e - a] = [1 + 2 * k] + [2 + 2 * k] * (e - s - 1)
            upto = e - 1
    return tags


_PLAIN, _ACCENTED = "abcdefghijklmnopqrstuvwxyz", "áéíóúñüöäçèêàßøå"


def _name(r: np.random.Generator) -> str:
    """A made-up local part: some words, letters of which may have accents."""
    def word() -> str:
        return "".join(r.choice(list(_ACCENTED if r.random() < 0.15 else _PLAIN)) for _ in range(int(r.integers(2, 10))))
    return str(r.choice([".", "_", "-", ""])).join(word() for _ in range(int(r.integers(1, 5))))


def variants(text: str, tags: list[int], seed: int) -> list[tuple[str, list[int]]]:
    """The window, and rewritten ones that the patterns miss."""
    out = [(text, tags)]
    r = np.random.default_rng(seed)
    for k, rewrite in ((3, lambda s: s[s.index(" ") + 1:] if " " in s else s.lstrip("+")),
                       (3, lambda s: re.sub(r"[^0-9]+", ".", s.lstrip("+"))),
                       (2, lambda s: ".".join(re.sub(r"\D", "", s)[i:i + 4] for i in range(0, 16, 4))),
                       (0, lambda s: s.replace("mail", "máil").replace("o", "ó", 1)),
                       (0, lambda s: _name(r) + s[s.index("@"):]),
                       (0, lambda s: _name(r) + s[s.index("@"):]),
                       (0, lambda s: chr(97 + int(r.integers(26))) + "ñ" + s)):
        if 1 + 2 * k in tags:
            s = tags.index(1 + 2 * k)
            e = s + 1
            while e < len(tags) and tags[e] == 2 + 2 * k:
                e += 1
            new = rewrite(text[s:e])
            if len(new) >= 6:
                out.append((text[:s] + new + text[e:], tags[:s] + [1 + 2 * k] + [2 + 2 * k] * (len(new) - 1) + tags[e:]))
    return out


def labelled_windows(text: str, limit: int = WINDOWS_PER_DOC) -> list[tuple[str, list[int]]]:
    spans = base_spans(text)
    out = []
    for a, b in stretches(text)[:limit]:
        a, b = max(0, min(a, b - WINDOW)), min(len(text), max(b, a + WINDOW))
        out.append((text[a:min(b, a + WINDOW)], tag_window(spans, a, min(b, a + WINDOW))))
    return out


def fit_windows(windows: list[tuple[str, list[int]]]) -> dict[str, np.ndarray] | None:
    """Train the tagger on labelled windows; None without any label."""
    every = [v for i, (t, g) in enumerate(windows) for v in variants(t, g, i)]
    if not any(any(g) for _, g in every):
        return None
    ids, tags = np.zeros((len(every), WINDOW), np.int64), np.zeros((len(every), WINDOW), np.int64)
    for i, (t, g) in enumerate(every):
        t, g = t[:WINDOW], g[:WINDOW]
        ids[i, :len(t)], tags[i, :len(g)] = net.char_ids(t), g
    return net.train(ids, tags)


def fit(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> dict[str, np.ndarray] | None:
    """Train on a bounded sample of the documents (see above)."""
    spark = docs.sparkSession
    ship_code(spark)
    own = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("h")).filter(F.col("text").rlike("[0-9@]"))
    lowest = own.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).head()[0]
    if lowest is None:
        return None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            rows = [(h, w, bytes(g)) for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w, g in labelled_windows(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["h", "window", "tags"])

    sample = own.filter(F.col("h") <= lowest).mapInArrow(cut, "h long, window string, tags binary").distinct()
    rows = sorted((r["h"], r["window"], bytes(r["tags"])) for r in sample.collect())  # sample_docs x WINDOWS_PER_DOC at most
    return fit_windows([(w, list(g)) for _, w, g in rows])


# -- decoding ----------------------------------------------------------------------

def _scores(p: dict[str, np.ndarray], texts: list[str]) -> list[np.ndarray]:
    """Emissions of each stretch, averaged over its overlapping windows."""
    cuts = [(i, a) for i, t in enumerate(texts) for a in range(0, max(1, len(t) - WINDOW + STRIDE), STRIDE)]
    total = [np.zeros((len(t), net.TAGS)) for t in texts]
    weight = [np.zeros((len(t), 1)) for t in texts]
    middle = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(float)[:, None]
    ids = [net.char_ids(t) for t in texts]
    for k in range(0, len(cuts), 512):
        part = cuts[k:k + 512]
        x = np.zeros((len(part), WINDOW), np.int64)
        for j, (i, a) in enumerate(part):
            own = ids[i][a:a + WINDOW]
            x[j, :len(own)] = own
        em = net.emissions(p, x)
        for j, (i, a) in enumerate(part):
            n = min(WINDOW, len(texts[i]) - a)
            total[i][a:a + n] += em[j, :n] * middle[:n]
            weight[i][a:a + n] += middle[:n]
    return [t / w for t, w in zip(total, weight)]


def _plausible(kind: int, s: str) -> bool:
    digits = sum(c.isdigit() for c in s)
    if kind == 0:
        return 0 < s.find("@") < len(s) - 1 and not any(c.isspace() for c in s)
    if kind == 1:
        return s.count(".") == 3 and digits >= 4 and len(s) <= 15
    return 12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


def added_spans(p: dict[str, np.ndarray], texts: list[str], base: list | None = None) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) that the tagger reads in each text; one around a
    base span needs no margin, as something is there."""
    where = []
    base = base or [[] for _ in texts]
    for i, t in enumerate(texts):
        for a, b in stretches(t) if t else ():
            where += [(i, *part) for part in segments(t, a, b)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    where.sort(key=lambda x: x[2] - x[1])
    tr = p["trans"] + net.allowed()
    k = 0
    while k < len(where):
        n = 1
        while k + n < len(where) and n < 256 and (n + 1) * (where[k + n][2] - where[k + n][1]) <= 256 * WINDOW * 2:
            n += 1
        part = where[k:k + n]
        k += n
        em = _scores(p, [texts[i][a:b] for i, a, b in part])
        longest = max(len(e) for e in em)
        padded = np.zeros((n, longest, net.TAGS))
        for j, e in enumerate(em):
            padded[j, :len(e)] = e
        tags = net.best_tags(p, padded, np.array([len(e) for e in em]))
        for (i, a, b), e, g in zip(part, em, tags):
            for s in np.flatnonzero(g % 2 == 1).tolist():
                kind, end = (int(g[s]) - 1) // 2, s + 1
                while end < len(e) and g[end] == g[s] + 1:
                    end += 1
                run = g[s:end]
                own = e[np.arange(s, end), run].sum() + tr[run[:-1], run[1:]].sum()
                none = e[s:end, 0].sum() + (end - s - 1) * tr[0, 0]
                for left, right in ((s - 1, s), (end - 1, end)):
                    if left >= 0 and right < len(e):
                        own += tr[g[left], g[right]]
                        none += tr[0 if s <= left else g[left], 0 if right < end else g[right]]
                at = bisect_left(base[i], (a + s, -1, 0))
                holds = at < len(base[i]) and base[i][at][2] <= a + end
                if own - none >= (0.0 if holds else MARGIN) and _plausible(kind, texts[i][a + s:a + end]):
                    out[i].append((a + s, kind, a + end))
    return [sorted(set(x)) for x in out]


def all_spans(p: dict[str, np.ndarray] | None, texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, base) of each text: the base spans and those added."""
    base = [base_spans(t) for t in texts]
    more = added_spans(p, texts, base) if p else [[] for _ in texts]
    out = []
    for own, new in zip(base, more):
        kept = reconciled(new)
        met = _met(own, kept)
        added = [(s, k, e, False) for (s, k, e), inside in zip(kept, met) if all(s <= s2 and e2 <= e and (s, e) != (s2, e2) for s2, _, e2 in inside)]
        out.append(sorted([(s, k, e, True) for s, k, e in own] + added))
    return out


def reconciled(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans of one kind that overlap, the longest (the first of those that tie)."""
    out = []
    for kind in range(len(KINDS)):
        own = sorted((s, e) for s, k, e in spans if k == kind)
        at = 0
        while at < len(own):
            group, end = [own[at]], own[at][1]
            at += 1
            while at < len(own) and own[at][0] < end:
                end = max(end, own[at][1])
                group.append(own[at])
                at += 1
            taken: list[tuple[int, int]] = []
            for s, e in sorted(group, key=lambda x: (x[0] - x[1], x[0])):
                if all(e <= s2 or e2 <= s for s2, e2 in taken):
                    taken.append((s, e))
            out += [(s, kind, e) for s, e in taken]
    return sorted(out)


def _met(base: list[tuple[int, int, int]], spans: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The base spans that each span overlaps; both come sorted by their start."""
    out, first = [], 0
    longest = max((e - s for s, _, e in base), default=0)
    for s, _, e in spans:
        while first < len(base) and base[first][0] + longest <= s:
            first += 1
        own, k = [], first
        while k < len(base) and base[k][0] < e:
            if s < base[k][2]:
                own.append(base[k])
            k += 1
        out.append(own)
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(df: DataFrame, model: dict[str, np.ndarray] | None, text: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``: array of (kind, start, end, base), code points, end exclusive."""
    spark = df.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(model)

    @F.arrow_udf("array<struct<kind: string, start: int, end: int, base: boolean>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in tidied(batches):
            found = all_spans(handle.value, [t or "" for t in texts.to_pylist()])
            yield pa.array([[{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in row] for row in found], _SPANS)

    return df.withColumn(out, spans(F.col(text)))


def redact(df: DataFrame, model: dict[str, np.ndarray] | None, text: str = "text") -> DataFrame:
    """Replace every stretch of spans by its first kind's name, as ``[EMAIL]``."""
    spark = df.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in tidied(batches):
            rows = texts.to_pylist()
            found = all_spans(handle.value, [t or "" for t in rows])
            yield pa.array([redacted(t, s) if t else t for t, s in zip(rows, found)], pa.string())

    return df.withColumn(text, clean(F.col(text)))


def redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, upto = [], 0
    for s, k, e, _ in spans:
        if s >= upto:
            out += [text[upto:s], f"[{KINDS[k].upper()}]"]
        upto = max(upto, e)
    return "".join(out) + text[upto:]


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, fit(docs)).drop("text")
    written = F.array_join(F.transform("pii", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("pii", lambda x: x["base"])
    found = found.select("doc_id", "pii", base.alias("own"), written.alias("spans"))
    counts = [F.expr(f"size(filter(own, x -> x.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(F.array_join(F.transform("own", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), "spans")
