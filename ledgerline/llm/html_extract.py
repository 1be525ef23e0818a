"""Operator 4: main text of pages by a linear-chain CRF over DOM leaf blocks.

A page is cut into leaf blocks (text between the borders of block elements).
Each block has binary features of its ancestors (tags, class and id names,
the sections it stands in) and of its text (length, link share, how it ends,
where on the page).  A linear-chain CRF labels the sequence of blocks as kept
or not; it is trained on labelled pages by gradient ascent, and a page is
decoded by Viterbi.  The kept blocks, in page order, are the main text.

The tables hold no labels, so labelled pages are laid out from the words of a
bounded sample of the pages (``SAMPLE_PAGES`` with the smallest hash, of at
most ``SAMPLE_CHARS`` characters each): many layouts with menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around an
article (``html_blocks.PageMaker``).  ``train`` takes any labelled pages.

Defined cases: null or empty html gives empty text; character references are
decoded, white space in a block (line breaks too) becomes one space, blocks
are joined by one newline; a page cut off anywhere is read as far as it goes;
repeated rows and url ties are kept row by row; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.html_blocks import Block, PageMaker, blocks, labelled
from ledgerline.llm.runtime import ship_code

SAMPLE_PAGES = 200
SAMPLE_CHARS = 50_000
TRAINING_PAGES = 1200
MIN_COUNT = 8


def _bucket(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def own_features(page: list[Block]) -> list[set[str]]:
    """The binary features of each block of a page, but for its ancestors' names."""
    out = []
    n = len(page)
    for k, b in enumerate(page):
        size = b.text.count(" ") + 1
        link = min(1.0, b.linked / max(1, len(b.text)))
        near = (*b.sections, "", "")[:2]
        f = {"bias", f"p={b.parent}", f"s={near[0]}", f"ss={near[0]}<{near[1]}", f"words={_bucket(size, (3, 6, 11, 21, 51))}",
              f"link={_bucket(link, (0.01, 0.34, 0.67))}", f"at={_bucket(k / n, (0.1, 0.3, 0.7, 0.9))}", f"end={b.text[-1] if b.text[-1] in '.!?:…' else ''}"}
        if any(c in b.text for c in "©®|»›·"):
            f.add("sign")
        out.append(f)
    return out


def features(page: list[Block]) -> list[set[str]]:
    """All binary features of each block."""
    return [f | b.around for f, b in zip(own_features(page), page)]


class Crf:
    """Two labels; emission weights are those of "keep" against "leave"."""

    def __init__(self, weights: dict[str, float], trans: list[list[float]], start: list[float]):
        self.weights, self.trans, self.start = weights, trans, start

    def around(self, page: list[Block]) -> list[float]:
        """Of each block, the sum of its ancestors' weights: each element's own
        are added to its parent's sum once."""
        get = self.weights.get
        sums: dict[int, float] = {}
        out = []
        for b in page:
            at, way = b.place, []
            while at is not None and id(at) not in sums:
                way.append(at)
                at = at.up
            total = sums[id(at)] if at is not None else 0.0
            for at in reversed(way):
                total += sum(get(x, 0.0) for x in at.new)
                sums[id(at)] = total
            out.append(sums[id(b.place)])
        return out

    def decode(self, page: list[Block]) -> list[int]:
        if not page:
            return []
        get, t = self.weights.get, self.trans
        back, a, b = [], 0.0, 0.0
        for k, (f, e) in enumerate(zip(own_features(page), self.around(page))):
            e += sum(get(x, 0.0) for x in f)
            if k:
                from0, from1 = (a + t[0][0], b + t[1][0]), (a + t[0][1], b + t[1][1])
                back.append((from0[1] > from0[0], from1[1] > from1[0]))
                a, b = max(from0), max(from1) + e
            else:
                a, b = self.start[0], self.start[1] + e
        label = int(b > a)
        out = [label]
        for was in reversed(back):
            label = int(was[label])
            out.append(label)
        return out[::-1]

    def main_text(self, html: str | None) -> str:
        page = blocks(html) if html else []
        return "\n".join(b.text for b, keep in zip(page, self.decode(page)) if keep)


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 80, ridge: float = 1e-4, longest: int = 60) -> Crf:
    """Fit the CRF to labelled pages by full-batch Adam on the log-likelihood."""
    pages = [(p[:longest], y[:longest]) for p, y in pages if p]
    seen = [features(p) for p, _ in pages]
    count: dict[str, int] = {}
    for page in seen:
        for f in page:
            for x in f:
                count[x] = count.get(x, 0) + 1
    names = sorted(x for x, c in count.items() if c >= MIN_COUNT)
    where = {x: i for i, x in enumerate(names)}
    n, t = len(pages), max((len(p) for p, _ in pages), default=0)
    row, col, y, real = [], [], np.zeros((n, t), int), np.zeros((n, t), bool)
    for i, (page, (_, labels)) in enumerate(zip(seen, pages)):
        for k, f in enumerate(page):
            y[i, k], real[i, k] = labels[k], True
            ids = [where[x] for x in sorted(f) if x in where]
            row += [i * t + k] * len(ids)
            col += ids
    row, col = np.array(row, int), np.array(col, int)
    w = np.zeros(len(names) + 6)  # emissions, 2 x 2 transitions, 2 starts
    m, v = np.zeros_like(w), np.zeros_like(w)
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for step in range(1, rounds + 1):
        tr, st = w[-6:-2].reshape(2, 2), w[-2:]
        em = np.zeros((n, t, 2))
        em[:, :, 1] = np.bincount(row, w[col], n * t).reshape(n, t)
        a, b = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        a[:, 0] = st + em[:, 0]
        for k in range(1, t):
            new = lse(a[:, k - 1][:, :, None] + tr, 1) + em[:, k]
            a[:, k] = np.where(real[:, k, None], new, a[:, k - 1])
        for k in range(t - 2, -1, -1):
            new = lse(tr + (em[:, k + 1] + b[:, k + 1])[:, None, :], 2)
            b[:, k] = np.where(real[:, k + 1, None], new, 0)
        z = lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None])
        grad = np.zeros_like(w)
        grad[:len(names)] = np.bincount(col, ((y - p[:, :, 1]) * real).ravel()[row], len(names))
        for k in range(1, t):
            both = np.exp(a[:, k - 1][:, :, None] + tr + (em[:, k] + b[:, k])[:, None, :] - z[:, None, None])
            both = (both * real[:, k, None, None]).sum(0)
            gold = np.zeros((2, 2))
            np.add.at(gold, (y[:, k - 1][real[:, k]], y[:, k][real[:, k]]), 1)
            grad[-6:-2] += (gold - both).ravel()
        grad[-2:] += np.bincount(y[:, 0], minlength=2) - p[:, 0].sum(0)
        grad = grad / n - ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w + 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Crf(dict(zip(names, w.tolist())), w[-6:-2].reshape(2, 2).tolist(), w[-2:].tolist())


def training_pages(sample: list[str], pages: int = TRAINING_PAGES) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages in many layouts, from the words of sample pages."""
    long, short = [], []
    for html in sample:
        for b in blocks(html):
            (long if b.text.count(" ") >= 7 and not b.linked else short).append(b.text)
    maker = PageMaker(sorted(set(long)), sorted(set(short + [" ".join(x.split()[:4]) for x in long])))
    return [labelled(maker.page()) for _ in range(pages)]


def fit(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Crf:
    """Train on layouts of a bounded sample of the pages."""
    fit_rows = (pages.select(F.col(html).alias("html")).filter(F.length("html").between(1, SAMPLE_CHARS))
                .withColumn("h", F.xxhash64("html")))
    lowest = fit_rows.select("h").distinct().orderBy("h").limit(sample_pages).agg(F.max("h")).head()[0]
    rows = [] if lowest is None else fit_rows.filter(F.col("h") <= lowest).dropDuplicates(["h"]).orderBy("h").collect()
    return train(training_pages([r["html"] for r in rows]))


def extract(df: DataFrame, model: Crf, html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``: the main text of the whole page."""
    spark = df.sparkSession
    ship_code(spark)
    handle = spark.sparkContext.broadcast((model.weights, model.trans, model.start))

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        crf = Crf(*handle.value)
        for rows in batches:
            yield pa.array([crf.main_text(x) for x in rows.to_pylist()], pa.string())

    return df.withColumn(out, text(F.col(html)))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages, fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
