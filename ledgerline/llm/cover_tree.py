"""Operator 12: embedding near-duplicates by dual traversal of a cover tree.

Vectors are scaled to length one, where a cosine of at least ``c`` is a
distance of at most sqrt(2 - 2c).  Equal directions are one node with a
weight, so a vector that is repeated in a third of all rows costs one node.

The tree is a hierarchy of nested nets with halving radii.  Its upper levels
are made from a bounded sample (``SAMPLE`` directions of smallest digest, as
good as random) and are sent to all tasks; every vector goes to the nearest
sampled one, its cell, and each node's covering radius is measured over all
vectors below it, so that bounds hold for the whole table.  Below the cells
each block of vectors goes on with nets of radius 1/2, 1/4, ...

The dual traversal takes pairs of nodes downwards.  A pair whose centres are
farther apart than both radii and the threshold together is dropped; a pair
that lies within the threshold as a whole is linked as a whole (weights are
added, one star joins all members) without being taken apart; the others go
on with their children's pairs, down to single vectors, whose cosine is
compared in double precision.  The upper levels are traversed on the driver
(at most ``SAMPLE`` cells a side); what is left are pairs of cells.  Their
vectors meet in pairs of blocks, one group of rows for each live pair, read
by whichever task gets it.  Cells of more than a block's rows are dealt out to
several blocks.  A pair of blocks returns for each linked vector its weight of
links and one edge of a spanning forest, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; vectors of another
length never link; repeated ids and repeated rows are rows of their own, each
linked with the others; null ids are skipped when a component's smallest id is
taken (null if it has none); a vector is kept if its id equals its
component's, null counting as equal to null; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.runtime import broadcast_if_small, saved, ship_code, tidied

COSINE = 0.9
#: Sampled directions that make the upper levels: bounds what is broadcast.
SAMPLE = 1024
#: Bytes of the vectors of one block: bounds the memory of a task.
BLOCK_BYTES = 4 << 20
UPPER = (1.0, 0.5, 0.25, 0.125, 0.0625)
LOWER = (0.5, 0.25, 0.125, 0.0625)
#: Distances come from cosines, whose rounding counts most near zero.
SLACK = 1e-7


# -- vectors ----------------------------------------------------------------

def unit_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, key, dim, unit): the direction as little-endian doubles and its
    digest; both null for vectors that have no direction."""
    ship_code(df.sparkSession)
    own = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    kind = own.schema["vec_id"].dataType.simpleString()

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            at = batch.column(1)
            start = at.offsets.to_numpy()[:-1]
            size = at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = at.values.to_numpy(zero_copy_only=False)  # null components become NaN
            keys: list = [None] * batch.num_rows
            units: list = [None] * batch.num_rows
            for d in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == d)
                x = flat[start[rows][:, None] + np.arange(d)]
                most = np.abs(x).max(1)
                good = np.isfinite(x).all(1) & (most > 0)
                rows, x = rows[good], x[good] / most[good][:, None]
                x = x / np.sqrt((x * x).sum(1))[:, None] + 0.0
                for r, v in zip(rows.tolist(), x):
                    units[r] = v.tobytes()
                    keys[r] = hashlib.blake2b(units[r], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(size, pa.int32()), pa.array(units, pa.binary())],
                names=["vec_id", "key", "dim", "unit"])

    return own.mapInArrow(scale, f"vec_id {kind}, key binary, dim int, unit binary")


def _matrix(units: pa.Array | list, dim: int) -> np.ndarray:
    data = b"".join(units if isinstance(units, list) else units.to_pylist())
    return np.frombuffer(data, np.float64).reshape(-1, dim)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


# -- nets --------------------------------------------------------------------

def net(x: np.ndarray, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """Split ``rows`` into groups, each within ``radius`` of its first row; the
    first rows are farther than that from each other, and the first of ``rows``
    comes first."""
    floor = 1 - radius * radius / 2
    groups: list[np.ndarray] = []
    while len(rows):
        few = rows[:128]
        near = x[few] @ x[few].T >= floor
        free = np.ones(len(few), bool)
        centres = []
        for i in range(len(few)):
            if free[i]:
                centres.append(i)
                free &= ~near[i]
        cosine = x[rows] @ x[few[centres]].T
        cosine[centres, np.arange(len(centres))] = 2  # a centre is its own
        best = cosine.argmax(1)
        taken = cosine[np.arange(len(rows)), best] >= floor
        is_centre = np.zeros(len(rows), bool)
        is_centre[centres] = True
        order = np.lexsort((~is_centre[taken], best[taken]))
        cut = np.flatnonzero(np.diff(best[taken][order])) + 1
        groups += np.split(rows[taken][order], cut)
        rows = rows[~taken]
    return groups


class Tree:
    """Nested nets over the rows of one block, in depth-first order.

    ``levels`` holds (start, end, radius) of each level's nodes; a node's centre
    is its first row.  The first level refines the given groups (cells)."""

    def __init__(self, x: np.ndarray, groups: list[np.ndarray]):
        made = []
        for radius in LOWER:
            groups = [h for g in groups for h in (net(x, g, radius) if len(g) > 1 else [g])]
            made.append(np.array([len(g) for g in groups]))
        self.order = np.concatenate(groups)
        self.x = x = x[self.order]
        self.levels = []
        for size in [*made, np.ones(len(x), np.int64)]:
            end = np.cumsum(size)
            start = end - size
            far = _distance(np.einsum("ij,ij->i", x, x[np.repeat(start, size)]))
            self.levels.append((start, end, np.where(size > 1, np.maximum.reduceat(far, start), 0)))

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, _ = self.levels[level]
        below = self.levels[level + 1][0]
        return np.searchsorted(below, start[node]), np.searchsorted(below, end[node])


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of each a and b in place; a label is the smallest
    row of its component."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def traverse(a: Tree, b: Tree, na: np.ndarray, nb: np.ndarray, least: float,
             done: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between the rows of two trees, or within one (``b is a``): the
    weight of links of each row of either, and a label for each row, equal for
    rows joined by links (rows of ``b`` after those of ``a``).  ``done``: the
    rows' cells, and the matrix of the pairs of cells that were linked before."""
    same = b is a
    reach = float(np.sqrt(2 - 2 * least))
    off = 0 if same else len(a.x)
    label = np.arange(off + len(b.x))
    gain = np.zeros(len(label) + 1, np.int64)  # differences along the order
    wa, wb = (np.append(0, np.cumsum(n)) for n in (na, nb))
    last = len(a.levels) - 1
    few = max(1024, (1 << 21) // a.x.shape[1])

    def link(level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All rows of node i with all rows of node j."""
        (sa, ea, _), (sb, eb, _) = a.levels[level], b.levels[level]
        sa, ea, sb, eb = sa[i], ea[i], sb[j], eb[j]
        weight = wb[eb] - wb[sb]
        np.add.at(gain, sa, weight)
        np.add.at(gain, ea, -weight)
        other = sa != sb if same else np.ones(len(sa), bool)
        weight = wa[ea[other]] - wa[sa[other]]
        np.add.at(gain, off + sb[other], weight)
        np.add.at(gain, off + eb[other], -weight)
        unite(label, sa, off + sb)
        for s, e, o in ((sa, ea, 0), (sb, eb, off)):
            s, first = np.unique(s, return_index=True)
            size = e[first] - s
            if (size > 1).any():
                head = np.repeat(s, size)
                rows = head + np.arange(len(head)) - np.repeat(np.cumsum(size) - size, size)
                unite(label, o + head, o + rows)

    def nets() -> Iterator[tuple]:
        """Pairs of the first nets, compared as matrix products."""
        (sa, _, ra), (sb, _, rb) = a.levels[0], b.levels[0]
        most, xb = rb.max(initial=0) + reach + SLACK, b.x[sb]
        for k in range(0, len(sa), 256):
            floor = 1 - np.minimum(ra[k:k + 256] + most, 2) ** 2 / 2
            cosine = a.x[sa[k:k + 256]] @ xb.T
            i, j = np.nonzero(cosine >= floor[:, None] - SLACK)
            c = cosine[i, j]
            i = i + k
            keep = j >= i if same else np.ones(len(i), bool)
            if done is not None:
                keep &= ~done[2][done[0][sa[i]], done[1][sb[j]]]
            yield 0, i[keep], j[keep], c[keep]

    def children(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
        """Pairs of the children of each pair of nodes, a bounded number at a time."""
        (ca, za), (cb, zb) = a.children(level, i), b.children(level, j)
        sa, sb = a.levels[level + 1][0], b.levels[level + 1][0]
        pairs = (za - ca) * (zb - cb)
        for g in np.flatnonzero(pairs > few).tolist():
            rows = max(1, few // int(zb[g] - cb[g]))
            for k in range(int(ca[g]), int(za[g]), rows):
                ni, nj = np.arange(k, min(k + rows, int(za[g]))), np.arange(int(cb[g]), int(zb[g]))
                cosine = (a.x[sa[ni]] @ b.x[sb[nj]].T).ravel()
                ni, nj = np.repeat(ni, len(nj)), np.tile(nj, len(ni))
                keep = nj >= ni if same and i[g] == j[g] else slice(None)
                yield level + 1, ni[keep], nj[keep], cosine[keep]
        rest = np.flatnonzero(pairs <= few)
        total = np.cumsum(pairs[rest])
        at = 0
        while at < len(rest):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + few, "right")))
            g = rest[at:to]
            own = np.repeat(g, pairs[g])
            within = np.arange(len(own)) - np.repeat(np.cumsum(pairs[g]) - pairs[g], pairs[g])
            wide = (zb - cb)[own]
            ni, nj = ca[own] + within // wide, cb[own] + within % wide
            if same:
                keep = (nj >= ni) | (i[own] != j[own])
                ni, nj = ni[keep], nj[keep]
            yield level + 1, ni, nj, np.einsum("ij,ij->i", a.x[sa[ni]], b.x[sb[nj]])
            at = to

    stack = [nets()]
    while stack:
        found = next(stack[-1], None)
        if found is None:
            stack.pop()
            continue
        level, i, j, c = found
        if level == last:
            good = (c >= least) | (i == j) if same else c >= least
            link(level, i[good], j[good])
            continue
        both = a.levels[level][2][i] + b.levels[level][2][j]
        d = np.where(i == j, 0, _distance(c)) if same else _distance(c)
        sure = d + both <= reach - SLACK
        link(level, i[sure], j[sure])
        on = ~sure & (d <= both + reach + SLACK)
        if on.any():
            stack.append(children(level, i[on], j[on]))
    return np.cumsum(gain[:-1]), label


# -- the upper levels --------------------------------------------------------

class Upper:
    """Nested nets over the sampled directions, whose finest level are cells."""

    def __init__(self, dims: list[int], units: list[bytes]):
        self.dim = np.array(dims, np.int64)
        self.of = {d: np.flatnonzero(self.dim == d) for d in np.unique(self.dim).tolist()}
        self.x = {d: _matrix([units[i] for i in rows], d) for d, rows in self.of.items()}

    def cell(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest sampled direction and the distance to it; vectors of a length
        that was not sampled share the cell -length, of the widest radius."""
        if dim not in self.of:
            return np.full(len(x), -dim), np.full(len(x), 2.0)
        cosine = x @ self.x[dim].T
        best = cosine.argmax(1)
        return self.of[dim][best], _distance(cosine[np.arange(len(x)), best])

    def pairs(self, radius: np.ndarray, least: float) -> tuple[list[np.ndarray], list[tuple[int, int]], list[tuple[int, int]]]:
        """Dual traversal down to cells: (cells in depth-first order, by length;
        live pairs; pairs linked as a whole), given the cells' covering radii
        (negative: an empty cell)."""
        reach = float(np.sqrt(2 - 2 * least))
        order, live, whole = [], [], []
        for d, cells in self.of.items():
            x = self.x[d]
            groups = [[np.arange(len(x))]]
            for r in UPPER:
                groups.append([h for g in groups[-1] for h in (net(x, g, r) if len(g) > 1 else [g])])
            groups.append([np.array([i]) for g in groups[-1] for i in g])
            flat = np.concatenate(groups[-1])
            order.append(cells[flat])
            x, r = x[flat], radius[cells[flat]]
            i = j = np.zeros(1, np.int64)
            upper = None
            for level in groups:
                size = np.array([len(g) for g in level])
                end = np.cumsum(size)
                start = end - size
                if upper is not None:  # children of the pairs above, each unordered pair once
                    first, stop = np.searchsorted(start, upper[0]), np.searchsorted(start, upper[1])
                    na, nb = (stop - first)[i], (stop - first)[j]
                    own = np.repeat(np.arange(len(i)), na * nb)
                    k = np.arange(len(own)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
                    ni, nj = first[i][own] + k // nb[own], first[j][own] + k % nb[own]
                    keep = nj >= ni
                    i, j = ni[keep], nj[keep]
                far = np.where(r >= 0, _distance(np.einsum("ij,ij->i", x, x[np.repeat(start, size)])) + r, -1.0)
                cover = np.maximum.reduceat(far, start)
                d_ = np.concatenate([_distance(np.einsum("ij,ij->i", x[start[i[s:s + 65536]]], x[start[j[s:s + 65536]]])) for s in range(0, len(i), 65536)] or [np.empty(0)])
                d_ = np.where(i == j, 0, d_)
                keep = (cover[i] >= 0) & (cover[j] >= 0) & (d_ <= cover[i] + cover[j] + reach + SLACK)
                i, j, d_ = i[keep], j[keep], d_[keep]
                upper = (start, end)
            sure = d_ + r[i] + r[j] <= reach - SLACK
            a, b = cells[flat[i]], cells[flat[j]]
            whole += list(zip(a[sure].tolist(), b[sure].tolist()))
            live += list(zip(a[~sure].tolist(), b[~sure].tolist()))
        return order, live, whole


class Layout:
    """Which blocks hold a cell's vectors, and which blocks each cell meets."""

    def __init__(self, order: list[np.ndarray], live: list[tuple[int, int]], whole: list[tuple[int, int]],
                 rows: dict[int, int], dims: dict[int, int], block_bytes: int):
        size = 1 + max(rows, default=0)
        self.whole = np.zeros((max(size, 0), max(size, 0)), bool)
        for a, b in whole:
            self.whole[a, b] = self.whole[b, a] = True
        self.first: dict[int, int] = {}
        self.blocks: dict[int, int] = {}
        n = 0
        runs = [*(o.tolist() for o in order), *([c] for c in rows if c < 0)]
        for run in runs:
            held = 0
            for c in run:
                if not rows.get(c):
                    continue
                most = max(256, block_bytes // (8 * dims[c]))
                if held and held + rows[c] > most:
                    n, held = n + 1, 0
                self.first[c] = n
                self.blocks[c] = -(-rows[c] // most)
                if self.blocks[c] > 1:
                    n, held = n + self.blocks[c], 0
                else:
                    held += rows[c]
            n += 1 if held else 0
        self.meets: dict[int, list[int]] = {}
        for a, b in live:
            self.meets.setdefault(a, []).append(b)
            if a != b:
                self.meets.setdefault(b, []).append(a)
        self._partners: dict[int, np.ndarray] = {}

    def partners(self, cell: int) -> np.ndarray:
        """Blocks that hold a cell which this cell's vectors must be compared with."""
        if cell not in self._partners:
            spans = {(self.first[c], self.blocks[c]) for c in self.meets.get(cell, ())}
            self._partners[cell] = np.unique(np.concatenate([np.arange(f, f + k) for f, k in spans])) if spans else np.empty(0, np.int64)
        return self._partners[cell]


# -- the whole table ---------------------------------------------------------

def _cells(nodes: DataFrame, upper: Upper) -> DataFrame:
    """Add each direction's cell and its distance from the cell's centre."""
    shared = nodes.sparkSession.sparkContext.broadcast(upper)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidied(batches):
            dims = batch.column(2).to_numpy()
            units = batch.column(3).to_pylist()
            cell, far = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                cell[rows], far[rows] = shared.value.cell(d, _matrix([units[r] for r in rows], d))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["key", "n", "dim", "unit", "cell", "far"])

    return nodes.select("key", "n", "dim", "unit").mapInArrow(assign, "key binary, n long, dim int, unit binary, cell long, far double")


def _meetings(placed: DataFrame, layout: Layout) -> DataFrame:
    """One row per direction and pair of blocks (lo, hi) that it takes part in."""
    shared = placed.sparkSession.sparkContext.broadcast(layout)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in tidied(batches):
            cells = batch.column(4).to_pylist()
            salt = np.frombuffer(b"".join(k[:8] for k in batch.column(0).to_pylist()), np.uint64)
            block = np.array([own.first[c] + int(s) % own.blocks[c] for c, s in zip(cells, salt.tolist())], np.int64)
            with_ = [own.partners(c) for c in cells]
            row = np.repeat(np.arange(len(cells)), [len(w) for w in with_])
            other = np.concatenate(with_) if with_ else np.empty(0, np.int64)
            for k in range(0, len(row), 4096):
                r, o = row[k:k + 4096], other[k:k + 4096]
                rows = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(block[r], o)), pa.array(np.maximum(block[r], o)), pa.array(block[r]),
                     *(batch.column(i).take(rows) for i in range(5))], names=["lo", "hi", "block", "key", "n", "dim", "unit", "cell"])

    return (placed.select("key", "n", "dim", "unit", "cell")
            .mapInArrow(send, "lo long, hi long, block long, key binary, n long, dim int, unit binary, cell long"))


def _compared(batches: Iterator[pa.RecordBatch], least: float, whole: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Traverse the trees of each pair of blocks; rows come sorted by (lo, hi)."""
    def compare(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
        block, cell, n = t["block"].to_numpy(), t["cell"].to_numpy(), t["n"].to_numpy()
        dim, keys = t["dim"][0].as_py(), t["key"].to_pylist()
        x = _matrix(t["unit"].to_pylist(), dim)
        trees, at = [], []
        for b in dict.fromkeys((lo, hi)):
            rows = np.flatnonzero(block == b)
            if not len(rows):
                return pa.RecordBatch.from_arrays([pa.array([], k) for k in _LINK.types], schema=_LINK)
            rows = rows[np.argsort(cell[rows], kind="stable")]
            cut = np.flatnonzero(np.diff(cell[rows])) + 1
            tree = Tree(x[rows], np.split(np.arange(len(rows)), cut))
            trees.append(tree)
            at.append(rows[tree.order])
        weights = [n[r] for r in at]
        done = None if cell[0] < 0 else (cell[at[0]], cell[at[-1]], whole)
        links, label = traverse(trees[0], trees[-1], weights[0], weights[-1], least, done)
        at = np.concatenate(at)
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in at[some]], pa.binary()), pa.array(links[some], pa.int64()),
             pa.array([keys[i] for i in at[label[some]]], pa.binary())], schema=_LINK)

    held: list[pa.RecordBatch] = []
    for batch in tidied(batches):
        if not batch.num_rows:
            continue
        pair = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
        cut = [0, *(np.flatnonzero((pair[1:] != pair[:-1]).any(1)) + 1).tolist(), len(pair)]
        for a, b in zip(cut, cut[1:]):
            part = batch.slice(a, b - a)
            if held and (held[0].column(0)[0], held[0].column(1)[0]) != (part.column(0)[0], part.column(1)[0]):
                yield compare(held)
                held = []
            held.append(part)
    if held:
        yield compare(held)


_LINK = pa.schema([("key", pa.binary()), ("weight", pa.int64()), ("root", pa.binary())])


def near_vectors(df: DataFrame, least: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding",
                 sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``df``: (vec_id, n_links, component_id, kept)."""
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies in (0, 1]")
    spark = df.sparkSession
    rows = saved(spark, unit_vectors(df, vec_id, vector), "units")
    nodes = (rows.filter("key is not null").groupBy("key")
             .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("unit").alias("unit")))
    nodes = saved(spark, nodes, "directions")
    # Digests are as good as random: about twice the sample's rows leave the tasks.
    upto = int(min(2 ** 63 - 1, -2 ** 63 + min(1.0, 2 * sample / max(1, nodes.count())) * 2 ** 64))
    few = nodes.select("key", "dim", "unit").filter(F.xxhash64("key") <= F.lit(upto)).orderBy("key").limit(sample).collect()
    upper = Upper([r["dim"] for r in few], [bytes(r["unit"]) for r in few])
    placed = saved(spark, _cells(nodes, upper), "cells")
    # At most one row a sampled direction, and one a length that was not sampled.
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.max("far").alias("far"), F.min("key").alias("key"), F.min("dim").alias("dim")).collect()}
    radius = np.array([cells[c]["far"] if c in cells else -1.0 for c in range(len(few))])
    order, live, whole = upper.pairs(radius, least)
    live += [(c, c) for c in cells if c < 0]
    layout = Layout(order, live, whole, {c: r["rows"] for c, r in cells.items()}, {c: r["dim"] for c, r in cells.items()}, block_bytes)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = _meetings(placed, layout).repartition(n, "lo", "hi").sortWithinPartitions("lo", "hi")
    done = spark.sparkContext.broadcast(layout.whole)  # a bit a pair of cells
    links = met.mapInArrow(lambda batches: _compared(batches, least, done.value), "key binary, weight long, root binary")
    if whole:
        links = links.unionByName(_whole_cells(spark, placed, cells, whole))
    links = saved(spark, links, "links")

    roots = components(spark, links.select(F.col("key").alias("u"), F.col("root").alias("v")))
    every = saved(spark, roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
    low = nodes.select("key", "low", "n")
    joined = every.join(low, F.col("node") == F.col("key"))
    named = joined.select("key", "root").join(joined.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("key", "component_id")
    counted = links.groupBy("key").agg(F.sum("weight").alias("weight"))
    of_key = (low.join(counted, "key", "left").join(named, "key", "left")
              .select("key", (F.coalesce("weight", "n") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")))
    of_key = saved(spark, of_key, "of-directions")
    linked = rows.filter("key is not null").select("vec_id", "key").join(broadcast_if_small(of_key), "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _whole_cells(spark: SparkSession, placed: DataFrame, cells: dict, whole: list[tuple[int, int]]) -> DataFrame:
    """Links of cells that lie within the threshold of each other (or of
    themselves) as a whole: weights to add and a star for each row."""
    at = {c: i for i, c in enumerate(sorted({c for p in whole for c in p}))}
    label = np.arange(len(at))
    a, b = (np.array([at[p[i]] for p in whole]) for i in (0, 1))
    unite(label, a, b)
    gain = dict.fromkeys(at, 0)
    for x, y in whole:
        gain[x] += cells[y]["n"]
        if x != y:
            gain[y] += cells[x]["n"]
    # A star's centre is the smallest key of the cell with the component's label.
    back = list(at)
    table = [(c, gain[c], bytes(cells[back[label[i]]]["key"])) for c, i in at.items()]
    few = spark.createDataFrame(table, "cell long, weight long, root binary")
    return placed.select("key", "cell").join(F.broadcast(few), "cell").select("key", "weight", "root")


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


#: All pairs, and the closure of their links.
OP12_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= {COSINE}),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
lows AS (SELECT a, min(b) AS low FROM reached GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN counted c ON vec_id = c.a LEFT JOIN lows l ON vec_id = l.a
"""
