"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Trained by Adam on labelled windows; used by ``pii.py``.  All arrays are
(windows, characters, ...); padding is its own character and is labelled O.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
EMBED, HIDDEN = 10, 16
VOCAB = 132  # padding, ASCII, other letters, other digits, other
_NEVER = -1e4


def char_ids(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, the rest by kind."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ids = code + 1
    for i in np.flatnonzero(code >= 128).tolist():
        ids[i] = 129 if text[i].isalpha() else 130 if text[i].isdigit() else 131
    return ids


def allowed() -> np.ndarray:
    """Transition mask: inside a kind only after its begin or inside."""
    ok = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = _NEVER
        ok[1 + 2 * k, 2 + 2 * k] = ok[2 + 2 * k, 2 + 2 * k] = 0
    return ok


def allowed_start() -> np.ndarray:
    return np.array([0.0] + [0.0, _NEVER] * len(KINDS))


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"emb": r.normal(0, 0.3, (VOCAB, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS),
         "trans": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}
    for d in ("f", "b"):
        p |= {f"{d}x": r.normal(0, 0.3, (EMBED, 4 * HIDDEN)), f"{d}h": r.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)), f"{d}c": np.zeros(4 * HIDDEN)}
        p[f"{d}c"][HIDDEN:2 * HIDDEN] = 1  # remember at first
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, c0: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (windows, characters, HIDDEN), read left to right."""
    n, t, _ = x.shape
    z_in = x @ wx + c0
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.empty((n, t, HIDDEN), np.float32)
    for k in range(t):
        z = z_in[:, k] + h @ wh
        s = _sig(z[:, :3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        was_c, was_h = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, k] = h
        if keep is not None:
            keep.append((i, f, o, g, was_c, was_h, tc))
    return out


def _lstm_back(dout: np.ndarray, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: list) -> tuple[np.ndarray, ...]:
    n, t, _ = x.shape
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    dz_all = np.empty((n, t, 4 * HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    for k in range(t - 1, -1, -1):
        i, f, o, g, was_c, was_h, tc = keep[k]
        dh = dh + dout[:, k]
        dc = dc + dh * o * (1 - tc * tc)
        dz = dz_all[:, k]
        dz[:, :HIDDEN] = dc * g * i * (1 - i)
        dz[:, HIDDEN:2 * HIDDEN] = dc * was_c * f * (1 - f)
        dz[:, 2 * HIDDEN:3 * HIDDEN] = dh * tc * o * (1 - o)
        dz[:, 3 * HIDDEN:] = dc * i * (1 - g * g)
        dwh += was_h.T @ dz
        dh, dc = dz @ wh.T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dz_all @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(0)


def emissions(p: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Tag scores (windows, characters, TAGS) before the CRF."""
    x = p["emb"][ids]
    fwd = _lstm(x, p["fx"], p["fh"], p["fc"])
    bwd = _lstm(x[:, ::-1], p["bx"], p["bh"], p["bc"])[:, ::-1]
    return np.concatenate([fwd, bwd], 2) @ p["out"] + p["out_b"]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_gradients(p: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the tags and its gradients."""
    n, t = ids.shape
    x = p["emb"][ids]
    kf: list = []
    kb: list = []
    fwd = _lstm(x, p["fx"], p["fh"], p["fc"], kf)
    bwd = _lstm(x[:, ::-1], p["bx"], p["bh"], p["bc"], kb)
    hidden = np.concatenate([fwd, bwd[:, ::-1]], 2)
    em = (hidden @ p["out"] + p["out_b"]).astype(np.float64)
    tr, st = p["trans"] + allowed(), p["start"] + allowed_start()
    a, b = np.empty((n, t, TAGS)), np.zeros((n, t, TAGS))
    a[:, 0] = st + em[:, 0]
    for k in range(1, t):
        a[:, k] = _lse(a[:, k - 1][:, :, None] + tr, 1) + em[:, k]
    for k in range(t - 2, -1, -1):
        b[:, k] = _lse(tr + (em[:, k + 1] + b[:, k + 1])[:, None, :], 2)
    z = _lse(a[:, -1], 1)
    dem = np.exp(a + b - z[:, None, None])
    dtr = np.zeros((TAGS, TAGS))
    for k in range(1, t):
        dtr += np.exp(a[:, k - 1][:, :, None] + tr + (em[:, k] + b[:, k])[:, None, :] - z[:, None, None]).sum(0)
    rows = np.arange(n)[:, None]
    gold = st[tags[:, 0]] + em[rows, np.arange(t), tags].sum(1) + tr[tags[:, :-1], tags[:, 1:]].sum(1)
    dst = dem[:, 0].sum(0)
    np.subtract.at(dst, tags[:, 0], 1)
    np.subtract.at(dtr, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    dem[rows, np.arange(t), tags] -= 1
    dem = (dem / n).astype(np.float32)
    g = {"trans": dtr / n, "start": dst / n, "out": hidden.reshape(-1, 2 * HIDDEN).T @ dem.reshape(-1, TAGS), "out_b": dem.reshape(-1, TAGS).sum(0)}
    dh = dem @ p["out"].T
    dx, g["fx"], g["fh"], g["fc"] = _lstm_back(dh[:, :, :HIDDEN], x, p["fx"], p["fh"], kf)
    dxb, g["bx"], g["bh"], g["bc"] = _lstm_back(dh[:, ::-1, HIDDEN:], x[:, ::-1], p["bx"], p["bh"], kb)
    g["emb"] = np.zeros_like(p["emb"])
    np.add.at(g["emb"], ids, dx + dxb[:, ::-1])
    return float((z - gold).mean()), g


def train(ids: np.ndarray, tags: np.ndarray, epochs: int = 14, batch: int = 32, rate: float = 0.015, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters fitted to labelled windows (ids and tags alike in shape)."""
    p, r = new_parameters(seed), np.random.default_rng(seed)
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for epoch in range(epochs):
        order = r.permutation(len(ids))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            _, g = loss_and_gradients(p, ids[pick], tags[pick])
            size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            step += 1
            for name, x in g.items():
                x = (x * min(1.0, 5 / (size + 1e-9))).astype(np.float32)
                m[name] = 0.9 * m[name] + 0.1 * x
                v[name] = 0.999 * v[name] + 0.001 * x * x
                p[name] = p[name] - rate / (1 + epoch / 2) * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


def best_tags(p: dict[str, np.ndarray], em: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Viterbi over padded segments (segments, characters, TAGS)."""
    n, t, _ = em.shape
    tr, st = p["trans"] + allowed(), p["start"] + allowed_start()
    score, back = st + em[:, 0], np.zeros((n, t, TAGS), np.int8)
    done = score.copy()
    for k in range(1, t):
        step = score[:, :, None] + tr
        back[:, k] = step.argmax(1)
        score = step.max(1) + em[:, k]
        done = np.where((size > k)[:, None], score, done)
    out = np.zeros((n, t), np.int64)
    now = done.argmax(1)
    for k in range(t - 1, -1, -1):
        here = size > k
        out[:, k] = np.where(here, now, 0)
        if k:
            now = np.where(here, back[np.arange(n), k, now], now)
    return out
