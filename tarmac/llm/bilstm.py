"""A small character-level bidirectional LSTM with a CRF on top, in numpy.

Sequences are rows of symbol ids of one length. The input layer is a table per
direction (symbol -> gate inputs), the output layer scores tags per character, and a
linear-chain CRF scores tag sequences. Training is maximum likelihood with hand-written
gradients and Adam, from a fixed seed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Params = dict[str, np.ndarray]


@dataclass
class Tagger:
    params: Params
    allowed: np.ndarray  # tags x tags: which tag may follow which
    start: np.ndarray    # which tag may come first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _lstm(x: np.ndarray, table: np.ndarray, rec: np.ndarray):
    """States over time of x (time, rows); keeps what the backward pass needs."""
    steps, rows = x.shape
    size = rec.shape[0]
    h, c = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
    hs, cache = np.empty((steps, rows, size), np.float32), []
    for t in range(steps):
        z = table[x[t]] + h @ rec
        gates = _sigmoid(z[:, :3 * size])
        i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
        g = np.tanh(z[:, 3 * size:])
        before = (h, c)
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[t] = h
        cache.append((i, f, o, g, tc, before))
    return hs, cache


def _lstm_back(x, rec, cache, dhs, vocab):
    size = rec.shape[0]
    d_z = np.empty((*x.shape, 4 * size), np.float32)
    d_rec = np.zeros_like(rec)
    dh = np.zeros_like(dhs[0])
    dc = np.zeros_like(dhs[0])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, tc, (h0, c0) = cache[t]
        dh = dh + dhs[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = d_z[t]
        dz[:, :size] = dc * g * i * (1 - i)
        dz[:, size:2 * size] = dc * c0 * f * (1 - f)
        dz[:, 2 * size:3 * size] = dh * tc * o * (1 - o)
        dz[:, 3 * size:] = dc * i * (1 - g * g)
        d_rec += h0.T @ dz
        dh, dc = dz @ rec.T, dc * f
    one_hot = np.zeros((x.size, vocab), np.float32)
    one_hot[np.arange(x.size), x.ravel()] = 1
    return one_hot.T @ d_z.reshape(x.size, -1), d_rec


def emissions(p: Params, x: np.ndarray):
    """(time, rows, tags) scores and the two directions' traces."""
    fwd = _lstm(x, p["table_f"], p["rec_f"])
    bwd = _lstm(x[::-1], p["table_b"], p["rec_b"])
    both = np.concatenate([fwd[0], bwd[0][::-1]], axis=2)
    return both @ p["out"] + p["bias"], both, fwd, bwd


def _crf_gradient(e: np.ndarray, trans: np.ndarray, first: np.ndarray, y: np.ndarray):
    """Mean negative log-likelihood and its gradients (emissions, transitions)."""
    e = e.astype(np.float64)
    steps, rows, tags = e.shape
    arcs = np.exp(trans.astype(np.float64))  # scaled forward-backward in plain space
    top = e.max(axis=2, keepdims=True)
    unary = np.exp(e - top)
    alpha, scale = np.empty_like(e), np.empty((steps, rows))
    for t in range(steps):
        a = unary[t] * (alpha[t - 1] @ arcs if t else np.exp(first.astype(np.float64)))
        scale[t] = a.sum(axis=1)
        alpha[t] = a / scale[t][:, None]
    beta, inner = np.ones_like(e), np.empty_like(e)
    for t in range(steps - 1, -1, -1):
        inner[t] = unary[t] * beta[t] / scale[t][:, None]
        if t:
            beta[t - 1] = inner[t] @ arcs.T
    d_e = alpha * beta
    hit = np.zeros_like(e)
    np.put_along_axis(hit, y[:, :, None].astype(np.int64), 1, axis=2)
    d_e -= hit
    d_trans = arcs * (alpha[:-1].reshape(-1, tags).T @ inner[1:].reshape(-1, tags))
    seen = np.bincount(y[:-1].ravel().astype(np.int64) * tags + y[1:].ravel(), minlength=tags * tags)
    gold = (e * hit).sum() + (trans * seen.reshape(tags, tags)).sum()
    loss = np.log(scale).sum() + top.sum() - gold
    d_trans -= seen.reshape(tags, tags)
    return loss / rows, (d_e / rows).astype(np.float32), (d_trans / rows).astype(np.float32)


def _scores(p: Params, allowed: np.ndarray, start: np.ndarray):
    barred = np.float32(-1e4)
    return np.where(allowed, p["trans"], barred), np.where(start, np.float32(0), barred)


def fit(x: np.ndarray, y: np.ndarray, vocab: int, allowed: np.ndarray, start: np.ndarray,
        hidden: int, rounds: int, batch: int, rate: float = 0.02, seed: int = 1) -> Tagger:
    """Trains on rows of symbols ``x`` and tags ``y`` (rows, time)."""
    rng = np.random.default_rng(seed)
    tags = len(allowed)
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    p: Params = {"table_f": draw(vocab, 4 * hidden), "table_b": draw(vocab, 4 * hidden),
                 "rec_f": draw(hidden, 4 * hidden), "rec_b": draw(hidden, 4 * hidden),
                 "out": draw(2 * hidden, tags), "bias": np.zeros(tags, np.float32),
                 "trans": np.zeros((tags, tags), np.float32)}
    for name in ("table_f", "table_b"):
        p[name][:, hidden:2 * hidden] += 1  # remember by default
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, rounds + 1):
        rows = rng.integers(0, len(x), batch)
        xt, yt = x[rows].T, y[rows].T
        e, both, (_, cf), (_, cb) = emissions(p, xt)
        trans, first = _scores(p, allowed, start)
        _, d_e, d_trans = _crf_gradient(e, trans, first, yt)
        g = {"trans": np.where(allowed, d_trans, 0), "bias": d_e.sum(axis=(0, 1)),
             "out": both.reshape(-1, 2 * hidden).T @ d_e.reshape(-1, tags)}
        d_both = d_e @ p["out"].T
        g["table_f"], g["rec_f"] = _lstm_back(xt, p["rec_f"], cf, d_both[:, :, :hidden], vocab)
        g["table_b"], g["rec_b"] = _lstm_back(xt[::-1], p["rec_b"], cb, d_both[::-1, :, hidden:], vocab)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for k, v in g.items():
            v = v * min(1.0, 5 / max(norm, 1e-9))
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.999 * m2[k] + 0.001 * v * v
            p[k] = (p[k] - now * (m1[k] / (1 - 0.9 ** step))
                    / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Tagger(p, allowed, start)


def decode(tagger: Tagger, x: np.ndarray) -> np.ndarray:
    """Best tag sequence (Viterbi) of every row of ``x`` (rows, time)."""
    e = emissions(tagger.params, x.T)[0]
    trans, first = _scores(tagger.params, tagger.allowed, tagger.start)
    steps, rows, tags = e.shape
    score, back = e[0] + first, np.empty((steps, rows, tags), np.int8)
    for t in range(1, steps):
        arc = score[:, :, None] + trans
        back[t] = arc.argmax(axis=1)
        score = arc.max(axis=1) + e[t]
    out = np.empty((rows, steps), np.int8)
    tag = score.argmax(axis=1)
    out[:, -1] = tag
    for t in range(steps - 1, 0, -1):
        tag = back[t][np.arange(rows), tag]
        out[:, t - 1] = tag
    return out
