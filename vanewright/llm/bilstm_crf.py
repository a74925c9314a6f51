"""A character-level bidirectional LSTM with CRF transitions, trained and run in numpy.

All arrays are time-major: (time, batch, ...). Masks are 1 on real characters; padding stands at the end.
"""

from __future__ import annotations

import numpy as np


def _gate(x: np.ndarray) -> np.ndarray:
    """The sigmoid's straight form: no exponentials, which were most of the cost of a character."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (T, N, H). Padding passes the state through unchanged."""
    steps, n, _ = x.shape
    size = u.shape[0]
    given = x @ w + b
    h, c = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
    out, memory = np.empty((steps, n, size), x.dtype), []
    for t in range(steps):
        z = given[t] + h @ u
        i, f, o = (_gate(z[:, k * size : (k + 1) * size]) for k in range(3))
        g = np.clip(z[:, 3 * size :], -1, 1)
        m = mask[t][:, None]
        new = f * c + i * g
        soft = _soft(new)
        if keep:
            memory.append((h, c, i, f, o, g, soft, m))
        c = m * new + (1 - m) * c
        h = m * (o * soft) + (1 - m) * h
        out[t] = h
    return (out, memory) if keep else out


def lstm_back(grad: np.ndarray, x: np.ndarray, memory: list, w: np.ndarray, u: np.ndarray):
    """Gradients of (x, w, u, b) from those of the hidden states."""
    steps, n, size = grad.shape
    dz_all = np.empty((steps, n, 4 * size), grad.dtype)
    du = np.zeros_like(u)
    dh, dc = np.zeros((n, size), grad.dtype), np.zeros((n, size), grad.dtype)
    slope = lambda x: 0.25 * ((x > 0) & (x < 1))
    for t in range(steps - 1, -1, -1):
        h0, c0, i, f, o, g, soft, m = memory[t]
        dh = dh + grad[t]
        through = m * dh
        dnew = m * dc + through * o * (1 - np.abs(soft)) ** 2
        dz = np.concatenate([dnew * g * slope(i), dnew * c0 * slope(f), through * soft * slope(o), dnew * i * (np.abs(g) < 1)], axis=1)
        dz_all[t] = dz
        du += h0.T @ dz
        dh = (1 - m) * dh + dz @ u.T
        dc = (1 - m) * dc + dnew * f
    flat = dz_all.reshape(-1, 4 * size)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf(e: np.ndarray, mask: np.ndarray, tags: np.ndarray, trans: np.ndarray):
    """Mean negative log-likelihood of the tags, and the gradients of emissions and transitions."""
    steps, n, k = e.shape
    alpha = np.empty_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        m = mask[t][:, None]
        step = _logsumexp(alpha[t - 1][:, :, None] + trans[None], 1) + e[t]
        alpha[t] = m * step + (1 - m) * alpha[t - 1]
    total = _logsumexp(alpha[-1], 1)
    beta = np.zeros_like(e)
    for t in range(steps - 2, -1, -1):
        m = mask[t + 1][:, None]
        step = _logsumexp(trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = m * step + (1 - m) * beta[t + 1]
    rows = np.arange(n)
    gold = e[0, rows, tags[0]].copy()
    de = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
    dtrans = np.zeros_like(trans)
    de[0, rows, tags[0]] -= mask[0]
    for t in range(1, steps):
        m = mask[t]
        gold += m * (e[t, rows, tags[t]] + trans[tags[t - 1], tags[t]])
        pair = np.exp(alpha[t - 1][:, :, None] + trans[None] + (e[t] + beta[t])[:, None, :] - total[:, None, None])
        dtrans += (pair * m[:, None, None]).sum(axis=0)
        np.add.at(dtrans, (tags[t - 1], tags[t]), -m)
        de[t, rows, tags[t]] -= m
    return float((total - gold).mean()), de / n, dtrans / n


def viterbi(e: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The likeliest tags (T, N)."""
    steps, n, k = e.shape
    score, back = e[0].copy(), np.zeros((steps, n, k), np.int8)
    for t in range(1, steps):
        every = score[:, :, None] + trans[None]
        back[t] = every.argmax(axis=1)
        m = mask[t][:, None]
        score = m * (every.max(axis=1) + e[t]) + (1 - m) * score
    out = np.zeros((steps, n), np.int8)
    tag = score.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, -1, -1):
        out[t] = tag
        if t:
            tag = np.where(mask[t] > 0, back[t, rows, tag], tag)
    return out


def _reversed(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each sequence backwards, padding still at the end."""
    size = mask.sum(axis=0).astype(int)
    t = np.arange(x.shape[0])[:, None]
    at = np.where(t < size, size - 1 - t, t)
    return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), axis=0)


class Tagger:
    def __init__(self, symbols: int, tags: int, embed: int = 12, hidden: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        shape = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"embed": shape(symbols, embed) * np.float32(np.sqrt(symbols) * 0.5), "out": shape(2 * hidden, tags), "bias": np.zeros(tags, np.float32), "trans": np.zeros((tags, tags), np.float32)}
        for d in "lr":
            b = np.zeros(4 * hidden, np.float32)
            b[hidden : 2 * hidden] = 1
            self.p |= {f"w{d}": shape(embed, 4 * hidden), f"u{d}": shape(hidden, 4 * hidden), f"b{d}": b}

    def emissions(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        p, x = self.p, self.p["embed"][codes]
        left = lstm(x, mask, p["wl"], p["ul"], p["bl"])
        right = _reversed(lstm(_reversed(x, mask), mask, p["wr"], p["ur"], p["br"]), mask)
        return np.concatenate([left, right], axis=2) @ p["out"] + p["bias"]

    def ready(self) -> Tagger:
        """Prepare ``fast``: one matrix a direction from (state, symbol's embedding, 1) to the gates, scales folded in. The
        candidate is brought to 0..1 as well, so that one pair of bounds does for all rows."""
        size = self.p["ul"].shape[0]
        scale = np.repeat(np.array([0.25, 0.5], np.float32), [3 * size, size])
        self.gates = [np.ascontiguousarray((np.vstack([self.p[f"u{d}"], self.p[f"w{d}"], self.p[f"b{d}"][None]]) * scale).T) for d in "lr"]
        for w in self.gates:
            w[:, -1] += 0.5
        self.symbols, self.emit = np.ascontiguousarray(self.p["embed"].T), np.ascontiguousarray(self.p["out"].T)
        return self

    def fast(self, codes: np.ndarray) -> np.ndarray:
        """The emissions (T, N, tags) of ``emissions`` for codes (T, N) whose padding 0 stands at the end, for inference.

        Arrays are (features, N), so that each gate is one block of memory.
        """
        steps, n = codes.shape
        size, width = self.p["ul"].shape[0], len(self.symbols)
        both = np.empty((steps, 2 * size, n), np.float32)
        padded = (codes == 0).any(axis=1)
        z, zero, one = np.empty((4 * size, n), np.float32), np.zeros((4 * size, n), np.float32), np.ones((4 * size, n), np.float32)
        c, soft = np.empty((size, n), np.float32), np.empty((size, n), np.float32)  # c is half the cell
        i, f, o, g = (z[k * size : (k + 1) * size] for k in range(4))
        given = np.empty((size + width + 1, n), np.float32)
        h, symbol = given[:size], given[size:-1]
        given[-1] = 1
        for d, w in enumerate(self.gates):
            h[:] = c[:] = 0
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                np.take(self.symbols, codes[t], axis=1, out=symbol, mode="clip")
                np.matmul(w, given, out=z)
                np.maximum(z, zero, out=z)  # bounds as arrays: several times faster than scalars
                np.minimum(z, one, out=z)
                g -= 0.5
                g *= i
                c *= f
                c += g
                if d and padded[t]:  # from the right, padding comes first: nothing is known yet
                    c *= codes[t] > 0
                np.abs(c, out=soft)
                soft += 0.5
                np.divide(c, soft, out=h)
                h *= o
                both[t, d * size : (d + 1) * size] = h
        out = np.matmul(self.emit, both).transpose(0, 2, 1)
        out += self.p["bias"]
        return out

    def margin(self) -> float:
        """By how much tag 0 must lead a position's emissions so that every best path has it there, whatever stands beside."""
        trans = self.p["trans"]
        gain = (trans[:, 1:] - trans[:, :1]).max(axis=0) + (trans[1:] - trans[:1]).max(axis=1)
        return float(max(0.0, (trans[:, 1:] - trans[:, :1]).max(), (trans[1:] - trans[:1]).max(), gain.max()))

    def bounds(self) -> tuple[float, float, float]:
        """The most that transitions give a stretch of other tags over tag 0: on entering, at each further place, on leaving."""
        trans = self.p["trans"] - self.p["trans"][0, 0]
        return float(trans[0, 1:].max()), float(trans[1:, 1:].max()), float(trans[1:, 0].max())

    def loss(self, codes: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, x = self.p, self.p["embed"][codes]
        back = _reversed(x, mask)
        left, ml = lstm(x, mask, p["wl"], p["ul"], p["bl"], keep=True)
        right, mr = lstm(back, mask, p["wr"], p["ur"], p["br"], keep=True)
        both = np.concatenate([left, _reversed(right, mask)], axis=2)
        value, de, dtrans = crf(both @ p["out"] + p["bias"], mask, tags, p["trans"])
        flat = de.reshape(-1, de.shape[2])
        g = {"trans": dtrans, "out": both.reshape(-1, both.shape[2]).T @ flat, "bias": flat.sum(axis=0)}
        dboth = de @ p["out"].T
        size = left.shape[2]
        dx, g["wl"], g["ul"], g["bl"] = lstm_back(dboth[:, :, :size], x, ml, p["wl"], p["ul"])
        dback, g["wr"], g["ur"], g["br"] = lstm_back(_reversed(dboth[:, :, size:], mask), back, mr, p["wr"], p["ur"])
        dx = dx + _reversed(dback, mask)
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], codes.ravel(), dx.reshape(-1, dx.shape[2]))
        return value, g

    def fit(self, codes: np.ndarray, mask: np.ndarray, tags: np.ndarray, steps: int = 320, batch: int = 64, rate: float = 0.02, seed: int = 6) -> list[float]:
        """Adam with clipped gradients over random batches; returns the losses."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for t in range(1, steps + 1):
            at = rng.choice(codes.shape[1], min(batch, codes.shape[1]), replace=False)
            value, g = self.loss(codes[:, at], mask[:, at], tags[:, at])
            losses.append(value)
            norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
            scale = min(1.0, 5.0 / max(norm, 1e-9))
            for k, x in g.items():
                x = x * scale
                first[k] = 0.9 * first[k] + 0.1 * x
                second[k] = 0.99 * second[k] + 0.01 * x * x
                step = rate * (0.1 + 0.9 * (1 - t / steps))
                self.p[k] = (self.p[k] - step * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)).astype(self.p[k].dtype)
        return losses
