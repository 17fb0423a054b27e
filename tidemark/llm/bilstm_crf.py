"""A character-level bidirectional LSTM with CRF transitions in numpy.

Batches are (time, row) arrays of character classes; every row of a batch has
the same length, padded with class 0.  Training is Adam on the CRF's negative
log-likelihood with gradients through time; decoding is Viterbi.
"""

from __future__ import annotations

import numpy as np

CLASSES = 132


def char_classes(text: str) -> np.ndarray:
    """ASCII characters have a class each (1 to 128); other digits, letters and the rest share three."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(points < 128, points + 1, 129).astype(np.int64)
    for i in np.flatnonzero(points >= 128):
        c = chr(points[i])
        out[i] = 131 if c.isdigit() else 130 if c.isalpha() else 129
    return out


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiLstmCrf:
    def __init__(self, tags: int, embed: int = 12, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.tags, self.hidden = tags, hidden
        self.p = {"E": init(CLASSES, embed), "T": np.zeros((tags, tags), np.float32), "O": init(2 * hidden, tags), "b": np.zeros(tags, np.float32)}
        for d in "fb":
            self.p["W" + d], self.p["U" + d] = init(embed, 4 * hidden), init(hidden, 4 * hidden)
            self.p["c" + d] = np.zeros(4 * hidden, np.float32)
            self.p["c" + d][hidden:2 * hidden] = 1       # open forget gates

    def _run(self, x, d, keep):
        h_n, (steps, rows) = self.hidden, x.shape
        gates = self.p["E"][x] @ self.p["W" + d] + self.p["c" + d]
        h, c = np.zeros((rows, h_n), np.float32), np.zeros((rows, h_n), np.float32)
        hs, saved, u = np.empty((steps, rows, h_n), np.float32), [], self.p["U" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ u
            a = _sigmoid(z[:, :3 * h_n])
            g = np.tanh(z[:, 3 * h_n:])
            c_new = a[:, h_n:2 * h_n] * c + a[:, :h_n] * g
            tc = np.tanh(c_new)
            if keep:
                saved.append((t, h, c, a, g, tc))
            h, c = a[:, 2 * h_n:] * tc, c_new
            hs[t] = h
        return hs, saved

    def emissions(self, x: np.ndarray, keep: bool = False):
        """(time, row, tag) scores of a (time, row) batch."""
        f, sf = self._run(x, "f", keep)
        b, sb = self._run(x, "b", keep)
        both = np.concatenate([f, b], 2)
        e = both @ self.p["O"] + self.p["b"]
        return (e, both, sf, sb) if keep else e

    def _crf(self, e, y):
        """Loss and its gradients by emissions and transitions (forward-backward)."""
        steps, rows, k = e.shape
        t_ = self.p["T"]
        lse = lambda v, ax: (m := v.max(ax, keepdims=True)).squeeze(ax) + np.log(np.exp(v - m).sum(ax))
        al, be = np.empty_like(e), np.zeros_like(e)
        al[0] = e[0]
        for t in range(1, steps):
            al[t] = lse(al[t - 1][:, :, None] + t_, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            be[t] = lse(t_[None] + (e[t + 1] + be[t + 1])[:, None, :], 2)
        z = lse(al[-1], 1)
        ge = np.exp(al + be - z[None, :, None])
        r = np.arange(rows)
        gold = e[np.arange(steps)[:, None], r[None], y].sum(0) + t_[y[:-1], y[1:]].sum(0)
        pair = np.exp(al[:-1, :, :, None] + t_ + (e[1:] + be[1:])[:, :, None, :] - z[None, :, None, None]).sum((0, 1))
        np.add.at(pair, (y[:-1].ravel(), y[1:].ravel()), -1)
        ge[np.arange(steps)[:, None], r[None], y] -= 1
        return float((z - gold).mean()), ge / rows, pair / rows

    def _back(self, x, d, saved, gh, grads):
        n, u = self.hidden, self.p["U" + d]
        dh, dc = np.zeros_like(gh[0]), np.zeros_like(gh[0])
        dz_all = np.zeros((*x.shape, 4 * n), np.float32)
        for t, h, c, a, g, tc in reversed(saved):
            dh = dh + gh[t]
            i, f, o = a[:, :n], a[:, n:2 * n], a[:, 2 * n:]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            grads["U" + d] += h.T @ dz
            dz_all[t] = dz
            dh, dc = dz @ u.T, dc * f
        flat = dz_all.reshape(-1, 4 * n)
        grads["c" + d] += flat.sum(0)
        grads["W" + d] += self.p["E"][x].reshape(-1, self.p["E"].shape[1]).T @ flat
        np.add.at(grads["E"], x.ravel(), flat @ self.p["W" + d].T)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> float:
        """Train on (time, row) classes and tags; returns the last epoch's mean loss."""
        r, m, v, step, loss = np.random.default_rng(seed), {}, {}, 0, 0.0
        for epoch in range(epochs):
            order, total = r.permutation(x.shape[1]), []
            for i in range(0, len(order), batch):
                bx, by = x[:, order[i:i + batch]], y[:, order[i:i + batch]]
                e, both, sf, sb = self.emissions(bx, keep=True)
                loss, ge, gt = self._crf(e, by)
                total.append(loss)
                grads = {k: np.zeros_like(w) for k, w in self.p.items()}
                grads["T"] += gt
                flat = ge.reshape(-1, self.tags)
                grads["O"] += both.reshape(-1, both.shape[2]).T @ flat
                grads["b"] += flat.sum(0)
                gb = (flat @ self.p["O"].T).reshape(both.shape)
                self._back(bx, "f", sf, gb[:, :, :self.hidden], grads)
                self._back(bx, "b", sb, gb[:, :, self.hidden:], grads)
                step += 1
                scale = min(1.0, 5 / (np.sqrt(sum(float((g * g).sum()) for g in grads.values())) + 1e-9))
                for k, g in grads.items():
                    g = g * scale
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.999 * v.get(k, 0) + 0.001 * g * g
                    now = rate * (0.3 if epoch >= epochs * 2 // 3 else 1)
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            loss = float(np.mean(total))
        return loss

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Best tag path of each row: (time, row)."""
        steps, rows, _ = e.shape
        best, via = e[0], np.empty(e.shape, np.int8)
        for t in range(1, steps):
            s = best[:, :, None] + self.p["T"]
            via[t] = s.argmax(1)
            best = s.max(1) + e[t]
        out, r = np.empty((steps, rows), np.int64), np.arange(rows)
        out[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = via[t][r, out[t]]
        return out
