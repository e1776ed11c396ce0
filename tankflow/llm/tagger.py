"""A character-level bidirectional LSTM with a linear-chain CRF, in numpy.

Small on purpose: it runs inside Spark tasks over windows of fixed length. ``fit`` trains it from
windows with a tag for each character (back-propagation through time, the CRF's gradient from
forward-backward, Adam); ``decode`` gives the best tag sequence of each window (Viterbi).
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 133
PAD = 132


def symbols(text: str, length: int) -> np.ndarray:
    """Symbol of each character, padded to ``length``: ASCII as it is, other letters 128, digits
    129, blanks 130, the rest 131."""
    out = np.full(length, PAD, np.int16)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out[:len(raw)] = np.minimum(raw, 131)
    for i in np.flatnonzero(raw > 127).tolist():
        c = text[i]
        out[i] = 128 if c.isalpha() else 129 if c.isdigit() else 130 if c.isspace() else 131
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    def __init__(self, tags: int, embed: int = 12, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        u = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden:2 * hidden] = 1  # forget gates begin open
        self.p = {"emb": (0.5 * r.standard_normal((SYMBOLS, embed))).astype(np.float32),
                  "xf": u(embed, 4 * hidden), "hf": u(hidden, 4 * hidden), "bf": bias.copy(),
                  "xb": u(embed, 4 * hidden), "hb": u(hidden, 4 * hidden), "bb": bias.copy(),
                  "out": u(2 * hidden, tags), "ob": np.zeros(tags, np.float32),
                  "trans": np.zeros((tags, tags), np.float32), "start": np.zeros(tags, np.float32)}

    # -- network ----------------------------------------------------------------------------

    def _direction(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states [length, batch, hidden] of one direction; x is [length, batch]."""
        p, n = self.p, self.hidden
        gates_of = p["emb"] @ p["x" + d] + p["b" + d]
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((*x.shape, n), np.float32)
        for t in steps:
            z = gates_of[x[t]] + h @ p["h" + d]
            ifo = _sigmoid(z[:, :3 * n])
            g = np.tanh(z[:, 3 * n:])
            before = (h, c)
            live = (x[t] != PAD)[:, None]
            c = np.where(live, ifo[:, n:2 * n] * c + ifo[:, :n] * g, 0)
            tc = np.tanh(c)
            h = np.where(live, ifo[:, 2 * n:] * tc, 0)
            out[t] = h
            if keep is not None:
                keep.append((t, ifo, g, tc, live, *before))
        return out

    def _direction_back(self, x, d, kept, dout, grad):
        p, n = self.p, self.hidden
        dgates = np.zeros((SYMBOLS, 4 * n), np.float32)
        dh = dc = np.zeros((x.shape[1], n), np.float32)
        for t, ifo, g, tc, live, h0, c0 in reversed(kept):
            dh = np.where(live, dh + dout[t], 0)
            i, f, o = ifo[:, :n], ifo[:, n:2 * n], ifo[:, 2 * n:]
            dc = np.where(live, dc + dh * o * (1 - tc * tc), 0)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            np.add.at(dgates, x[t], dz)
            grad["h" + d] += h0.T @ dz
            dh, dc = dz @ p["h" + d].T, dc * f
        grad["x" + d] += p["emb"].T @ dgates
        grad["b" + d] += dgates.sum(0)
        grad["emb"] += dgates @ p["x" + d].T

    def _scores(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = ([], []) if keep is not None else (None, None)
        h = np.concatenate([self._direction(x, "f", kf), self._direction(x, "b", kb)], 2)
        if keep is not None:
            keep.update(f=kf, b=kb, h=h)
        return h @ self.p["out"] + self.p["ob"]

    # -- CRF --------------------------------------------------------------------------------

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of tags y [length, batch], and its gradient."""
        p, keep = self.p, {}
        e = self._scores(x, keep).astype(np.float64)
        length, batch, k = e.shape
        live = x != PAD
        trans = p["trans"].astype(np.float64)
        lse = lambda a, ax: a.max(ax) + np.log(np.exp(a - np.expand_dims(a.max(ax), ax)).sum(ax))
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = p["start"] + e[0]
        for t in range(1, length):
            step = lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
            alpha[t] = np.where(live[t][:, None], step, alpha[t - 1])
        for t in range(length - 2, -1, -1):
            step = lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(live[t + 1][:, None], step, beta[t + 1])
        total = lse(alpha[-1], 1)
        post = np.exp(alpha + beta - total[None, :, None]) * live[:, :, None]
        rows = np.arange(batch)
        gold = p["start"][y[0]] + e[0, rows, y[0]]
        dtrans = np.zeros_like(trans)
        for t in range(1, length):
            on = live[t]
            gold = gold + np.where(on, trans[y[t - 1], y[t]] + e[t, rows, y[t]], 0)
            joint = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - total[:, None, None])
            dtrans += joint[on].sum(0)
            np.add.at(dtrans, (y[t - 1][on], y[t][on]), -1)
        de = post
        de[np.arange(length)[:, None], rows[None, :], y] -= live
        grad = {key: np.zeros_like(v) for key, v in p.items()}
        de = (de / batch).astype(np.float32)
        grad["trans"] += (dtrans / batch).astype(np.float32)
        grad["start"] += de[0].sum(0)
        h = keep["h"]
        grad["out"] += h.reshape(-1, h.shape[2]).T @ de.reshape(-1, k)
        grad["ob"] += de.sum((0, 1))
        dh = de @ p["out"].T
        self._direction_back(x, "f", keep["f"], dh[:, :, :self.hidden], grad)
        self._direction_back(x, "b", keep["b"], dh[:, :, self.hidden:], grad)
        return float((total - gold).mean()), grad

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.02,
            seed: int = 11) -> list[float]:
        """x, y: [windows, length] of symbols and tags. Returns the mean loss of each epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order, seen = r.permutation(len(x)), []
            for i in range(0, len(x), batch):
                at = order[i:i + batch]
                loss, grad = self._loss(x[at].T, y[at].T)
                seen.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                lr = rate * (1 - epoch / epochs) * min(1.0, 5.0 / max(norm, 1e-9))
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * (g * min(1.0, 5.0 / max(norm, 1e-9))) ** 2
                    self.p[k] = (self.p[k] - lr * m[k] / (1 - 0.9 ** step)
                                 / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses

    def decode(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        """Best tags [windows, length] of symbols of the same shape (0 at the padding)."""
        out = np.zeros(x.shape, np.int8)
        for i in range(0, len(x), batch):
            part = x[i:i + batch].T
            e = self._scores(part)
            length, n, _ = e.shape
            best, back = self.p["start"] + e[0], np.empty(e.shape, np.int8)
            for t in range(1, length):
                s = best[:, :, None] + self.p["trans"]
                back[t] = s.argmax(1)
                live = part[t] != PAD
                best = np.where(live[:, None], s.max(1) + e[t], best)
                back[t][~live] = np.arange(self.tags)
            tag = best.argmax(1)
            rows = np.arange(n)
            for t in range(length - 1, -1, -1):
                out[i:i + n, t] = np.where(part[t] != PAD, tag, 0)
                if t:
                    tag = back[t][rows, tag]
        return out
