"""A character tagger in numpy: a bidirectional LSTM whose scores go into a linear-chain CRF."""

from __future__ import annotations

import numpy as np

#: Characters are ASCII codes, or one code for other letters and one for the rest; 0 pads.
CODES = 130


def encode(text: str, length: int) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for i, c in enumerate(text[:length]):
        out[i] = max(1, ord(c)) if ord(c) < 128 else 128 if c.isalpha() else 129
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    def __init__(self, tags: int, width: int = 12, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = tags, hidden
        small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p = {"chars": rng.normal(0, 0.3, (CODES, width)).astype(np.float32), "out": small(2 * hidden, tags),
                  "bias": np.zeros(tags, np.float32), "moves": np.zeros((tags, tags), np.float32), "start": np.zeros(tags, np.float32)}
        for d in "fb":
            self.p["in" + d], self.p["rec" + d] = small(width, 4 * hidden), small(hidden, 4 * hidden)
            self.p["gate" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)

    def _run(self, x, mask, d, keep):
        """States of one direction; padding leaves the state as it is. x (batch, time, width)."""
        n, t, _ = x.shape
        h, c, hid = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32), self.hidden
        fed = x @ self.p["in" + d] + self.p["gate" + d]
        out, memo = np.zeros((n, t, hid), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = fed[:, k] + h @ self.p["rec" + d]
            s = _sigmoid(z[:, : 3 * hid])
            i, f, o, g = s[:, :hid], s[:, hid:2 * hid], s[:, 2 * hid:], np.tanh(z[:, 3 * hid:])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            m = mask[:, k:k + 1]
            if keep:
                memo.append((k, h, c, i, f, o, g, tc))
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            out[:, k] = h
        return out, memo

    def emissions(self, codes, keep=False):
        """(scores of each tag at each place, what the gradient needs)."""
        mask = codes > 0
        x = self.p["chars"][codes]
        f, mf = self._run(x, mask, "f", keep)
        b, mb = self._run(x, mask, "b", keep)
        both = np.concatenate([f, b], 2)
        return both @ self.p["out"] + self.p["bias"], (codes, mask, x, both, mf, mb)

    def marginals(self, em, lengths):
        """(log of the sum over all paths, probability of each tag at each place, of each move between places)."""
        n, t, k = em.shape
        moves = self.p["moves"].astype(np.float64)
        em = em.astype(np.float64)
        a, b = np.zeros((n, t, k)), np.zeros((n, t, k))
        a[:, 0] = em[:, 0] + self.p["start"]
        for j in range(1, t):
            a[:, j] = np.where((j < lengths)[:, None], _logsum(a[:, j - 1][:, :, None] + moves, 1) + em[:, j], a[:, j - 1])
        for j in range(t - 2, -1, -1):
            step = _logsum(moves + (em[:, j + 1] + b[:, j + 1])[:, None, :], 2)
            b[:, j] = np.where((j + 1 < lengths)[:, None], step, 0)
        total = _logsum(a[:, -1], 1)
        place = np.exp(a + b - total[:, None, None]) * (np.arange(t) < lengths[:, None])[:, :, None]
        return total, place, (a, b, moves, em)

    def best(self, em, lengths):
        """The best path of each row, by Viterbi."""
        n, t, k = em.shape
        score, back = em[:, 0] + self.p["start"], np.zeros((n, t, k), np.int64)
        for j in range(1, t):
            options = score[:, :, None] + self.p["moves"]
            back[:, j] = options.argmax(1)
            on = (j < lengths)[:, None]
            back[:, j] = np.where(on, back[:, j], np.arange(k))
            score = np.where(on, options.max(1) + em[:, j], score)
        path = np.zeros((n, t), np.int64)
        path[:, -1] = score.argmax(1)
        for j in range(t - 1, 0, -1):
            path[:, j - 1] = back[np.arange(n), j, path[:, j]]
        return path

    def gradients(self, codes, tags):
        """(mean loss, gradient of every parameter) of the negative log-likelihood of the given tags."""
        em, (codes, mask, x, both, mf, mb) = self.emissions(codes, keep=True)
        n, t, k = em.shape
        lengths = mask.sum(1)
        total, place, (a, b, moves, emd) = self.marginals(em, lengths)
        rows, places = np.nonzero(mask)
        gold = tags[rows, places]
        dem = place.copy()
        dem[rows, places, gold] -= 1
        g = {"start": dem[:, 0].sum(0), "moves": np.zeros((k, k))}
        paths = em[rows, places, gold].sum() + self.p["start"][tags[:, 0]].sum()
        for j in range(1, t):
            on = j < lengths
            if not on.any():
                break
            pair = np.exp(a[on, j - 1][:, :, None] + moves + (emd[on, j] + b[on, j])[:, None, :] - total[on][:, None, None])
            g["moves"] += pair.sum(0)
            np.subtract.at(g["moves"], (tags[on, j - 1], tags[on, j]), 1)
            paths += self.p["moves"][tags[on, j - 1], tags[on, j]].sum()
        dem = dem.astype(np.float32)
        g["out"], g["bias"] = both.reshape(-1, both.shape[2]).T @ dem.reshape(-1, k), dem.sum((0, 1))
        dboth = dem @ self.p["out"].T
        dx = np.zeros_like(x)
        hid = self.hidden
        for d, memo, dh_all in (("f", mf, dboth[:, :, :hid]), ("b", mb, dboth[:, :, hid:])):
            rec = self.p["rec" + d]
            dz_all, grec = np.zeros((n, t, 4 * hid), np.float32), np.zeros_like(rec)
            dh, dc = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
            for j, h0, c0, i, f, o, u, tc in reversed(memo):
                m = mask[:, j:j + 1]
                dh_in = dh + dh_all[:, j]
                dh1 = np.where(m, dh_in, 0)
                dc1 = np.where(m, dc, 0) + dh1 * o * (1 - tc * tc)
                dz = np.concatenate([dc1 * u * i * (1 - i), dc1 * c0 * f * (1 - f), dh1 * tc * o * (1 - o), dc1 * i * (1 - u * u)], 1)
                dz_all[:, j] = dz
                grec += h0.T @ dz
                dh = np.where(m, dz @ rec.T, dh_in)
                dc = np.where(m, dc1 * f, dc)
            g["rec" + d], g["gate" + d] = grec, dz_all.sum((0, 1))
            g["in" + d] = x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * hid)
            dx += dz_all @ self.p["in" + d].T
        g["chars"] = np.zeros_like(self.p["chars"])
        np.add.at(g["chars"], codes, dx)
        return float((total.sum() - paths) / n), {name: v / n for name, v in g.items()}

    def train(self, codes: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng, m, v, step, losses = np.random.default_rng(seed), {}, {}, 0, []
        for epoch in range(epochs):
            order, sums = rng.permutation(len(codes)), []
            for lo in range(0, len(order), batch):
                pick = order[lo:lo + batch]
                loss, g = self.gradients(codes[pick], tags[pick])
                step += 1
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                for name, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * x
                    v[name] = 0.99 * v.get(name, 0) + 0.01 * x * x
                    by = rate * (1 - epoch / (epochs + 1)) * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
                    self.p[name] = (self.p[name] - by).astype(np.float32)
                sums.append(loss)
            losses.append(float(np.mean(sums)))
        return losses
