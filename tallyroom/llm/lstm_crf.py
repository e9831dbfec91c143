"""A character-level bidirectional LSTM with CRF transitions in numpy: training and decoding."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class LstmCrf:
    """Parameters are in ``p``; sequences are arrays (time, batch) of symbol numbers."""

    def __init__(self, symbols: int, tags: int, embedding: int = 8, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p = {"embed": scale(symbols, embedding) * 2, "out": scale(2 * hidden, tags), "out_b": np.zeros(tags, np.float32)}
        for side in "fb":
            self.p[f"w{side}"] = scale(embedding + hidden, 4 * hidden)
            self.p[f"b{side}"] = np.zeros(4 * hidden, np.float32)
            self.p[f"b{side}"][hidden : 2 * hidden] = 1  # remember at first
        self.p["trans"] = np.zeros((tags, tags), np.float32)
        self.p["start"] = np.zeros(tags, np.float32)

    def _run(self, x: np.ndarray, side: str):
        """Hidden states over time, and what the way back needs."""
        steps, batch, _ = x.shape
        n = self.hidden
        w, b = self.p[f"w{side}"], self.p[f"b{side}"]
        split = x.shape[2]
        inputs = x.reshape(-1, split) @ w[:split] + b
        inputs = inputs.reshape(steps, batch, -1)
        h, c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
        hs, kept = np.empty((steps, batch, n), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = inputs[t] + h @ w[split:]
            gates = _sigmoid(z[:, : 3 * n])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            g = np.tanh(z[:, 3 * n :])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hs[t] = h
            kept.append((t, i, f, o, g, tc, *before))
        return hs, kept

    def _back(self, x: np.ndarray, side: str, kept, d_hs: np.ndarray, grads) -> np.ndarray:
        n, split = self.hidden, x.shape[2]
        w = self.p[f"w{side}"]
        dz_all = np.empty((x.shape[0], x.shape[1], 4 * n), np.float32)
        dh, dc = np.zeros_like(d_hs[0]), np.zeros_like(d_hs[0])
        dw_h = np.zeros_like(w[split:])
        for t, i, f, o, g, tc, h_before, c_before in reversed(kept):
            dh = dh + d_hs[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = dz_all[t]
            dz[:, :n] = dc * g * i * (1 - i)
            dz[:, n : 2 * n] = dc * c_before * f * (1 - f)
            dz[:, 2 * n : 3 * n] = dh * tc * o * (1 - o)
            dz[:, 3 * n :] = dc * i * (1 - g * g)
            dw_h += h_before.T @ dz
            dh = dz @ w[split:].T
            dc = dc * f
        flat = dz_all.reshape(-1, 4 * n)
        grads[f"w{side}"] = np.concatenate([x.reshape(-1, split).T @ flat, dw_h])
        grads[f"b{side}"] = flat.sum(axis=0)
        return (flat @ w[:split].T).reshape(x.shape)

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Tag scores (time, batch, tags)."""
        x = self.p["embed"][symbols]
        states = np.concatenate([self._run(x, "f")[0], self._run(x, "b")[0]], axis=2)
        return states @ self.p["out"] + self.p["out_b"]

    def loss_and_grads(self, symbols: np.ndarray, tags: np.ndarray):
        """Mean negative log-likelihood of the tag sequences under the CRF, and its gradients."""
        steps, batch = symbols.shape
        x = self.p["embed"][symbols]
        (hf, kf), (hb, kb) = self._run(x, "f"), self._run(x, "b")
        states = np.concatenate([hf, hb], axis=2)
        scores = states @ self.p["out"] + self.p["out_b"]
        trans, start = self.p["trans"], self.p["start"]

        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + start
        for t in range(1, steps):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + trans, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(trans + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _lse(alpha[-1], 1)
        rows = np.arange(batch)
        right = start[tags[0]] + scores[0, rows, tags[0]]
        for t in range(1, steps):
            right = right + trans[tags[t - 1], tags[t]] + scores[t, rows, tags[t]]

        d_scores = np.exp(alpha + beta - total[None, :, None])
        grads = {"start": d_scores[0].sum(axis=0) - np.bincount(tags[0], minlength=self.tags)}
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + trans + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            d_trans += np.exp(pair).sum(axis=0)
        np.add.at(d_trans, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        grads["trans"] = d_trans
        np.put_along_axis(d_scores, tags[:, :, None], np.take_along_axis(d_scores, tags[:, :, None], 2) - 1, 2)

        flat = d_scores.reshape(-1, self.tags)
        grads["out"] = states.reshape(-1, states.shape[2]).T @ flat
        grads["out_b"] = flat.sum(axis=0)
        d_states = d_scores @ self.p["out"].T
        dx = self._back(x, "f", kf, d_states[:, :, : self.hidden], grads)
        dx += self._back(x, "b", kb, d_states[:, :, self.hidden :], grads)
        grads["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grads["embed"], symbols.ravel(), dx.reshape(-1, dx.shape[2]))
        return float((total - right).mean()), {k: g / batch for k, g in grads.items()}

    def fit(self, symbols: np.ndarray, tags: np.ndarray, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam with clipped gradients and a falling rate; columns are drawn with a fixed seed."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            drawn = rng.integers(0, symbols.shape[1], min(batch, symbols.shape[1]))
            loss, grads = self.loss_and_grads(symbols[:, drawn], tags[:, drawn])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = (g * min(1.0, 5.0 / (norm + 1e-9))).astype(np.float32)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] = self.p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        return losses

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tag sequences (time, batch) for tag scores (time, batch, tags)."""
        steps, batch, _ = scores.shape
        back = np.empty(scores.shape, dtype=np.int16)
        best = scores[0] + self.p["start"]
        for t in range(1, steps):
            ways = best[:, :, None] + self.p["trans"]
            back[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        out = np.empty((steps, batch), dtype=np.int64)
        out[-1] = best.argmax(axis=1)
        rows = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = back[t, rows, out[t]]
        return out
