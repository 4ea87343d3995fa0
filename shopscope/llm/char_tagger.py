"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Sequences have one fixed length and integer symbols. All arrays carry the batch in front, so that a step over time is
one small matrix product for every sequence of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Array = np.ndarray


def _sigmoid(x: Array) -> Array:
    return 1 / (1 + np.exp(-x))


def _sum_exp(x: Array, axis: int) -> Array:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


@dataclass
class Tagger:
    """Parameters by name: an LSTM for each direction (``f``, ``b``), an output layer and CRF scores."""

    p: dict[str, Array]

    @classmethod
    def fresh(cls, symbols: int, labels: int, hidden: int, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {}
        for way in "fb":
            p[f"{way}x"] = (0.3 * rng.standard_normal((symbols, 4 * hidden))).astype(np.float32)
            p[f"{way}h"] = draw(hidden, 4 * hidden)
            p[f"{way}0"] = np.zeros(4 * hidden, np.float32)
            p[f"{way}0"][hidden : 2 * hidden] = 1  # remember at first
        p |= {"out": draw(2 * hidden, labels), "out0": np.zeros(labels, np.float32)}
        p |= {"crf": np.zeros((labels, labels), np.float32), "first": np.zeros(labels, np.float32), "last": np.zeros(labels, np.float32)}
        return cls(p)

    @property
    def hidden(self) -> int:
        return len(self.p["fh"])

    # ---- forward ----

    def _run(self, way: str, x: Array, keep: list | None = None) -> Array:
        """Hidden states (time, batch, hidden); ``keep`` gets what the backward pass needs, by time."""
        H, steps = self.hidden, x.shape[1]
        wx, wh = self.p[f"{way}x"] + self.p[f"{way}0"], self.p[f"{way}h"]
        h = np.zeros((len(x), H), np.float32)
        c, out = h, np.empty((steps, len(x), H), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = wx[x[:, t]] + h @ wh
            gates = _sigmoid(z[:, : 3 * H])
            i, f, o = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :]
            g = np.tanh(z[:, 3 * H :])
            before_h, before_c = h, c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, squashed, before_c, before_h))
        return out

    def emissions(self, x: Array, keep: dict | None = None) -> Array:
        """Label scores (time, batch, labels)."""
        both = np.concatenate([self._run(way, x, None if keep is None else keep.setdefault(way, [])) for way in "fb"], 2)
        if keep is not None:
            keep["both"] = both
        return both @ self.p["out"] + self.p["out0"]

    def decode(self, x: Array) -> Array:
        """The best label sequences (batch, time), by Viterbi."""
        e = self.emissions(x)
        best, back = self.p["first"] + e[0], []
        for t in range(1, len(e)):
            scores = best[:, :, None] + self.p["crf"]
            back.append(scores.argmax(1))
            best = scores.max(1) + e[t]
        label = (best + self.p["last"]).argmax(1)
        path, rows = [label], np.arange(len(x))
        for step in reversed(back):
            label = step[rows, label]
            path.append(label)
        return np.stack(path[::-1], 1)

    # ---- training ----

    def loss(self, x: Array, y: Array) -> tuple[float, dict[str, Array]]:
        """Mean negative log likelihood of the labels (batch, time), and its gradient."""
        keep: dict = {}
        e = self.emissions(x, keep)
        steps, batch, labels = e.shape
        crf, first, last, rows = self.p["crf"], self.p["first"], self.p["last"], np.arange(batch)
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[0], beta[-1] = first + e[0], last
        for t in range(1, steps):
            alpha[t] = _sum_exp(alpha[t - 1][:, :, None] + crf, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _sum_exp(crf + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _sum_exp(alpha[-1] + last, 1)
        gold = first[y[:, 0]] + last[y[:, -1]] + sum(e[t, rows, y[:, t]] for t in range(steps))
        gold = gold + sum(crf[y[:, t - 1], y[:, t]] for t in range(1, steps))
        grad = {name: np.zeros_like(value) for name, value in self.p.items()}
        share = np.exp(alpha + beta - total[:, None]).astype(np.float32)
        for t in range(1, steps):
            pair = np.exp(alpha[t - 1][:, :, None] + crf + (e[t] + beta[t] - total[:, None])[:, None, :])
            grad["crf"] += pair.sum(0)
            np.add.at(grad["crf"], (y[:, t - 1], y[:, t]), -1)
        d = share
        d[np.arange(steps)[:, None], rows, y.T] -= 1
        grad["first"], grad["last"] = d[0].sum(0), d[-1].sum(0)
        both = keep["both"]
        grad["out"], grad["out0"] = np.einsum("tbh,tbl->hl", both, d), d.sum((0, 1))
        d_both = d @ self.p["out"].T
        H = self.hidden
        for n, way in enumerate("fb"):
            self._back(way, x, keep[way], d_both[:, :, n * H : (n + 1) * H], grad)
        return float((total - gold).mean()), {name: value / batch for name, value in grad.items()}

    def _back(self, way: str, x: Array, keep: list, d_out: Array, grad: dict[str, Array]) -> None:
        H, wh = self.hidden, self.p[f"{way}h"]
        dh = np.zeros_like(d_out[0])
        dc = np.zeros_like(dh)
        for t, i, f, o, g, squashed, before_c, before_h in reversed(keep):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1)
            np.add.at(grad[f"{way}x"], x[:, t], dz)
            grad[f"{way}h"] += before_h.T @ dz
            grad[f"{way}0"] += dz.sum(0)
            dh, dc = dz @ wh.T, dc * f

    def train(self, x: Array, y: Array, epochs: int, batch: int = 64, rate: float = 0.03, seed: int = 5) -> list[float]:
        """Adam with a falling rate; returns the mean loss of each epoch."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        mean = {name: np.zeros_like(value) for name, value in self.p.items()}
        square = {name: np.zeros_like(value) for name, value in self.p.items()}
        steps = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, sums = rng.permutation(len(x)), []
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                loss, grad = self.loss(x[rows], y[rows])
                sums.append(loss)
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for name, value in grad.items():
                    value = np.clip(value, -1, 1)
                    mean[name] = 0.9 * mean[name] + 0.1 * value
                    square[name] = 0.999 * square[name] + 0.001 * value**2
                    ahead = mean[name] / (1 - 0.9**step)
                    self.p[name] = (self.p[name] - now * ahead / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(sums)))
        return losses
