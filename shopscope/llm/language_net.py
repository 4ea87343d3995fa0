"""Language of texts by a convolutional network over bytes, in numpy.

Each UTF-8 byte has a small learned vector. Filters of several widths slide over windows of one fixed length, the
largest answer of each filter is kept, and a softmax layer turns them into shares of the languages. A whole text is cut
into windows that overlap by the widest filter less one byte, so that every place is seen, and its shares are the mean
over its windows by their numbers of bytes.

Learning takes a bounded sample: of at most ``languages`` languages, the most frequent ones, some ``per_language`` texts
chosen by a hash of the text, and of each text at most ``per_text`` pieces of a window, evenly spaced. Copies of a text
count once in the sample. Prediction reads whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was learned;
rows with null language, and null keys, teach nothing and a null key is not held out; ties go to the language that sorts
first; repeated rows get the same answer each; other columns aren't read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded

Array = np.ndarray

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
PAD = 256
UNDETERMINED = "und"
#: Windows in one matrix product.
TOGETHER = 64
#: Bytes of text whose windows are laid out together.
SLICE = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def windows(texts: list[bytes]) -> tuple[Array, Array, Array]:
    """Windows (n, WINDOW) of symbols, the text each belongs to, and its number of bytes; an empty text has one of none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    step = WINDOW - max(WIDTHS) + 1
    counts = np.maximum(1, -(-(sizes - WINDOW) // step) + 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    low = nth * step
    used = np.minimum(sizes[owner] - low, WINDOW)
    flat = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    start = (np.cumsum(sizes) - sizes)[owner] + low
    within = np.arange(WINDOW)
    symbols = np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[start].astype(np.int16)
    symbols[within[None, :] >= used[:, None]] = PAD
    return symbols, owner, used


@dataclass
class Network:
    """Parameters by name: byte vectors, filters (a narrow filter's rows beyond its width are 0), and the softmax layer."""

    languages: list[str]
    p: dict[str, Array]

    @classmethod
    def fresh(cls, languages: list[str], size: int = 8, filters: int = 16, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        total, widest = filters * len(WIDTHS), max(WIDTHS)
        draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        vectors = 0.5 * draw(PAD + 1, size)
        vectors[PAD] = 0
        kernel = draw(widest, size, total) * cls._mask(size, filters) / np.sqrt(size * np.repeat(WIDTHS, filters)).astype(np.float32)
        p = {"vectors": vectors, "kernel": kernel.reshape(widest * size, total), "bias": np.zeros(total, np.float32)}
        return cls(languages, p | {"out": draw(total, len(languages)) / np.float32(np.sqrt(total)), "out0": np.zeros(len(languages), np.float32)})

    @staticmethod
    def _mask(size: int, filters: int) -> Array:
        widths = np.repeat(WIDTHS, filters)
        return np.broadcast_to((np.arange(max(WIDTHS))[:, None] < widths)[:, None, :], (max(WIDTHS), size, len(widths))).astype(np.float32)

    def _columns(self, x: Array) -> Array:
        """The vectors of each place and the next ones, side by side: (windows, places, widest * size)."""
        vectors = self.p["vectors"][x]
        places, widest = x.shape[1] - max(WIDTHS) + 1, max(WIDTHS)
        return np.concatenate([vectors[:, k : k + places] for k in range(widest)], 2)

    def _pooled(self, columns: Array) -> Array:
        """Each filter's answer at each place."""
        return columns.reshape(-1, columns.shape[2]) @ self.p["kernel"]

    def shares(self, x: Array) -> Array:
        """Softmax over the languages for each window."""
        found = []
        for at in range(0, len(x), TOGETHER):
            columns = self._columns(x[at : at + TOGETHER])
            best = self._pooled(columns).reshape(*columns.shape[:2], -1).max(1)
            found.append(np.maximum(best + self.p["bias"], 0) @ self.p["out"] + self.p["out0"])
        z = np.concatenate(found).astype(float)
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def loss(self, x: Array, y: Array) -> tuple[float, dict[str, Array]]:
        """Mean negative log likelihood, and its gradient."""
        n, size, widest = len(x), self.p["vectors"].shape[1], max(WIDTHS)
        columns = self._columns(x)
        answers = self._pooled(columns).reshape(*columns.shape[:2], -1)
        place = answers.argmax(1)
        best = np.take_along_axis(answers, place[:, None, :], 1)[:, 0] + self.p["bias"]
        hidden = np.maximum(best, 0)
        z = hidden @ self.p["out"] + self.p["out0"]
        z -= z.max(1, keepdims=True)
        share = np.exp(z)
        share /= share.sum(1, keepdims=True)
        loss = float(-np.log(share[np.arange(n), y] + 1e-12).mean())
        share[np.arange(n), y] -= 1
        share /= n
        d_best = (share @ self.p["out"].T) * (best > 0)
        picked = columns[np.arange(n)[:, None], place]  # windows, filters, widest * size
        d_kernel = np.einsum("nfk,nf->kf", picked, d_best)
        d_picked = d_best[:, :, None] * self.p["kernel"].T[None]
        symbols = x[np.arange(n)[:, None, None], place[:, :, None] + np.arange(widest)].ravel()
        d_picked = d_picked.reshape(-1, size)
        d_vectors = np.stack([np.bincount(symbols, d_picked[:, k], PAD + 1) for k in range(size)], 1)
        d_vectors[PAD] = 0
        gradient = {"vectors": d_vectors, "kernel": d_kernel, "bias": d_best.sum(0), "out": hidden.T @ share, "out0": share.sum(0)}
        return loss, {name: value.astype(np.float32) for name, value in gradient.items()}

    def train(self, x: Array, y: Array, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 2) -> list[float]:
        """Adam with a falling rate; returns the mean loss of each epoch."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        filters = len(self.p["bias"]) // len(WIDTHS)
        mask = self._mask(self.p["vectors"].shape[1], filters).reshape(self.p["kernel"].shape)
        mean = {name: np.zeros_like(value) for name, value in self.p.items()}
        square = {name: np.zeros_like(value) for name, value in self.p.items()}
        steps = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, sums = rng.permutation(len(x)), []
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                loss, gradient = self.loss(x[rows], y[rows])
                gradient["kernel"] *= mask
                sums.append(loss)
                step += 1
                now = rate * (1 - 0.95 * step / steps)
                for name, value in gradient.items():
                    mean[name] = 0.9 * mean[name] + 0.1 * value
                    square[name] = 0.999 * square[name] + 0.001 * value**2
                    ahead = mean[name] / (1 - 0.9**step)
                    self.p[name] = (self.p[name] - now * ahead / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(sums)))
        return losses

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and its share of each whole text."""
        answers = [(UNDETERMINED, 0.0)] * len(texts)
        if not self.languages:
            return answers
        held: list[tuple[int, bytes]] = []
        sums: dict[int, Array] = {}

        def flush() -> None:
            x, owner, used = windows([raw for _, raw in held])
            share = self.shares(x) * used[:, None]
            for k, total in enumerate(np.add.reduceat(share, np.flatnonzero(np.diff(owner, prepend=-1)))):
                n = held[k][0]
                sums[n] = sums.get(n, 0) + total
            held.clear()

        room = SLICE
        for n, text in enumerate(texts):
            if not has_letter(text):
                continue
            raw = text.encode()
            at, step = 0, SLICE // (WINDOW - max(WIDTHS) + 1) * (WINDOW - max(WIDTHS) + 1)
            while True:  # a long text goes in parts that hold whole windows
                part = raw[at : at + step + max(WIDTHS) - 1]
                held.append((n, part))
                room -= len(part)
                if room <= 0:
                    flush()
                    room = SLICE
                at += step
                if at + max(WIDTHS) - 1 >= len(raw):
                    break
        if held:
            flush()
        for n, total in sums.items():
            best = int(total.argmax())
            answers[n] = (self.languages[best], float(min(1.0, total[best] / total.sum())))
        return answers


# ---- learning ----------------------------------------------------------------------------------------------------


def fit(pieces: list[tuple[str, str]], epochs: int = 6, seed: int = 4) -> Network:
    """Learn from (language, piece of text): as they are, and cut to some words, as texts may be short."""
    languages = sorted({lang for lang, _ in pieces})
    if not languages:
        return Network([], {})
    rng, raws, ys = random.Random(seed), [], []
    for lang, piece in pieces:
        raw = piece.encode()[:WINDOW]
        words = piece.split()
        first = rng.randrange(len(words)) if words else 0
        short = " ".join(words[first : first + rng.choice([1, 2, 3, 5, 8, 13])])
        for version in (raw, short.encode()[:WINDOW]) if has_letter(short) else (raw,):
            raws.append(version)
            ys.append(languages.index(lang))
    x, y = windows(raws)[0], np.array(ys)
    network = Network.fresh(languages)
    network.train(x, y, epochs)
    return network


def held_out(key: Column) -> Column:
    """True for the rows that must not be learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, per_language: int = 1500, per_text: int = 4, languages: int = 200, pieces: int = 20_000) -> Network:
    """Train on a bounded sample of the rows that have a language, a letter and a key, and aren't held out.

    ``pieces`` bounds the pieces of all languages together.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return fit([])
    each = max(1, min(per_language, pieces // (per_text * len(counts))))
    # a hash in [0, 1) lets some more texts pass than are wanted, without sorting any; copies of a text have one hash
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 1.3 * each / r["count"])) for r in counts], "lang string, part double")
    order = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(1 << 53))
    passed = usable.select("lang", "text", order.alias("order")).join(F.broadcast(shares), "lang").where("order < part")
    n = F.length("text")
    parts = F.least(F.lit(per_text), F.ceil(n / WINDOW))
    cut = F.transform(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1), lambda i: F.substr("text", F.floor(i * n / parts).cast("int") + 1, F.lit(WINDOW)))
    rows = passed.select("lang", "order", cut.alias("pieces")).dropDuplicates(["lang", "order"]).collect()
    taken: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["order"])):
        if len(own := taken.setdefault(row["lang"], [])) < each * per_text:
            own += row["pieces"]
    return fit([(lang, piece) for lang, own in taken.items() for piece in own if has_letter(piece)])


def detect(text: Column, network: Network) -> Column:
    """Struct of lang_pred and score for each whole text."""
    bounded()

    @F.pandas_udf("lang_pred string, score double")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(network.predict(batch.tolist()), columns=["lang_pred", "score"])

    return found(text)
