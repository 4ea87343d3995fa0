"""The network's gradient, its windows, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from shopscope.llm import catalog, language_net
from shopscope.llm.language_net import WIDTHS, WINDOW, Network, windows

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def plain(network, raw):
    """Shares of one text, window by window and filter by filter."""
    widest, size = max(WIDTHS), network.p["vectors"].shape[1]
    total, at = 0, 0
    while True:
        part = list(raw[at : at + WINDOW])
        symbols = part + [256] * (WINDOW - len(part))
        vectors = network.p["vectors"][symbols]
        kernel = network.p["kernel"].reshape(widest, size, -1)
        answers = [sum(vectors[t + k] @ kernel[k] for k in range(widest)) for t in range(WINDOW - widest + 1)]
        z = np.maximum(np.max(answers, 0) + network.p["bias"], 0) @ network.p["out"] + network.p["out0"]
        share = np.exp(z - z.max())
        total = total + len(part) * share / share.sum()
        at += WINDOW - widest + 1
        if at + widest - 1 >= len(raw):
            return total / total.sum()


def test_windows_against_a_plain_pass(monkeypatch):
    network = Network.fresh(["a", "b", "c"], seed=9)
    texts = ["x", "ab " * 84 + "abcd", "é" * 128, "é" * 129, "word " * 900, "", None, "12 34", "x" * (WINDOW + 1)]
    for size in (1 << 20, 700):
        monkeypatch.setattr(language_net, "SLICE", size)
        for text, (lang, score) in zip(texts, network.predict(texts)):
            if not text or not any(c.isalpha() for c in text):
                assert (lang, score) == ("und", 0.0)
                continue
            share = plain(network, text.encode())
            assert lang == network.languages[int(share.argmax())] and score == pytest.approx(share.max(), abs=1e-5)


def test_gradient():
    network = Network.fresh(["a", "b"], size=3, filters=2)
    network.p = {name: value.astype(np.float64) for name, value in network.p.items()}
    network.p["bias"] += np.random.default_rng(1).normal(size=8)  # away from the edge at 0
    x, y = windows([b"some text", b"other bytes here", b""])[0], np.array([0, 1, 1])
    loss, gradient = network.loss(x, y)
    rng = np.random.default_rng(0)
    for name, value in network.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape) if name != "vectors" else (b"somethr"[rng.integers(0, 7)], rng.integers(0, 3))
            before = value[at]
            value[at] = before + 1e-5
            ahead = network.loss(x, y)[0]
            value[at] = before
            assert (ahead - loss) / 1e-5 == pytest.approx(float(gradient[name][at]), abs=1e-3)


def test_odd_rows(spark):
    german = [(n, f"der die das und nicht {n} für über größe", "de", "x", "y") for n in range(40)]
    english = [(n, f"the and of with not {n} that which should", "en", "x", "y") for n in range(40, 80)]
    odd = [(100, None, "de", None, None), (101, "", "de", None, None), (102, "123 …", "en", None, None), (None, "the", "xx", None, None), (107, "the thing that", None, None, None), (107, "the thing that", None, None, None), (103, "über nicht für " * 30_000, "de", None, None)]
    docs = spark.createDataFrame(german + english + odd, SCHEMA)
    network = language_net.learn(docs)
    assert network.languages == ["de", "en"]  # a null key teaches nothing
    rows = docs.select("doc_id", "text", language_net.detect(docs["text"], network).alias("f")).select("doc_id", "text", "f.*").collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row["doc_id"] in (100, 101, 102):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] in ("de", "en") and 0.5 <= row["score"] <= 1
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 103} == {"de"} and {r["lang_pred"] for r in rows if r["doc_id"] == 107} == {"en"}
    nothing = language_net.learn(docs.where("lang is null"))
    assert {tuple(r[0]) for r in docs.select(language_net.detect(docs["text"], nothing)).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.1"
    truth = catalog.table(spark, directory, "documents").select("doc_id", "lang", "text")
    rows = catalog.op12_language_id(spark, directory).join(truth, "doc_id").collect()
    assert len(rows) == 10_000
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row["held_out"] and row["lang_pred"] != "und"]
    assert np.mean([row["lang_pred"] == row["lang"] for row in held]) > 0.97
