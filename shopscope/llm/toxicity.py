"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols by a lexicon: insults with weights learned from labelled rows (whole words, and stems that
several word forms share), and short fixed lists of threats, targets, negations and reporting verbs. Three
transducers are composed once into a single machine: the first turns an insult within the scope of a negation into
a denied one, the second marks what follows a reporting verb in the same clause as quoted, the third weighs what is
left by whether the clause has a target, and lets a threat count only together with one. The machine reads each
clause that holds an insult or a threat; a document's evidence is the sum over its clauses, and a logistic curve
fitted on the labelled rows turns evidence into a score.

Learning takes a bounded sample of labelled rows: at most ``per_class`` toxic rows and three times as many clean
ones, in the order of a hash of their keys, and of each class at most half of ``characters``. A text that doesn't fit
is passed over; if none of a class does, the beginning of its shortest one is taken. Scoring reads whole texts.

Defined cases: of different texts of one key the one with the smallest hash teaches, and each gets its own score; the
``held_out`` of a null key is null; null and empty texts have no evidence and get the curve's lowest score; rows without label, or whose
key is null, teach nothing; of contradicting labels of one key the toxic one counts; without toxic labels every
score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded

# Function words of the grammar in English, German, French and Spanish.
THREATS = "kill hurt destroy beat töten schlagen vernichten tuer frapper détruire matar golpear destruir"
TARGETS = "you your you're du dich dir dein ihr euch tu toi te vous votre tú ti usted ustedes vosotros"
NEGATIONS = "not no never isn't aren't nicht kein keine nie pas jamais aucun nunca jamás"
REPORTS = "said says called wrote claimed sagte schrieb nannte dit disait écrit appelé dijo dice escribió llamó"

WORD = re.compile(r"\w+(?:['’]\w+)*")
CLAUSE = re.compile(r"[^.,;:!?\n]+")
#: Lengths of the stems that are tried.
STEMS = range(3, 9)
#: A feature must be met in so many different contexts (previous and next word) of toxic rows.
CONTEXTS = 4
#: Log of how many times more frequent a feature must be in toxic rows.
LEAST_WEIGHT = 3.0
#: At most so many features are kept, by weight and frequency.
FEATURES = 20_000

#: A text is called toxic from this score on.
TOXIC_FROM = 0.3

Arc = tuple[str, str, float]


@dataclass
class Transducer:
    """Deterministic: state and input symbol to next state, output symbol and factor. A state without an arc for a symbol copies it and stays."""

    start: str
    arcs: dict[tuple[str, str], Arc]

    def step(self, state: str, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


SYMBOLS = ("insult", "threat", "target", "negation", "report", "other")


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds the first one's output to the second, over the lexicon's symbols; factors multiply."""
    start, arcs = f"{first.start}+{second.start}", {}
    pending, known = [(first.start, second.start)], {(first.start, second.start)}
    while pending:
        a, b = pending.pop()
        for symbol in SYMBOLS:
            next_a, middle, factor_a = first.step(a, symbol)
            next_b, out, factor_b = second.step(b, middle)
            arcs[f"{a}+{b}", symbol] = (f"{next_a}+{next_b}", out, factor_a * factor_b)
            if (next_a, next_b) not in known:
                known.add((next_a, next_b))
                pending.append((next_a, next_b))
    return Transducer(start, arcs)


def negation_scope() -> Transducer:
    """An insult or threat up to two words after a negation is denied."""
    arcs: dict[tuple[str, str], Arc] = {}
    for state in ("open", "near", "next"):
        arcs[state, "negation"] = ("next", "negation", 1.0)
    for state, after in (("next", "near"), ("near", "open")):
        arcs |= {(state, s): (after, s, 1.0) for s in ("other", "target", "report")}
        arcs |= {(state, s): ("open", f"denied {s}", 1.0) for s in ("insult", "threat")}
    return Transducer("open", arcs)


def reported_speech() -> Transducer:
    """What follows a reporting verb is quoted until the clause ends."""
    arcs: dict[tuple[str, str], Arc] = {("direct", "report"): ("quoting", "report", 1.0)}
    arcs |= {("quoting", s): ("quoting", f"quoted {s}", 1.0) for s in ("insult", "threat")}
    return Transducer("direct", arcs)


def weighing() -> Transducer:
    """Factors by target; a threat counts only with a target before or after it. Other symbols weigh nothing."""
    arcs: dict[tuple[str, str], Arc] = {}
    for state, aimed in (("plain", False), ("aimed", True), ("looming", False)):
        silent = {"other": state, "negation": state, "report": state, "target": "aimed"}
        arcs |= {(state, s): (to, s, 0.0) for s, to in silent.items()}
        for kind, factor in (("insult", 1.0), ("denied insult", 0.3), ("quoted insult", 0.6)):
            arcs[state, kind] = (state, kind, factor * (1.25 if aimed else 1.0))
        for kind, factor in (("threat", 1.0), ("denied threat", 0.0), ("quoted threat", 0.3)):
            arcs[state, kind] = (state if aimed or not factor else "looming", kind, factor if aimed else 0.0)
    arcs["looming", "target"] = ("aimed", "target", 1.0)
    return Transducer("plain", arcs)


MACHINE = compose(compose(negation_scope(), reported_speech()), weighing())
THREAT_WEIGHT = 3.0


@dataclass
class Grammar:
    """Learned insult weights by word and by stem, and the curve from evidence to score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    slope: float = 0.0
    offset: float = -math.inf

    def __post_init__(self) -> None:
        self.fixed = {w: "threat" for w in THREATS.split()} | {w: "target" for w in TARGETS.split()}
        self.fixed |= {w: "negation" for w in NEGATIONS.split()} | {w: "report" for w in REPORTS.split()}
        self.heads = {s[: STEMS.start] for s in self.stems}

    def insult(self, word: str) -> float:
        """The weight of the word as an insult, or 0."""
        weight = self.words.get(word, 0.0)
        if word[: STEMS.start] in self.heads:
            weight = max([weight, *(self.stems.get(word[:n], 0.0) for n in STEMS if n < len(word))])
        return weight

    def evidence(self, text: str | None) -> float:
        """Sum of the matched clauses' weights."""
        if not text:
            return 0.0
        text = text.lower()
        words = set(WORD.findall(text))
        hits = {w: x for w in words if (x := self.insult(w))}
        threats = {w for w in words if self.fixed.get(w) == "threat"} - hits.keys()
        if not hits and not threats:
            return 0.0
        total = 0.0
        for clause in CLAUSE.findall(text):
            tokens = WORD.findall(clause)
            if not any(t in hits or t in threats for t in tokens):
                continue
            state = MACHINE.start
            for token in tokens:
                symbol = "insult" if token in hits else self.fixed.get(token, "other")
                state, out, factor = MACHINE.step(state, symbol)
                if factor:
                    total += factor * hits.get(token, THREAT_WEIGHT)
        return total

    def score(self, text: str | None) -> float:
        z = self.slope * math.log1p(self.evidence(text)) + self.offset
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z)))) if z > -math.inf else 0.0


def _contexts(texts: Iterable[str], distinct: bool) -> tuple[Counter, int]:
    """How often each word occurs, counting equal contexts once if asked, and the sum."""
    counts: Counter = Counter()
    seen: set[int] = set()
    for text in texts:
        words = WORD.findall(text.lower())
        if not distinct:
            counts.update(words)
            continue
        for before, word, after in zip(["", *words], words, [*words[1:], ""]):
            if (key := hash((before, word, after))) not in seen:
                seen.add(key)
                counts[word] += 1
    return counts, sum(counts.values())


def _weights(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, tuple[float, int]]:
    return {
        f: (w, n)
        for f, n in toxic.items()
        if n >= CONTEXTS and (w := math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean[f] + 0.5) / (n_clean + 1))) >= LEAST_WEIGHT
    }


def _stems(words: Counter, wanted: set[str] | None = None) -> Counter:
    counts: Counter = Counter()
    for word, n in words.items():
        for length in STEMS:
            if length >= len(word):
                break
            if wanted is None or word[:length] in wanted:
                counts[word[:length]] += n
    return counts


def fit(texts: list[str], toxic: list[int], share: float) -> Grammar:
    """Learn from texts and their labels (1 is toxic); ``share`` is the share of toxic rows among all labelled ones."""
    bad, good = [t for t, y in zip(texts, toxic) if y], [t for t, y in zip(texts, toxic) if not y]
    if not bad:
        return Grammar()
    (in_bad, n_bad), (in_good, n_good) = _contexts(bad, True), _contexts(good, False)
    words = _weights(in_bad, in_good, n_bad, n_good)
    stems_bad = _stems(in_bad)
    stems_bad = Counter({s: n for s, n in stems_bad.items() if n >= CONTEXTS})
    stems = _weights(stems_bad, _stems(in_good, set(stems_bad)), n_bad, n_good)
    top = lambda found: {f: w for f, (w, _) in sorted(found.items(), key=lambda x: (-x[1][0] * math.log1p(x[1][1]), x[0]))[:FEATURES]}
    grammar = Grammar(top(words), top(stems))
    x = np.log1p([grammar.evidence(t) for t in texts])
    y = np.array(toxic, float)
    weight = np.where(y == 1, share / max(1, len(bad)), (1 - share) / max(1, len(good))) * len(y)
    grammar.slope, grammar.offset = _logistic(x, y, weight)
    return grammar


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Slope, not below 0, and offset of a weighted logistic fit with a little shrinkage."""
    design, theta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * theta
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        theta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(theta[0])), float(theta[1])


def held_out(key: Column) -> Column:
    """True for the rows that must not be learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, characters: int = 40_000_000) -> Grammar:
    """Fit a grammar on a bounded sample of the labelled rows that are not held out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    total = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    sample = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        for label, size in ((1, per_class), (0, 3 * per_class))
    ]
    chosen = F.broadcast(sample[0].union(sample[1]))  # at most 4 * per_class rows of two numbers
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.withColumn("order", F.xxhash64("text")).join(chosen, "doc_id")
    one = F.min(F.struct("order", F.length("text").alias("size"))).alias("one")  # of a key's texts always the same one
    rows = texts.groupBy("doc_id", "toxic").agg(one).select("doc_id", "toxic", "one.*").collect()
    kept = _within(rows, 1, characters // 2) + _within(rows, 0, characters // 2)
    if not kept:
        return Grammar()
    ids = F.broadcast(docs.sparkSession.createDataFrame(kept, "doc_id long, order long, most int"))
    cut = F.substring("text", F.lit(1), F.col("most")).alias("text")
    learned = texts.join(ids, ["doc_id", "order"]).dropDuplicates(["doc_id"]).select("doc_id", cut, "toxic").orderBy("doc_id").collect()
    return fit([r["text"] for r in learned], [r["toxic"] for r in learned], (total[1] or 0) / max(1, total[0]))


def _within(rows: list[Row], toxic: int, characters: int) -> list[tuple[int, int, int]]:
    """Rows of one class that fit together, in the order of a hash; if none does, the beginning of the shortest."""
    own = sorted((r for r in rows if r["toxic"] == toxic), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    kept, used = [], 0
    for row in own:
        if used + row["size"] <= characters:
            used += row["size"]
            kept.append((row["doc_id"], row["order"], row["size"]))
    if own and not kept:
        shortest = min(own, key=lambda r: (r["size"], r["doc_id"]))
        kept = [(shortest["doc_id"], shortest["order"], characters)]
    return kept


def score(text: Column, grammar: Grammar) -> Column:
    """The score of each text, from 0 to 1."""
    bounded()

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([grammar.score(value) for value in batch], dtype=float)

    return scores(text)
