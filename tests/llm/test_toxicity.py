"""The grammar on clauses, its learning, and held-out accuracy."""

import zlib

import pytest

from shopscope.llm import catalog, toxicity
from shopscope.llm.toxicity import Grammar

GRAMMAR = Grammar({"idiot": 4.0}, {"vequ": 4.0}, 2.0, -3.0)


def test_clauses():
    weigh = GRAMMAR.evidence
    assert weigh("you idiot") > weigh("some idiot") > weigh("she said idiot") > weigh("not an idiot") > 0
    assert weigh("Idiot. you") == weigh("some idiot")  # the target is in another clause
    assert weigh("une vequaire là") == weigh("some idiot")
    assert weigh("i will kill you") > weigh("kill the process") == 0
    assert weigh("i will never kill you") == 0
    assert weigh(None) == weigh("") == weigh("nothing here") == 0


def test_composition_runs_as_its_parts():
    word = ["report", "negation", "other", "insult", "target", "threat", "insult"]
    state, total = toxicity.MACHINE.start, 0.0
    for symbol in word:
        state, _, factor = toxicity.MACHINE.step(state, symbol)
        total += factor
    assert total == pytest.approx(0.3 + 0.3 * 1.0 + 0.6 * 1.25)


def test_learning_needs_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (None, None, "y"), (3, "", "z")], "doc_id long, text string, toxic string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r[0] for r in docs.select(toxicity.score(docs["text"], toxicity.learn(docs, none))).collect()] == [0, 0, 0]


def _labelled(spark, *more):
    rows = [(n, f"you are such a vequaire {n} and {n * 7} here", 1) for n in range(40)]
    rows += [(n, f"the weather is fine {n} and {n * 7} here", 0) for n in range(40, 160)]
    rows += more
    docs = spark.createDataFrame([(r[0], r[1], "x") for r in rows], "doc_id long, text string, toxic string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")


def test_texts_over_the_bound_are_passed_over(spark):
    docs, labels = _labelled(spark, (1000, "long words " * 2000, 1), (1004, "long words " * 2000, 0))
    grammar = toxicity.learn(docs, labels, characters=12_000)
    assert grammar.insult("vequaire") > 0 and grammar.slope > 0
    tiny = toxicity.learn(docs, labels, characters=60)  # no text fits: a piece of one of each class
    assert tiny.score("anything") <= 1


def test_a_key_with_several_texts_teaches_the_same_one(spark):
    more = [(n, f"entirely {w} words", 1) for n in range(200, 230) for w in ("other", "vequaire", "fine")]
    docs, labels = _labelled(spark, *more)
    first, second = (toxicity.learn(docs.repartition(n), labels) for n in (1, 5))
    assert (first.words, first.stems, first.slope, first.offset) == (second.words, second.stems, second.slope, second.offset)


def test_odd_tables(spark):
    docs, labels = _labelled(spark)
    grammar = toxicity.learn(docs, labels)
    assert docs.limit(0).select(toxicity.score(docs["text"], grammar)).count() == 0
    assert toxicity.learn(docs.limit(0), labels).words == {}
    text = "a fine day. " * 100_000 + "you vequaire"
    assert grammar.score(text) == grammar.score("you vequaire") > grammar.score("a fine day")


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.1"
    rows = catalog.op2_toxicity(spark, directory).join(catalog.table(spark, directory, "labels"), "doc_id").collect()
    held = [row for row in rows if row["held_out"]]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    hits = sum(row["predicted"] == row["toxic"] == 1 for row in held)
    precision, recall = hits / sum(row["predicted"] for row in held), hits / sum(row["toxic"] for row in held)
    assert precision > 0.85 and recall > 0.9  # some toxic labels there are on rows without any insult
