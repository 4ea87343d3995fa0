"""The pipeline against plain Python over the same learned models, and its edge cases."""

import hashlib

import public_tokenizers
import pytest
import regex

import corpus_pipeline
from shopscope.llm import byte_pairs, catalog, decontamination, personal_data, toxicity
from tests.llm.test_weighted_dedup import brute_force

DIRECTORY = "/root/testdata/sf0.001"


def grams(text):
    words = [w for w in regex.split(decontamination.BETWEEN, (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_against_plain_python(spark):
    docs, benchmark = catalog.table(spark, DIRECTORY, "documents"), catalog.table(spark, DIRECTORY, "benchmark")
    grammar = toxicity.learn(docs, catalog.table(spark, DIRECTORY, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clean = [(i, t) for i, t in rows if grammar.score(t) < toxicity.TOXIC_FROM]
    assert len(clean) < len(rows)
    kept = {c for _, c, _ in brute_force(clean)}
    single = [(i, t) for i, t in clean if i in kept]
    items = [grams(r["text"]) for r in benchmark.collect()]
    free = [(i, t) for i, t in single if not any(s and len(s & grams(t)) >= 0.8 * len(s) - 1e-9 for s in items)]
    assert len(free) < len(single) < len(clean)
    finder = personal_data.learn(spark.createDataFrame(free, "doc_id long, text string"))
    encoding = byte_pairs.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    wanted = {}
    for (i, t), (_, spans) in zip(free, finder.find([t for _, t in free])):
        masked = personal_data.redacted(t, spans)
        wanted[i] = (len(masked), encoding.encode_ordinary(masked), hashlib.sha256(masked.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_chars"], r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, DIRECTORY).collect()}
    assert got == wanted


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _print string, body string"
    rows = [(1, None, None, None, None, "a", "b"), (None, "", "en", "s", 0, None, None), (2, "mail a@b.de x", "en", "s", 13, "c", "d"), (2, "mail a@b.de x", "en", "s", 13, "c", "d")]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert len(out) == (2 if given else 0)  # one of the two empty texts, one of the equal rows


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_pairs"]


@pytest.mark.parametrize("name", ["op1_byte_pairs", "op10_personal_data", "pipeline"])
def test_queries_are_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries()
