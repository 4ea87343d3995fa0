"""Token ids against the libraries on whole texts, and exact round trips."""

import hashlib
import pathlib
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shopscope.llm import byte_pairs, catalog, token_files

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, key string, ids string"
ODD = [
    (5, "a  b   c \n d\n\n\n e \t f  ", "x", "y"),
    (2, None, None, None),
    (2, "", None, None),
    (None, "no key", None, None),
    (9, "<|endoftext|> it's we'll, don't... ½² x_y _,a \u00a0 \u2028z\x1c\x1d q", None, None),
    (9, "<|endoftext|> it's we'll, don't... ½² x_y _,a \u00a0 \u2028z\x1c\x1d q", None, None),
    (7, "wörd ñandú, 東京 123 4567. " * 9000, None, None),
    (8, "x" * 30_000, None, None),
]


def whole():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_long_texts_are_cut_without_changing_ids():
    encoding = byte_pairs.encoder(RANKS, PATTERN)
    for _, text, *_ in ODD:
        assert byte_pairs.encode_text(encoding, text, 10) == encoding.encode_ordinary(text or "")


def test_digests_and_round_trip(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    encoding = byte_pairs.encoder(RANKS, PATTERN)
    ids = byte_pairs.encode(docs["text"], RANKS, PATTERN)
    rows = docs.select("text", ids.alias("ids"), byte_pairs.digest(docs["text"], RANKS, PATTERN).alias("found"))
    rows = rows.withColumn("raw", byte_pairs.decode(rows["ids"], RANKS, PATTERN)).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        text = row["text"] or ""
        assert row["ids"] == encoding.encode_ordinary(text) and bytes(row["raw"]) == text.encode()
        assert row["found"]["n_tokens"] == len(row["ids"])
        assert row["found"]["ids_sha256"] == hashlib.sha256(" ".join(map(str, row["ids"])).encode()).hexdigest()
        assert row["found"]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t  .,'_1½\u00a0\u2003\x85\x1c東!", max_size=30), max_size=6))
def test_units_give_the_ids_of_whole_texts(texts):
    encoder, tokenizer = token_files._encoder(FILE), whole()
    found = encoder.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_round_trip(spark):
    tokenizer = whole()
    rows = token_files.round_trip(spark.createDataFrame(ODD, SCHEMA), FILE).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    rows = sorted(rows, key=lambda row: row["start"])
    assert [row["key"] for row in rows] == [r[0] for r in order]
    for row, (_, text, *_) in zip(rows, order):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(row["ids"], f"<u{row['width']}").tolist() == ids
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_empty_table_and_damage(spark, tmp_path):
    none = spark.createDataFrame([], T.StructType.fromDDL(SCHEMA) if hasattr(T.StructType, "fromDDL") else SCHEMA)
    assert token_files.round_trip(none, FILE).count() == 0
    shard = token_files._Shard(str(tmp_path))
    shard.add(1, b"abcd", 2)
    made = shard.close()
    data = bytearray(open(made["records"], "rb").read())
    data[13] ^= 1
    open(made["records"], "wb").write(data)
    with open(made["records"], "rb") as records, open(made["index"], "rb") as index:
        try:
            list(token_files._bodies(records, index.read()))
        except ValueError as error:
            assert "damaged" in str(error)
        else:
            raise AssertionError("damage went unseen")


def test_queries_over_the_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    docs = {row["doc_id"]: row["text"] or "" for row in catalog.table(spark, directory, "documents").collect()}
    encoding, tokenizer = byte_pairs.encoder(RANKS, PATTERN), whole()
    rows = catalog.op1_byte_pairs(spark, directory).collect()
    digest = lambda data: hashlib.sha256(data).hexdigest()
    expected = {k: (len(ids := encoding.encode_ordinary(t)), digest(" ".join(map(str, ids)).encode()), digest(t.encode())) for k, t in docs.items()}
    assert {row["doc_id"]: (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) for row in rows} == expected
    at = 0
    for row in sorted(catalog.op8_token_files(spark, directory).collect(), key=lambda row: row["doc_id"]):
        ids = [*tokenizer.encode(docs[row["doc_id"]], add_special_tokens=False).ids, 0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y, <|endoftext|><|endoftext|> ", "<|endoftext |> <|endoftext", "plain text, as before", None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", " ", "\n", "ab", ".", "é"]), max_size=8).map("".join), max_size=6))
def test_added_tokens_as_the_library_reads_them(texts):
    encoder, tokenizer = token_files._encoder(FILE, True), Tokenizer.from_file(FILE)
    found = encoder.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_reads_added_tokens(spark, tmp_path):
    spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, at = Tokenizer.from_file(FILE), 0
    assert 50256 in tokenizer.encode(ADDED[0], add_special_tokens=False).ids
    rows = sorted(catalog.op8_token_files(spark, str(tmp_path)).collect(), key=lambda row: row["start"])
    assert [row["doc_id"] for row in rows] == list(range(len(ADDED)))
    for row, text in zip(rows, ADDED):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


GROWTH = """
import resource, pyarrow as pa
from shopscope.llm import token_files
def words(first, count):
    letters = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(5))
    return [" ".join(letters(n * 7919) + letters(n) for n in range(at, at + 100)) for at in range(first, first + count, 100)]
encoder, most = token_files.Encoder({file!r}, True), lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
encoder.encode(pa.array(words(0, 1000)))
before = most()
for lot in range(4):
    encoder.encode(pa.array(words(1000 + lot * 100_000, 100_000)))
print((most() - before) // 1024)
"""


def test_memory_does_not_grow_with_the_words_met():
    """400,000 distinct words in four batches of 1 MB; results are dropped after each."""
    root = str(pathlib.Path(token_files.__file__).parents[2])
    ran = subprocess.run([sys.executable, "-c", GROWTH.format(file=FILE)], cwd=root, capture_output=True, text=True, check=True)
    assert int(ran.stdout) < 100, f"{ran.stdout.strip()} MB"


def test_joined_units_give_the_ids_of_whole_texts():
    encoder, tokenizer, draw = token_files._encoder(FILE, True), Tokenizer.from_file(FILE), random.Random(5)
    letters = "ab'st é×ªɐ\n\t\x85　 .,-_#$%&()*+/<=>@[]^`{|}~\\\"19"
    texts = ["".join(draw.choice(letters) + draw.choice(["", "", " "]) for _ in range(draw.randrange(40))) for _ in range(5000)]
    texts += ["", "z" * 40_000, " ".join(["z" * 9000, "y" * 20_000, "x"])]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(pa.array([], pa.string())) == []
