"""Lockstep alignment against a plain double loop."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopscope.llm import catalog, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, groups string"
ODD = [
    (1, "wörd ñandú, 東京 123 4567. it's  two   blanks \n\t x", "x", "y"),
    (2, None, None, None),
    (2, "", None, None),
    (None, "no key", None, None),
    (9, "<|endoftext|> <s> </s> <unk> <0x41> it's", None, None),
    (9, "<|endoftext|> <s> </s> <unk> <0x41> it's", None, None),
    (4, "a mark ▁ that reads as a blank", None, None),
    (5, "   ", None, None),
    (7, "long wörds and ñandú, 東京 123. " * 4000, None, None),
    (8, "x" * 20_000 + "  \U0001f600́", None, None),
]


def brute_force(rows):
    """By the definitions: one document after the other, links by overlap of byte ranges."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    to_byte = token_alignment.byte_of_character()
    made, counts = [], Counter()
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(raw_a) != b"".join(raw_b) or b"".join(raw_a) != (" " + text).encode():
            made.append((key, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, raw_a))).tolist(), np.cumsum(list(map(len, raw_b))).tolist()
        links, first = [], 0
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            for j in range(first, len(ends_b)):
                low = ends_b[j - 1] if j else 0
                if low >= end:
                    break
                if ends_b[j] <= start:
                    first = j
                    continue
                links.append((ids_a[i], ids_b[j]))
        counts.update(links)
        common = sorted(set(ends_a) & set(ends_b))
        groups, at_a, at_b = [], 0, 0
        for end in common:
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        made.append((key, ids_a, ids_b, groups, links))
    highest = {}
    for (_, other), n in counts.items():
        highest[other] = max(n, highest.get(other, 0))
    return counts, [
        (key, len(x), len(y), len(g), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for key, x, y, g, links in made
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(row) for row in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("documents", [1, 20_000])
def test_odd_texts(spark, workspace, documents):
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    found = token_alignment.align(docs, A, B, workspace, with_groups=True, block_documents=documents)
    counts, expected = brute_force([row[:2] for row in ODD])
    assert rows_of(found.documents) == sorted(expected, key=str)
    assert {(r["a_id"], r["b_id"]): r["count"] for r in found.pairs.collect()} == counts
    for row in found.documents.collect():
        assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] or row["groups"] == row["groups_sha256"] == ""


def test_lanes_and_pieces_change_nothing(monkeypatch):
    pair = token_alignment.Pair(A, B)
    texts = [row[1] for row in ODD]
    ids = pair.tokens(texts)
    rows, keys, times = token_alignment.walk(*ids, pair)
    monkeypatch.setattr(token_alignment, "LANE", 5)
    monkeypatch.setattr(token_alignment, "PIECE", 11)
    again = pair.tokens(texts)
    assert all((x == y).all() for old, new in zip(ids, again) for x, y in zip(old, new))
    cut_rows, cut_keys, cut_times = token_alignment.walk(*again, pair)
    assert rows == cut_rows and (keys == cut_keys).all() and (times == cut_times).all()


def test_empty_table(spark, workspace):
    docs = spark.createDataFrame([], SCHEMA)
    empty = token_alignment.align(docs, A, B, workspace)
    assert empty.documents.count() == empty.pairs.count() == 0


def test_query_over_the_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in catalog.table(spark, directory, "documents").select("doc_id", F.col("text")).collect()]
    assert rows_of(catalog.op13_token_alignment(spark, directory)) == sorted(brute_force(docs)[1], key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t .,'1  ▁東<>0xA\x00\x85\x1c\u2028\u3000", min_size=1, max_size=30), min_size=1, max_size=5))
def test_parts_give_the_ids_of_whole_texts(texts):
    pair = token_alignment._pair(A, B)
    for text, ids_a, ids_b in zip(texts, *pair.tokens(texts)):
        whole_a, whole_b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        expected = (whole_a, whole_b) if pair.same(text, whole_a, whole_b) else ([], [])
        assert (ids_a.tolist(), ids_b.tolist()) == expected
