"""Byte-level BPE encoding and decoding with a local rank file.

The rank file (base64 token and rank a line) goes to every task by its path, which must exist on each
executor, as with any installed package. Each task builds the encoder once. Long texts are cut where
the split pattern must start a new match (a single blank between letters or digits), and the ids are those of the whole
text; a stretch without such a place, as of Chinese or base64, goes to the library in one call.

Defined cases: a null text counts as empty and gives no ids; special tokens are ordinary text; decoding
gives raw bytes, as ids may end within a character; null ids decode to null; an id outside the ranks raises.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded

#: Characters handed to the library at once; longer texts are cut at the next safe boundary.
PIECE = 1 << 16
#: A letter or digit, then a single blank, then another one: a match never spans the place before the blank.
SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?= [\p{L}\p{N}])")


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(text: str, piece: int = PIECE) -> Iterator[str]:
    """The text in pieces of about that many characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > piece:
        boundary = SAFE.search(text, start + piece)
        if boundary is None:
            break
        yield text[start : boundary.start()]
        start = boundary.start()
    yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str | None, piece: int = PIECE) -> list[int]:
    if not text:
        return []
    if len(text) <= piece:
        return encoding.encode_ordinary(text)
    return [token for part in cut(text, piece) for token in encoding.encode_ordinary(part)]


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """The token ids of each text, ``array<int>``."""
    bounded()

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoder(rank_file, pattern)
        for batch in texts:
            yield pd.Series([encode_text(encoding, value) for value in batch], dtype=object)

    return ids(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes of each array of ids."""

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoder(rank_file, pattern)
        for batch in batches:
            yield pd.Series([None if value is None else encoding.decode_bytes(value.tolist()) for value in batch], dtype=object)

    return raw(ids)


def digest(text: Column, rank_file: str, pattern: str, with_ids: bool = False) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256, and of the ids only if asked for.

    The ids are encoded as by ``encode`` and decoded as by ``decode``; the second digest is that of the decoded bytes.
    """
    bounded()
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    def summary(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoding = encoder(rank_file, pattern)
        for batch in texts:
            rows = []
            for value in batch:
                tokens = encode_text(encoding, value)
                rows.append(
                    (
                        len(tokens),
                        hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest(),
                        hashlib.sha256(encoding.decode_bytes(tokens)).hexdigest(),
                        *[tokens] * with_ids,
                    )
                )
            yield pd.DataFrame(rows, columns=names)

    return summary(text)
