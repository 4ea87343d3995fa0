"""Word shingles of whole texts as 64-bit hashes, for many texts at once.

Words are the text's parts between white space, in lower case, without signs at their ends; parts without a letter or
digit are no words. A shingle is ``SIZE`` words in a row; a text with fewer words, but at least one, is one shingle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SIZE = 5
ENDS = re.compile(r"^[\W_]+|[\W_]+$")
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stride(number: int) -> np.uint64:
    """So many steps of a 64-bit counter."""
    return np.uint64(int(STEP) * number & 0xFFFFFFFFFFFFFFFF)


class Words:
    """Hashes of the words of a batch of texts: ``hashes[bounds[i]:bounds[i + 1]]`` belong to text i."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        table = lists.values.dictionary_encode()
        bare = [ENDS.sub("", word) for word in table.dictionary.to_pylist()]
        distinct = np.array([xxhash.xxh3_64_intdigest(word) if word else 0 for word in bare], np.uint64)
        kept = np.array([bool(word) for word in bare], bool)
        codes = table.indices.to_numpy().astype(np.int64)
        held = kept[codes] if len(codes) else np.zeros(0, bool)
        before = np.concatenate([[0], np.cumsum(held)])
        self.hashes = distinct[codes[held]] if len(codes) else np.zeros(0, np.uint64)
        self.bounds = before[offsets]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def prints(self, texts: pa.Array) -> list[bytes]:
        """16 bytes that are equal for texts of equal words in equal order; of texts without words, for equal texts."""
        return [
            xxhash.xxh3_128_digest(self.hashes[a:b].tobytes()) if b > a else xxhash.xxh3_128_digest(b"\0" + (texts[n].as_py() or "").encode())
            for n, (a, b) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()))
        ]

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, hash and count of each distinct shingle, by text and hash."""
        sizes = np.diff(self.bounds)
        per_text = np.where(sizes >= SIZE, sizes - SIZE + 1, np.minimum(sizes, 1))
        owner = np.repeat(np.arange(len(sizes)), per_text)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text) + self.bounds[:-1][owner]
        found = np.zeros(len(owner), np.uint64)
        short = sizes[owner] < SIZE
        for step in range(SIZE):
            inside = step < sizes[owner]
            word = self.hashes[np.where(inside, place + step, 0)] if len(self.hashes) else found
            found = np.where(inside, mix(found * STEP + word), found)
        found[short] = mix(found[short] + sizes[owner][short].astype(np.uint64))
        order = np.lexsort((found, owner))
        owner, found = owner[order], found[order]
        first = np.ones(len(owner), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
        starts = np.flatnonzero(first)
        return owner[starts], found[starts], np.diff(np.append(starts, len(owner)))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets of sorted hashes and their counts."""
    (left, n_left), (right, n_right) = a, b
    if len(left) > len(right):
        (left, n_left), (right, n_right) = (right, n_right), (left, n_left)
    at = np.minimum(np.searchsorted(right, left), max(0, len(right) - 1))
    common = np.minimum(n_left, n_right[at])[right[at] == left].sum() if len(left) else 0
    total = n_left.sum() + n_right.sum() - common
    return float(common / total) if total else 0.0
