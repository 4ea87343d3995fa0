"""Token ids in length-delimited binary files with an offset index beside each.

A record is: payload length (8 bytes), masked checksum of those 8 bytes (4), payload, masked checksum of the
payload (4); all integers little-endian. The payload holds the ids of one document, two bytes each if the
vocabulary allows, else four. The checksum is CRC-32, masked by rotating it right by 15 bits and adding a
constant, so that a checksum of data that hold checksums stays meaningful. The index holds one fixed-size
entry a record (key, whether the key is null, position in the file, number of ids), so that any record can be
read alone and shuffled reads need no scan.

Documents are range-partitioned by key and text and written in that order; each task rolls over to a new file at
``FILE_BYTES``. A manifest row a file carries its order and number of ids, from which the first position of
every document follows. Attempts write under names of their own; the manifest lists those of successful ones.

Defined cases: a null text counts as empty (its record holds the end id alone); null keys come first; rows that
repeat a key stay, next to each other in no set order; an empty table gives no files and no rows; keys are integers.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded, gathered, pieces
from shopscope.llm.storage import Output, reader
from shopscope.sources.workspace import Workspace

#: A file is closed once it has this many bytes.
FILE_BYTES = 32 << 20
#: Texts of about so many bytes are encoded together; more of them hold fewer distinct units each.
BATCH_BYTES = 16 << 20
#: Units of about so many bytes are handed to the tokenizer at once. Its results take far more memory than the ids.
AT_ONCE = 16 << 10
INDEX_ENTRY = struct.Struct("<q?QQ")
SPACE = r"\pZ\t-\r\x{85}"
#: A blank that has white space on its left, and white space or nothing on its right: cutting before it would change the ids.
UNSAFE = f"[{SPACE}] ([{SPACE}]|\\z)"
#: A unit that still has a match start at its blank if other such units stand before and after it.
JOINABLE = f"\\A[^{SPACE}](.*[^{SPACE}])?\\z"
#: Punctuation after a word of Latin letters is a match of its own; with an apostrophe it need not be.
MARKS, LATIN = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def regex_quoted(text: str) -> str:
    """A pattern for just this text, in Arrow's regular expressions."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class Encoder:
    """Whole texts to ids by a byte-level tokenizer file, each distinct unit between blanks once a batch.

    The tokenizer's pattern starts a new match before every blank that follows something other than white space,
    or that ends a run of white space before a word. Texts are cut there in one vectorised pass, words are parted
    from the punctuation after them, and what is distinct is joined by blanks again and encoded: where an id's
    token begins with a blank, the next unit begins. A text with a blank for which this doesn't hold (UNSAFE) is
    encoded as a whole. With ``added``, the strings of added tokens in a text are these tokens, as in the library's
    default, and texts that hold one are encoded as a whole too; else they are ordinary text.

    Nothing is kept from batch to batch, so memory follows the batch and not the words a worker has met.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        strings = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "|".join(map(regex_quoted, strings)) if added else ""
        self.joins = not any(" " in string for string in strings)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.blank_first = np.zeros(size, bool)
        self.blank_first[[number for token, number in vocabulary.items() if token.startswith("\u0120")]] = True

    def _binary(self, ids: list[np.ndarray], lengths: np.ndarray) -> pa.Array:
        """The bytes of so many ids each."""
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]) * self.dtype.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate([*ids, np.zeros(0, self.dtype)]))])

    @staticmethod
    def _bounds(units: pa.Array) -> np.ndarray:
        """Where to cut the units into lots of about AT_ONCE bytes."""
        ends = np.cumsum(pc.binary_length(units).to_numpy() + 1)
        return np.unique([0, *np.flatnonzero(np.diff(ends // AT_ONCE)) + 1, len(units)]).astype(np.int32)

    def _apart(self, units: pa.Array, before: str = "") -> pa.Array:
        """The ids of each unit with ``before`` in front, as bytes."""
        found, lengths, bounds = [], np.zeros(len(units), np.int64), self._bounds(units)
        for a, b in zip(bounds[:-1], bounds[1:]):
            encoding = self.tokenizer.encode([before + unit for unit in units[a:b].to_pylist()], is_pretokenized=True, add_special_tokens=False)
            found.append(np.array(encoding.ids, self.dtype))
            lengths[a:b] = np.bincount(np.array(encoding.word_ids, np.int64), minlength=b - a)
        return self._binary(found, lengths)

    def _joined(self, units: pa.Array) -> pa.Array:
        """The ids of each unit with a blank in front, as bytes; all are joinable."""
        lots = pa.ListArray.from_arrays(pa.array(self._bounds(units)), units)
        texts = pc.binary_join(lots, pa.scalar(" ", units.type)).to_pylist()
        found = [np.array(self._whole(f" {text}"), self.dtype) for text in texts]
        ids = np.concatenate([*found, np.zeros(0, self.dtype)])
        starts = np.flatnonzero(self.blank_first[ids])
        if len(starts) != len(units) or len(units) and starts[0]:
            raise ValueError(f"{len(units)} units gave {len(starts)} tokens that begin with a blank")
        return self._binary([ids], np.diff(starts, append=len(ids)))

    def _whole(self, text: str) -> list[int]:
        """The ids of a text, without what else the library tells of them."""
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _blanked(self, units: pa.Array) -> pa.Array:
        """The ids of each distinct unit with a blank in front, as bytes."""
        joinable = pc.match_substring_regex(units, f"(?s){JOINABLE}") if self.joins else pa.array(np.zeros(len(units), bool))
        order = np.argsort(~joinable.to_numpy(zero_copy_only=False), kind="stable")
        found = pa.concat_arrays([self._joined(units.filter(joinable)), self._apart(units.filter(pc.invert(joinable)), " ")])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return found.take(pa.array(back))

    def _coded(self, units: pa.Array) -> pa.Array:
        """The same, by words and the punctuation after them."""
        words = pc.utf8_rtrim(units, MARKS)
        cut = pc.and_(pc.not_equal(pc.binary_length(words), pc.binary_length(units)), pc.match_substring_regex(words, f"\\A[{LATIN}]+\\z"))
        heads = pc.if_else(cut, words, units).dictionary_encode()
        marks = pc.if_else(cut, pc.replace_substring_regex(units, f"\\A[{LATIN}]+", ""), "").dictionary_encode()
        tails = self._apart(marks.dictionary).take(marks.indices)
        return pc.binary_join_element_wise(self._blanked(heads.dictionary).take(heads.indices), tails, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = pc.match_substring_regex(texts, f"{UNSAFE}|{self.added}" if self.added else UNSAFE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        offsets = lists.offsets.to_numpy()
        table = lists.values.dictionary_encode()
        # every unit but the first of a text has a blank in front
        firsts = lists.values.take(pa.array(offsets[:-1])).dictionary_encode()
        known = pa.concat_arrays([self._coded(table.dictionary), self._apart(firsts.dictionary)])
        codes = table.indices.to_numpy().copy()
        codes[offsets[:-1]] = len(table.dictionary) + firsts.indices.to_numpy()
        taken = known.take(pa.array(codes))
        _, ends, data = taken.buffers()
        ids = np.frombuffer(data or b"", self.dtype)
        bounds = np.frombuffer(ends, np.int64)[offsets] // self.dtype.itemsize
        found = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for at in np.flatnonzero(whole):
            found[at] = np.array(self._whole(texts[int(at)].as_py()), self.dtype)
        return found


@functools.lru_cache(maxsize=2)
def _encoder(path: str, added: bool = False) -> Encoder:
    return Encoder(path, added)


class _Shard:
    """One file of records and its index."""

    def __init__(self, folder: str):
        self.records = Output(folder, ".records")
        self.index: list[bytes] = []
        self.tokens = 0

    def add(self, key: int | None, payload: bytes, tokens: int) -> None:
        length = struct.pack("<Q", len(payload))
        at = self.records.write(b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))))
        self.index.append(INDEX_ENTRY.pack(key or 0, key is None, at, tokens))
        self.tokens += tokens

    def close(self) -> dict:
        self.records.close()
        index = Output(self.records.uri.rsplit("/", 1)[0], ".index")
        index.write(b"".join(self.index))
        index.close()
        return {"records": self.records.uri, "index": index.uri, "documents": len(self.index), "tokens": self.tokens}


MANIFEST = "partition int, file int, records string, index string, documents long, tokens long, width int"


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """Encode and write all documents in ascending order of key; returns the manifest, one row a file, lazily.

    Materialise the manifest before reading the files.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, partition = _encoder(tokenizer_file, added), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        shard, closed = None, []
        for batch in pieces(gathered(batches, BATCH_BYTES), 16_000, 1, BATCH_BYTES):
            for own, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                shard = shard or _Shard(folder)
                shard.add(own, ids.tobytes() + end, len(ids) + 1)
                if shard.records.size >= FILE_BYTES:
                    closed.append(shard.close())
                    shard = None
        closed += [shard.close()] if shard else []
        if closed:
            yield pa.RecordBatch.from_pylist(
                [{"partition": partition, "file": n, **row, "width": encoder.dtype.itemsize} for n, row in enumerate(closed)],
                schema=pa.schema([("partition", pa.int32()), ("file", pa.int32()), ("records", pa.string()), ("index", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]),
            )

    bounded(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", F.xxhash64("body")).sortWithinPartitions("key", "body")
    return ordered.mapInArrow(task, MANIFEST)


def _bodies(records, index: bytes) -> Iterator[tuple[int | None, bytes]]:
    """Key and payload of each record, read front to back in large blocks."""
    for own, missing, at, _ in INDEX_ENTRY.iter_unpack(index):
        records.seek(at)
        head = records.read(12)
        (length,) = struct.unpack("<Q", head[:8])
        if masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
            raise ValueError(f"damaged record length at {at}")
        body = records.read(length + 4)
        if masked(body[:length]) != struct.unpack("<I", body[length:])[0]:
            raise ValueError(f"damaged record at {at}")
        yield None if missing else own, body[:length]


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All records by file: key, start (ids of all documents before it), n_tokens, ids_crc32 and the raw ids.

    The manifest has a row per file of tens of MB; its rows (not the records) go through the driver to number the
    files' first positions.
    """
    rows = sorted(manifest.collect(), key=lambda row: (row["partition"], row["file"]))
    start, tasks = 0, []
    for row in rows:
        tasks.append((row["records"], row["index"], row["width"], start))
        start += row["tokens"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])
        for batch in batches:
            for file in batch.to_pylist():
                with reader(file["records"]) as records, reader(file["index"]) as index:
                    at, held, entries = file["start"], [], index.read()
                    for own, payload in _bodies(records, entries):
                        ids = np.frombuffer(payload, f"<u{file['width']}").astype("<u4")
                        held.append({"key": own, "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes()), "width": file["width"], "ids": payload})
                        at += len(ids)
                        if len(held) >= 1000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.createDataFrame(tasks or [("", "", 2, 0)], "records string, index string, width int, start long")
    if not tasks:
        files = files.where("false")
    return files.repartition(max(1, len(tasks))).mapInArrow(task, "key long, start long, n_tokens long, ids_crc32 long, width int, ids binary")


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int = 0, key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """Write all documents below the shared work folder and read the files back."""
    spark = docs.sparkSession
    workspace = Workspace(spark)
    manifest = workspace.store("manifest", write(docs, workspace.location("files"), tokenizer_file, end_id, key, text, added))
    return read(spark, manifest)
