"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

Both tokenizers read a blank and the text. A token of A and one of B are linked if their byte ranges overlap; offsets
where tokens of both end cut the tokens into groups. A task walks all documents of a batch in lockstep: one vector of
pointers into A's tokens, one into B's. Each step emits the links under the pointers, notes the cuts where both tokens
end, advances whichever token ends first (or both), and drops the lanes that are finished. Long documents take several
lanes, which begin and end at cuts, so that a long text doesn't leave a narrow vector walking alone.

The number of links a pair of ids has in the corpus is needed for every link again. A task therefore closes a block of
documents after some megabytes: one file on shared storage holds each document's results and its pairs as places in
the block's sorted list of distinct pairs, with how often it has them; one row holds that list. The lists are counted
by pair, joined with the counts, and go back to their blocks, whose files are then read once. So a frequent pair is
shuffled once a block, never once a link, and texts are encoded once.

Defined cases: null and empty texts have no tokens, and neither have texts whose joined tokens of either side aren't
the bytes of blank and text (a tokenizer that normalises, or marks blanks by a character that the text holds); their
numbers are 0 and their digest is empty. Rows that repeat a key, null keys and equal texts are documents of their own;
special tokens' strings are ordinary text; an empty table gives no rows. Ties for the highest count all count as best.
Other columns of the table aren't read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded, gathered, pieces
from shopscope.llm.storage import Output, reader
from shopscope.session import shuffle_width
from shopscope.sources.workspace import Workspace

Array = np.ndarray

#: Bytes of text whose tokens are walked together.
BATCH_BYTES = 1 << 20
#: A block is closed once it has so many bytes of text, or so many documents.
BLOCK_BYTES, BLOCK_DOCUMENTS = 8 << 20, 20_000
#: A lane has about so many tokens of A; it ends at the next cut.
LANE = 1500
#: Characters handed to sentencepiece at once; longer texts are cut at the next blank between other characters.
PIECE = 1 << 16
BLANK = re.compile(r"(?<=\S) (?=\S)")
#: A text with a blank at an end or beside other white space, or with B's mark for blanks, isn't cut into parts.
WHOLE = re.compile(r"^ | $|\s | \s|▁")
#: Distinct parts whose ids a task remembers; beyond it, it forgets all of them.
REMEMBERED = 700_000
#: An id pair is one number: A's id above these bits, B's below.
SHIFT = 16


def byte_of_character() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class Pair:
    """Both tokenizers, with the bytes of their tokens by id.

    Most texts can be cut before every blank: A's pattern starts a match there, and no merge of B crosses the place if no
    piece goes on with a blank. Each distinct part is encoded, and compared with its bytes, once for as long as it is
    remembered. Texts with blanks beside other white space go to both libraries as a whole.
    """

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        to_byte = byte_of_character()
        names = [self.a.id_to_token(n) for n in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(map(to_byte.get, name)) if all(c in to_byte for c in name) else name.encode() for name in names]
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(n) else piece.replace("▁", " ").encode() for n, piece in enumerate(pieces)
        ]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << SHIFT:
            raise ValueError("vocabularies of more than 65,536 ids are not supported")
        self.a_lengths, self.b_lengths = (np.array(list(map(len, table)), np.int64) for table in (self.a_bytes, self.b_bytes))
        self.cuttable = not any("▁" in piece.lstrip("▁") for piece in pieces)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.equal = np.zeros(0, bool)
        self.pools = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def same(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether both sides' bytes are those of blank and text."""
        raw = f" {text}".encode()
        return b"".join([self.a_bytes[i] for i in ids_a]) == raw and b"".join([self.b_bytes[i] for i in ids_b]) == raw

    def _learn(self, parts: list[str]) -> None:
        encoding = self.a.encode([f" {part}" for part in parts], is_pretokenized=True, add_special_tokens=False)
        owners = np.array(encoding.word_ids, np.int64)
        bounds = np.searchsorted(owners, np.arange(len(parts) + 1)).tolist()
        ids = encoding.ids
        sides = [[ids[low:high] for low, high in zip(bounds[:-1], bounds[1:])], self.b.encode(parts, num_threads=1)]
        self.equal = np.concatenate([self.equal, [self.same(part, x, y) for part, x, y in zip(parts, *sides)]])
        for n, found in enumerate(sides):
            self.pools[n] = np.concatenate([self.pools[n], np.array([i for own in found for i in own], np.int32)])
            self.starts[n] = np.concatenate([self.starts[n], self.starts[n][-1] + np.cumsum(list(map(len, found)))])
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts))))

    def _by_parts(self, texts: list[str]) -> Iterator[tuple[Array, Array]]:
        if len(self.known) > REMEMBERED:
            self._forget()
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        table = lists.values.dictionary_encode()
        distinct = table.dictionary.to_pylist()
        if new := [part for part in distinct if part not in self.known]:
            self._learn(new)
        own = np.array([self.known[part] for part in distinct], np.int64)[table.indices.to_numpy()]
        offsets = lists.offsets.to_numpy()
        wrong = np.concatenate([[0], np.cumsum(~self.equal[own])])[offsets]
        sides = []
        for pool, starts in zip(self.pools, self.starts):
            lengths = starts[own + 1] - starts[own]
            ends = np.cumsum(lengths)
            flat = pool[np.repeat(starts[own] - (ends - lengths), lengths) + np.arange(ends[-1])].astype(np.int64)
            bounds = np.concatenate([[0], ends])[offsets].tolist()
            sides.append([flat[low:high] for low, high in zip(bounds[:-1], bounds[1:])])
        none = np.zeros(0, np.int64)
        for ok, ids_a, ids_b in zip(np.diff(wrong) == 0, *sides):
            yield (ids_a, ids_b) if ok else (none, none)

    def encode_whole_b(self, text: str) -> list[int]:
        """Long texts are cut before blanks between other characters; the library puts a blank in front of what it gets."""
        found, start = [], 0
        while self.cuttable and len(text) - start > PIECE and (blank := BLANK.search(text, start + PIECE)):
            found += self.b.encode(text[start : blank.start()], num_threads=1)
            start = blank.end()
        return found + self.b.encode(text[start:], num_threads=1)

    def _whole(self, text: str) -> tuple[Array, Array]:
        ids_a, ids_b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.encode_whole_b(text)
        if not self.same(text, ids_a, ids_b):
            ids_a, ids_b = [], []
        return np.array(ids_a, np.int64), np.array(ids_b, np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[list[Array], list[Array]]:
        """A's and B's ids of each text; none where either side's bytes are not those of blank and text."""
        none = np.zeros(0, np.int64)
        parted = [bool(text) and self.cuttable and not WHOLE.search(text) for text in texts]
        own = [text for text, yes in zip(texts, parted) if yes]
        found = self._by_parts(own) if own else iter(())
        both = [next(found) if yes else self._whole(text) if text else (none, none) for text, yes in zip(texts, parted)]
        return [ids for ids, _ in both], [ids for _, ids in both]


@functools.lru_cache(maxsize=1)
def _pair(a_file: str, b_file: str) -> Pair:
    return Pair(a_file, b_file)


def lockstep(ends_a: Array, ends_b: Array, at_a: Array, at_b: Array, stop_a: Array) -> tuple[Array, Array, Array]:
    """Links (places in A's and B's tokens) and whether both tokens end there, of all lanes at once.

    A lane runs from its first tokens to A's place ``stop_a``, before which both sides end at one offset.
    """
    links_a, links_b, cuts = [], [], []
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        links_a.append(at_a)
        links_b.append(at_b)
        cuts.append(end_a == end_b)
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        running = at_a < stop_a
        if not running.all():
            at_a, at_b, stop_a = at_a[running], at_b[running], stop_a[running]
    if not cuts:
        none = np.zeros(0, np.int32)
        return none, none, np.zeros(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


def lanes(ends_a: Array, ends_b: Array, bounds_a: Array, bounds_b: Array) -> tuple[Array, Array, Array]:
    """First places in A and B, and the end in A, of each lane.

    Offsets must grow over all documents. A document of more than one lane's tokens is divided at the first common ends
    after every ``LANE`` tokens.
    """
    starts_a, starts_b, stops = [], [], []
    for low_a, high_a, low_b, high_b in zip(bounds_a[:-1].tolist(), bounds_a[1:].tolist(), bounds_b[:-1].tolist(), bounds_b[1:].tolist()):
        while high_a - low_a > LANE:
            near, width, cut = low_a + LANE, 64, -1
            while near < high_a:
                window = ends_a[near : min(near + width, high_a)]
                places = low_b + np.searchsorted(ends_b[low_b:high_b], window)  # below high_b: the last offsets are equal
                common = np.flatnonzero(ends_b[places] == window)
                if len(common):
                    cut, cut_b = near + int(common[0]) + 1, int(places[common[0]]) + 1
                    break
                near, width = near + width, 2 * width
            if cut < 0 or cut >= high_a:
                break
            starts_a.append(low_a)
            starts_b.append(low_b)
            stops.append(cut)
            low_a, low_b = cut, cut_b
        if high_a > low_a:
            starts_a.append(low_a)
            starts_b.append(low_b)
            stops.append(high_a)
    return np.array(starts_a, np.int32), np.array(starts_b, np.int32), np.array(stops, np.int32)


@functools.lru_cache(maxsize=1)
def _decimals() -> tuple[Array, Array]:
    """Digits of every id with each of three separators behind, padded with zero bytes, and their lengths."""
    text = np.char.add(np.arange(1 << SHIFT).astype("S5")[None, :], np.array([b",", b"|", b";"], "S1")[:, None]).astype("S6")
    return text.view(np.uint8).reshape(3, 1 << SHIFT, 6), np.char.str_len(text)


def written(ids_a: Array, ids_b: Array, last_a: Array, last_b: Array, bounds_a: Array, bounds_b: Array) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document: A's and B's ids by group, in order."""
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    groups = int(last_a.sum())
    before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (group_a, group_b))
    place_a = np.arange(len(ids_a)) + before_b[group_a]
    place_b = np.arange(len(ids_b)) + before_a[group_b + 1]
    merged, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.int64)
    merged[place_a], merged[place_b] = ids_a, ids_b
    mark[place_a], mark[place_b] = np.where(last_a, 1, 0), np.where(last_b, 2, 0)
    digits, lengths = _decimals()
    raw = digits[mark, merged].ravel()
    raw = raw[raw != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[mark, merged])])[bounds_a + bounds_b]
    return [raw[low : max(low, high - 1)] for low, high in zip(ends[:-1].tolist(), ends[1:].tolist())]


def walk(ids_a: list[Array], ids_b: list[Array], pair: Pair) -> tuple[list[dict], Array, Array]:
    """Results of each document, and its distinct pairs (document above 32 bits, pair below) with their numbers of links."""
    bounds_a, bounds_b = (np.concatenate([[0], np.cumsum([len(ids) for ids in side])]).astype(np.int64) for side in (ids_a, ids_b))
    flat_a, flat_b = np.concatenate([*ids_a, np.zeros(0, np.int64)]), np.concatenate([*ids_b, np.zeros(0, np.int64)])
    # both sides of a document have the same bytes, so running sums over all documents stay comparable
    ends_a, ends_b = np.cumsum(pair.a_lengths[flat_a]), np.cumsum(pair.b_lengths[flat_b])
    link_a, link_b, cut = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, bounds_a, bounds_b))
    last_a, last_b = np.zeros(len(flat_a), bool), np.zeros(len(flat_b), bool)
    last_a[link_a[cut]], last_b[link_b[cut]] = True, True
    owner = np.repeat(np.arange(len(ids_a)), np.diff(bounds_a))
    texts = written(flat_a, flat_b, last_a, last_b, bounds_a, bounds_b)
    groups, links = np.bincount(owner, last_a, len(ids_a)).astype(int), np.bincount(owner[link_a], minlength=len(ids_a))
    rows = [
        {"n_a": len(a), "n_b": len(b), "n_groups": int(g), "n_links": int(n), "groups": text}
        for a, b, g, n, text in zip(ids_a, ids_b, groups, links, texts)
    ]
    keys, times = np.unique(owner[link_a] << 32 | flat_a[link_a] << SHIFT | flat_b[link_b], return_counts=True)
    return rows, keys, times


DOCUMENT = pa.schema(
    [("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())]
    + [("groups_sha256", pa.string()), ("groups", pa.string()), ("steps", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
)


class _Block:
    """Documents whose pairs are listed together."""

    def __init__(self):
        self.rows: list[dict] = []
        self.keys: list[Array] = []
        self.times: list[Array] = []
        self.size = 0

    def add(self, own: list[int | None], rows: list[dict], keys: Array, times: Array, size: int, with_groups: bool) -> None:
        self.keys.append(keys + (len(self.rows) << 32))
        self.times.append(times)
        for key, row in zip(own, rows):
            text = row.pop("groups")
            row |= {"key": key, "groups_sha256": hashlib.sha256(text).hexdigest() if text else ""}
            row["groups"] = text.decode() if with_groups else None
        self.rows += rows
        self.size += size

    def close(self, folder: str, number: int) -> pa.RecordBatch:
        """Write the documents; the row of the block."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        pairs, place = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(keys >> 32, minlength=len(self.rows)))]).astype(np.int32)
        steps = np.diff(place, prepend=0)  # places grow within a document; small steps compress well
        starts = bounds[:-1][np.diff(bounds) > 0]
        steps[starts] = place[starts]
        columns = [pa.array([row[name] for row in self.rows], DOCUMENT.field(name).type) for name in DOCUMENT.names[:-2]]
        columns += [pa.ListArray.from_arrays(bounds, pa.array(values.astype(np.int32))) for values in (steps, times)]
        out = Output(folder, ".arrow")
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, DOCUMENT, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=DOCUMENT))
        out.write(sink.getvalue())
        out.close()
        uses = np.bincount(place, times, len(pairs)).astype(np.int64)
        values = {"block": [number], "file": [out.uri], "pairs": [pairs], "uses": [uses]}
        return pa.RecordBatch.from_pydict(values, schema=BLOCK)


BLOCK = pa.schema([("block", pa.int64()), ("file", pa.string()), ("pairs", pa.list_(pa.int64())), ("uses", pa.list_(pa.int64()))])


def blocks(docs: DataFrame, a_file: str, b_file: str, folder: str, key: str, text: str, with_groups: bool, block_documents: int) -> DataFrame:
    """Encode and walk all documents; a row a block, lazily."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number, block = _pair(a_file, b_file), TaskContext.get().partitionId() << 32, _Block()
        for batch in pieces(gathered(batches, BATCH_BYTES), min(4000, block_documents), 1, BATCH_BYTES):
            texts = batch.column(1).to_pylist()
            rows, keys, times = walk(*pair.tokens(texts), pair)
            block.add(batch.column(0).to_pylist(), rows, keys, times, batch.column(1).nbytes, with_groups)
            if block.size >= BLOCK_BYTES or len(block.rows) >= block_documents:
                yield block.close(folder, number)
                number, block = number + 1, _Block()
        if block.rows:
            yield block.close(folder, number)

    bounded(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(task, "block long, file string, pairs array<long>, uses array<long>")


def _results(stream: Iterator[pa.RecordBatch], with_groups: bool) -> Iterator[pa.RecordBatch]:
    """Documents of each block from its file, once all its pairs' counts are there; rows come by block, the file first."""
    names = [*DOCUMENT.names[:6], *["groups"] * with_groups]
    held: list[tuple[Array, Array]] = []
    block = file = None

    def closed() -> Iterator[pa.RecordBatch]:
        with reader(file) as source:
            documents = pa.ipc.open_stream(source.read()).read_all().combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(documents["steps"].combine_chunks().value_lengths().to_numpy())])
        steps, times = (documents[name].combine_chunks().flatten().to_numpy().astype(np.int64) for name in ("steps", "times"))
        count = np.concatenate([part[0] for part in held]) if held else np.zeros(0, np.int64)
        best = np.concatenate([part[1] for part in held]) if held else np.zeros(0, bool)
        run = np.concatenate([[0], np.cumsum(steps)])
        place = run[1:] - np.repeat(run[bounds[:-1]], np.diff(bounds))
        sums = []
        for values in (best[place] * times, count[place] * times):
            total = np.concatenate([[0], np.cumsum(values)])
            sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]]))
        yield from documents.select(names).append_column("n_best", sums[0]).append_column("count_sum", sums[1]).to_batches(5000)

    for batch in stream:
        numbers = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for low, high in zip(edges[:-1], edges[1:]):
            if high == low:
                continue
            part = batch.slice(low, high - low)
            if numbers[low] != block:
                if file is not None:
                    yield from closed()
                block, file, held = numbers[low], part.column(1)[0].as_py(), []
                part = part.slice(1)
            held.append((part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)))
    if file is not None:
        yield from closed()


@dataclass
class Alignment:
    """``documents``: a row a document. ``pairs``: a_id, b_id, count of every linked pair, and whether it is its B id's best."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    with_groups: bool = False,
    block_documents: int = BLOCK_DOCUMENTS,
) -> Alignment:
    """Align a byte-level BPE file (A) with a sentencepiece model (B) over all texts.

    Documents have ``key``, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum, and with ``with_groups`` the
    groups themselves (``a1,a2|b1;…``). Of a pair's count, and the highest of its B id, all texts have a part.
    """
    spark = docs.sparkSession
    made = workspace.store("blocks", blocks(docs, a_file, b_file, workspace.location("files"), key, text, with_groups, block_documents))
    uses = made.select("block", F.inline(F.arrays_zip("pairs", "uses"))).withColumnRenamed("pairs", "pair")
    totals = workspace.store("totals", uses.groupBy("pair").agg(F.sum("uses").alias("count")))
    b_id = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    highest = totals.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("highest"))
    # at most one row an id of B's vocabulary, 65,536 in all
    judged = totals.withColumn("b_id", b_id).join(F.broadcast(highest), "b_id").withColumn("best", F.col("count") == F.col("highest"))
    valued = uses.select("block", "pair").join(judged.select("pair", "count", "best"), "pair")
    files = made.select("block", "file", F.lit(-1).cast("long").alias("pair"), F.lit(0).cast("long").alias("count"), F.lit(False).alias("best"))
    rows = files.union(valued.select("block", F.lit(None).cast("string").alias("file"), "pair", "count", "best"))
    dealt = rows.repartition(shuffle_width(spark), "block").sortWithinPartitions("block", "pair")
    fields = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " + "groups string, " * with_groups + "n_best long, count_sum long"
    documents = dealt.mapInArrow(lambda stream: _results(stream, with_groups), fields).withColumnRenamed("key", key)
    pairs = judged.select(F.shiftright("pair", SHIFT).cast("int").alias("a_id"), F.col("b_id").cast("int").alias("b_id"), "count", "best")
    return Alignment(documents, pairs)
