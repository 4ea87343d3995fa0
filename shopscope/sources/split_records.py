"""CSV records with quoted line breaks, from text files that are read in splits.

Spark's own multi-line mode gives a whole file to one task. Here the text is read twice, and no line is shuffled. The
first pass cuts every split into records under both assumptions, that it opens outside of a quote and inside of one, and
keeps of each only the head that belongs to an earlier record, the tail that isn't finished, and the parity of the
quotes: a row a split. A running sum over the splits of a file then tells which assumption holds. The second pass knows
how each split opens and returns its complete records; those that cross a split are joined from the heads and tails.

A head or tail of more than ``KEPT`` bytes is only noted by the first pass, as the wrong assumption may make one of a
whole split; where it belongs to the right one, those splits alone are read again. A quote that is never closed fails by
file name. Stray quotes in even number make one record of the lines between them, as in any CSV reader.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopscope.sources.workspace import Workspace

#: Bytes of a head or tail that the first pass keeps.
KEPT = 1 << 20
#: Rows of one split each that are broadcast; beyond it, lines are shuffled to their splits.
BROADCAST_SPLITS = 1_000_000


def _parity(values: pa.Array) -> np.ndarray:
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1


def _runs(keys: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Stretches of rows with equal keys."""
    changed = np.logical_or.reduce([key[1:] != key[:-1] for key in keys]) if len(keys[0]) else np.zeros(0, bool)
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(keys[0])]
    return ((low, high) for low, high in zip(edges[:-1], edges[1:]) if high > low)


@dataclass
class _Piece:
    """Lines that may turn out to be a head or a tail; their text is let go once it is too long."""

    limit: int
    lines: list[str] = field(default_factory=list)
    size: int = 0
    long: bool = False

    def add(self, values: pa.Array) -> None:
        if self.long or not len(values):
            return
        self.size += values.nbytes
        if self.size > self.limit:
            self.long, self.lines = True, []
        else:
            self.lines += values.to_pylist()

    def text(self) -> str | None:
        return None if self.long else "\n".join(self.lines)


class _Reading:
    """A split cut into records, given how it opens."""

    def __init__(self, inside: int, limit: int):
        self.state, self.limit = inside, limit
        self.starts = 0
        self.head, self.tail = _Piece(limit), _Piece(limit)

    def add(self, values: pa.Array, odd: np.ndarray) -> None:
        after = (self.state + np.cumsum(odd)) & 1
        start = np.flatnonzero((after ^ odd) == 0)
        if not len(start):
            (self.tail if self.starts else self.head).add(values)
        else:
            if not self.starts:
                self.head.add(values.slice(0, start[0]))
            self.starts += len(start)
            self.tail = _Piece(self.limit)
            self.tail.add(values.slice(start[-1]))
        self.state = int(after[-1])


PIECES = "file string, split long, odd int, single boolean, inside_starts boolean, out_tail string, out_long boolean, in_head string, in_tail string, in_long boolean"
_PIECES = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("odd", pa.int32()), ("single", pa.bool_()), ("inside_starts", pa.bool_()), ("out_tail", pa.string())]
    + [("out_long", pa.bool_()), ("in_head", pa.string()), ("in_tail", pa.string()), ("in_long", pa.bool_())]
)


def _pieces_of_splits(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """A row a split: parity, and head and tail under both readings."""
    at: tuple[str, int] | None = None
    out = inside = None

    def row() -> pa.RecordBatch:
        # a reading that ends outside of a quote has no tail
        tails = [r.tail if r.state and r.starts else None for r in (out, inside)]
        values = {
            "file": at[0],
            "split": at[1],
            "odd": out.state,
            "single": out.starts == 1,
            "inside_starts": inside.starts > 0,
            "out_tail": tails[0] and tails[0].text(),
            "out_long": bool(tails[0] and tails[0].long),
            "in_head": inside.head.text(),
            "in_tail": tails[1] and tails[1].text(),
            "in_long": bool(inside.head.long or (tails[1] and tails[1].long)),
        }
        return pa.RecordBatch.from_pylist([values], _PIECES)

    for batch in batches:
        names = batch.column(0).dictionary_encode()
        splits, values = batch.column(1).to_numpy(), batch.column(2)
        codes, odd = names.indices.to_numpy(), _parity(values)
        for low, high in _runs([codes, splits]):
            key = (names.dictionary[int(codes[low])].as_py(), int(splits[low]))
            if key != at:
                if at is not None:
                    yield row()
                at, out, inside = key, _Reading(0, limit), _Reading(1, limit)
            part = values.slice(low, high - low)
            out.add(part, odd[low:high])
            inside.add(part, odd[low:high])
    if at is not None:
        yield row()


def _complete_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split, without each file's first; rows have the split's number, whether it opens inside, whether it is its file's first."""
    at = None
    state, skip = 0, False
    pending: list[str] | None = None
    for batch in batches:
        numbers, values = batch.column(0).to_numpy(), batch.column(3)
        odd, found = _parity(values), []
        for low, high in _runs([numbers]):
            if numbers[low] != at:
                at, pending = numbers[low], None
                state, skip = int(batch.column(1)[low].as_py()), bool(batch.column(2)[low].as_py())
            part, own = values.slice(low, high - low), odd[low:high]
            after = (state + np.cumsum(own)) & 1
            start = (after ^ own) == 0
            whole = start & (own == 0)
            joined: list[str] = []
            for n in np.flatnonzero(~whole).tolist():
                if start[n]:
                    pending = [part[n].as_py()]
                elif pending is not None:
                    pending.append(part[n].as_py())
                if pending is not None and not after[n]:
                    joined.append("\n".join(pending))
                    pending = None
            if skip and whole[0]:
                whole[0], skip = False, False
            elif skip and joined:  # a header of several lines is the first record to be joined
                joined, skip = joined[1:], False
            found += [part.filter(pa.array(whole)), pa.array(joined, part.type)]
            state = int(after[-1])
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(found)] if found else [pa.array([], pa.string())], ["record"])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def _opened(splits: DataFrame) -> DataFrame:
    """Adds whether a split opens inside a quote, and ``unclosed``, whether its file ends inside one."""
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).withColumn(
        "unclosed", F.sum("odd").over(of_file) % 2 == 1
    )


def _crossing(splits: DataFrame) -> DataFrame:
    """Records that cross splits, from heads and tails; without a file's first record."""
    tail = F.when(F.col("inside"), F.when(F.col("inside_starts"), F.col("in_tail"))).otherwise(F.col("out_tail"))
    fragments = splits.select(
        "file", "split", "single", F.when(F.col("inside"), F.col("in_head")).alias("head"), tail.alias("tail")
    ).where("head is not null or tail is not null")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("tail").isNotNull(), F.col("split")), True).over(earlier)
    parts = fragments.withColumn("owner", owner).select(
        "file",
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.col("owner").alias("record"), "split", F.col("head").alias("text"), F.lit(False).alias("header")),
                    F.struct(F.col("split").alias("record"), "split", F.col("tail").alias("text"), ((F.col("split") == 0) & F.col("single")).alias("header")),
                ),
                lambda part: part["text"].isNotNull(),
            )
        ),
    )
    joined = parts.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("split", "text"))).alias("parts"), F.max("header").alias("header")
    )
    return joined.where(~F.col("header")).select(F.array_join(F.col("parts.text"), "\n").alias("record"))


def _beside(lines: DataFrame, splits: DataFrame, few: bool) -> DataFrame:
    """Lines with what ``splits`` says of theirs, in the order of the file within each split."""
    keys = ["file", "split"]
    if few:
        return lines.join(F.broadcast(splits), keys)
    numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(splits, keys)
    return numbered.repartition(*keys).sortWithinPartitions(*keys, "line").drop("line")


def multi_line_records(spark: SparkSession, path: str, workspace: Workspace, kept: int = KEPT, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """All records but each file's first, one a row in ``record``; blank lines outside of quotes are skipped.

    The first pass runs when this is called, the second when the result is read; ``workspace`` must last until then.
    """
    lines = _lines(spark, path)
    splits = workspace.store("splits", _opened(lines.mapInArrow(lambda batches: _pieces_of_splits(batches, kept), PIECES)))
    is_long = F.when(F.col("inside"), F.col("in_long")).otherwise(F.col("out_long"))
    seen = splits.agg(F.min(F.when(F.col("unclosed"), F.col("file"))), F.count(F.lit(1)), F.count_if(is_long)).first()
    if seen[0]:
        raise ValueError(f"a quote is never closed in {seen[0]}")
    few = seen[1] <= broadcast_splits
    if seen[2]:
        wanted = splits.where(is_long).select("file", "split", "inside", "unclosed")
        again = _beside(lines, wanted.select("file", "split"), few).select("file", "split", "value")
        texts = again.mapInArrow(lambda batches: _pieces_of_splits(batches, 1 << 62), PIECES)
        whole = texts.join(wanted, ["file", "split"]).select(*splits.columns)
        splits = workspace.store("completed", splits.where(~is_long).unionByName(whole))
    states = splits.select("file", "split", F.xxhash64("file", "split").alias("number"), "inside")
    read = _beside(lines, states, few)
    complete = read.select("number", "inside", (F.col("split") == 0).alias("first"), "value").mapInArrow(_complete_records, "record string")
    records = complete.unionByName(_crossing(splits))
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")
