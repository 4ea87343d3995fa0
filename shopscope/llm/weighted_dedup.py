"""Near-duplicate documents by weighted Jaccard similarity of their word shingles.

1. Every document gets a print of its words and the bands of its BagMinHash signature; equal prints are copies and
   become one node, so copies of a text cost no pairs.
2. Nodes that share a band meet in a bucket. Each bucket compares its members with one of them (the smallest), which
   is a pair a member and not all pairs. Candidate pairs read both texts again and keep links of exact multiset
   similarity from ``THRESHOLD`` on.
3. Components of these links tell which buckets still hold members of different components. Their members are written
   in blocks of bounded size, and pairs of blocks are compared all against all, exactly, as products of incidence
   matrices. A pair of blocks returns only links that join components, so its result is never larger than its members,
   and no link between different texts of a bucket that would join two components is lost.
4. Every document gets the class of its node: the smallest doc_id of the component.

Two texts of similarity 0.8 share one of the 25 bands of 5 with a probability of 99.995 %.

Defined cases: null texts count as empty; texts without words are copies of equal texts only; texts of fewer than five
words are one shingle; rows that repeat a doc_id are documents of their own; a null doc_id sorts last among a class;
an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm import bag_min_hash
from shopscope.llm.batches import bounded, pieces
from shopscope.llm.components import components
from shopscope.llm.shingles import STEP, Words, mix, overlap
from shopscope.llm.storage import Output, reader
from shopscope.sources.workspace import Workspace

THRESHOLD = 0.8
COMPONENTS, ROWS = 125, 5
#: Members and shingles that a block of a bucket has on average, at most.
BLOCK_MEMBERS, BLOCK_SHINGLES = 384, 400_000
#: Prints and ids are broadcast up to so many rows, of some 40 bytes each.
BROADCAST_ROWS = 1_000_000
#: Rows and bytes of text that a task works on at once.
PIECE_ROWS, PIECE_BYTES = 500, 3 << 19


def printed(text: Column) -> Column:
    """The print of each text's words."""
    bounded()

    @F.pandas_udf("binary")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = pa.array(batch, pa.string(), from_pandas=True)
            found = []
            for piece in pieces([pa.record_batch([texts], ["text"])], PIECE_ROWS, 0, PIECE_BYTES):
                found += Words(piece.column(0)).prints(piece.column(0))
            yield pd.Series(found, dtype=object)

    return prints(text)


SKETCH = pa.schema([("doc_id", pa.int64()), ("print", pa.binary()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, print, number of shingles and bands of each document; texts without words have no bands."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE_ROWS, 1, PIECE_BYTES):
            texts = batch.column(1)
            words = Words(texts)
            owner, shingle, count = words.shingles()
            signature = bag_min_hash.signatures(owner, shingle, count, len(words), COMPONENTS)
            keys = bag_min_hash.bands(signature, ROWS).view(np.int64)
            sizes = np.bincount(owner, weights=count, minlength=len(words)).astype(np.int64)
            lists = [row if size else [] for row, size in zip(keys, sizes)]
            columns = [batch.column(0), pa.array(words.prints(texts), pa.binary()), pa.array(sizes), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=SKETCH)

    bounded(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(task, "doc_id long, print binary, size long, bands array<long>")


def _first(key: str = "doc_id") -> Column:
    """Orders documents: ids first, ascending, then prints."""
    return F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("doc_id"), "print")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of prints whose texts have the similarity, with it."""
    left = texts.select(F.col("print").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("print").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")

    def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        owner, shingle, count = Words(texts).shingles()
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [(shingle[a:b], count[a:b]) for a, b in zip(ends[:-1], ends[1:])]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 300, "text_b", PIECE_BYTES):
            names = batch.column("a").to_pylist()
            where: dict[bytes, int] = {}
            for n, name in enumerate(names):
                where.setdefault(name, n)
            own = dict(zip(where, bags(batch.column("text_a").take(pa.array(list(where.values()))))))
            score = np.array([overlap(own[name], bag) for name, bag in zip(names, bags(batch.column("text_b")))])
            kept = batch.select(["a", "b"]).append_column("similarity", pa.array(score))
            yield kept.filter(pa.array(score >= THRESHOLD))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a binary, b binary, similarity double")


def _similar_size(a: Column, b: Column) -> Column:
    """Sizes that allow the similarity."""
    return F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def links(docs: DataFrame, nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) of all nodes that are linked; ``nodes`` has print, a doc_id with it, size and bands."""
    keys = nodes.select("print", "size", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min(F.struct("print", "size")).alias("lead"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = keys.join(buckets, "key").select("key", "print", "size", "lead")
    members = workspace.store("members", members.where(F.col("print") != F.col("lead.print")))
    first = members.where(_similar_size(F.col("size"), F.col("lead.size")))
    pairs = workspace.store("pairs", first.select(F.col("lead.print").alias("a"), F.col("print").alias("b")).distinct())
    # only texts of nodes that share a bucket are read again, one document for each
    prints = members.select("print").union(members.select("lead.print")).distinct()
    wanted = workspace.store("wanted", nodes.select("print", F.col("doc_id").alias("wanted")).join(prints, "print"))
    few = wanted.count() <= BROADCAST_ROWS
    hinted = lambda df: F.broadcast(df) if few else df
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(hinted(wanted.select("wanted").distinct()), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    rows = rows.select("text", printed(F.col("text")).alias("print")).join(hinted(wanted.select("print")), "print", "left_semi")
    texts = workspace.store("texts", rows.dropDuplicates(["print"]))
    found = workspace.store("links", verify(pairs, texts).select("a", "b"))
    roots = components(found, workspace, "leaders")
    named = members.select("key", "print", "size").join(roots, members["print"] == roots["node"], "left")
    named = workspace.store("named", named.select("key", "print", "size", F.coalesce("root", "print").alias("root")))
    still = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    rest = workspace.store("rest", named.join(still.where("low != high").select("key", "members", "shingles"), "key"))
    if rest.isEmpty():
        return roots
    more = workspace.store("more_links", block_links(rest, texts, workspace))
    return components(found.unionByName(more), workspace, "all")


def elements(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A multiset as a set: one hash for each occurrence, so that set similarity is weighted similarity."""
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.sort(mix(np.repeat(shingle, count) + place.astype(np.uint64) * STEP))


BLOCK = "key long, block int, path string, start long, length long, low binary, high binary"
BLOCK_SCHEMA = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])


def write_blocks(rows: DataFrame, folder: str) -> DataFrame:
    """Blocks of bucket members in files; a row each with its place, and the smallest and largest root in it.

    ``rows`` has key, block, print, root and elements.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, current, done = None, [], None, []
        for batch in pieces(batches, 256):
            for key, block, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, block) != current and held:
                    out = out or Output(folder, ".blocks")
                    done.append(_written(out, current, held))
                    held = []
                current = (key, block)
                held.append(member)
        if held:
            out = out or Output(folder, ".blocks")
            done.append(_written(out, current, held))
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pylist(done, BLOCK_SCHEMA)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("key", "block", "print", "root", "elements").repartition(parts, "key", "block").sortWithinPartitions("key", "block", "print")
    return ordered.mapInArrow(task, BLOCK)


def _written(out: Output, name: tuple[int, int], members: list) -> dict:
    roots = [root for _, root, _ in members]
    data = pickle.dumps(members, protocol=5)
    return {"key": name[0], "block": name[1], "path": out.uri, "start": out.write(data), "length": len(data), "low": min(roots), "high": max(roots)}


def _incidence(members: list, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Member and column of each of the members' elements that are among ``shared``."""
    sizes = [len(e) // 8 for _, _, e in members]
    values = np.frombuffer(b"".join(e for _, _, e in members), np.uint64)
    column = np.minimum(np.searchsorted(shared, values), max(0, len(shared) - 1))
    inside = shared[column] == values if len(shared) else np.zeros(len(values), bool)
    return np.repeat(np.arange(len(members)), sizes)[inside], column[inside]


def compare_blocks(left: list, right: list, strip: int = 4096) -> list[tuple[bytes, bytes]]:
    """Links between members of different roots that have the similarity; no more than join the roots up."""
    spread = lambda members: np.unique(np.frombuffer(b"".join(e for _, _, e in members), np.uint64))
    shared = np.intersect1d(spread(left), spread(right), assume_unique=True)
    (row_a, column_a), (row_b, column_b) = _incidence(left, shared), _incidence(right, shared)
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(shared), strip):
        a, b = np.zeros((len(left), strip), np.float32), np.zeros((len(right), strip), np.float32)
        for matrix, row, column in ((a, row_a, column_a), (b, row_b, column_b)):
            here = (column >= low) & (column < low + strip)
            matrix[row[here], column[here] - low] = 1
        common += a @ b.T
    sizes = [np.array([len(e) // 8 for _, _, e in members], np.float64) for members in (left, right)]
    either = sizes[0][:, None] + sizes[1] - common
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    joined = []
    for i, j in zip(*np.nonzero(common >= THRESHOLD * either)):
        a, b = find(left[i][1]), find(right[j][1])
        if a != b:
            parent[a] = b
            joined.append((left[i][0], right[j][0]))
    return joined


def block_links(rest: DataFrame, texts: DataFrame, workspace: Workspace) -> DataFrame:
    """Links (a, b) that join different roots within the buckets of ``rest`` (key, print, root, members, shingles)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE_ROWS, 1, PIECE_BYTES):
            owner, shingle, count = Words(batch.column(1)).shingles()
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            found = [elements(shingle[a:b], count[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["print", "elements"])

    bags = texts.join(rest.select("print").distinct(), "print", "left_semi").select("print", "text").mapInArrow(task, "print binary, elements binary")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    placed = rest.withColumn("block", F.pmod(F.xxhash64("print"), blocks).cast("int"))
    stored = workspace.store("blocks", write_blocks(placed.join(bags, "print"), workspace.location("block_files")))
    other = stored.select("key", *[F.col(c).alias(f"{c}_b") for c in ("block", "path", "start", "length", "low", "high")])
    both = stored.join(other, "key").where((F.col("block") <= F.col("block_b")) & (F.least("low", "low_b") != F.greatest("high", "high_b")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def loaded(path: str, start: int, length: int) -> list:
            with reader(path) as file:
                file.seek(start)
                return pickle.loads(file.read(length))

        for batch in batches:
            for row in batch.to_pylist():
                left = loaded(row["path"], row["start"], row["length"])
                same = row["block"] == row["block_b"]
                right = left if same else loaded(row["path_b"], row["start_b"], row["length_b"])
                found = compare_blocks(left, right)
                yield pa.RecordBatch.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    names = ("path", "start", "length", "block")
    parts = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = both.select(*names, *[f"{c}_b" for c in names]).repartition(parts)
    return wanted.mapInArrow(compare, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """The sketches (doc_id, print, ...) of all documents, and print to class_id, kept print and class_size."""
    sketches = workspace.store("sketches", sketch(docs))
    nodes = sketches.groupBy("print").agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"))
    bands = sketches.where(F.size("bands") > 0).select("print", "doc_id", "bands", "size").dropDuplicates(["print"])
    roots = links(docs, workspace.store("bands", bands), workspace)
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select("print", "first", "copies", F.coalesce("root", "print").alias("root"))
    rooted = workspace.store("rooted", rooted)
    # written, so that what follows are plain joins, whose hot partitions adaptive execution may split
    sizes = workspace.store("sizes", rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("copies").alias("class_size")))
    named = rooted.drop("first", "copies").join(sizes, "root")
    named = named.select("print", F.col("first.doc_id").alias("class_id"), F.col("first.print").alias("kept"), "class_size")
    return sketches, workspace.store("classes", named)


def classified(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its near duplicates) and class_size of each document."""
    sketches, named = classes(docs, workspace or Workspace(docs.sparkSession))
    return sketches.select("doc_id", "print").join(named, "print").select("doc_id", "class_id", "class_size")


def without_duplicates(docs: DataFrame, workspace: Workspace | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents with one of each class, in all their columns.

    What stays is decided by the sketches' ids and prints, without the texts. Only rows of an id that is there more than
    once are printed again; of those with one text, the one whose columns have the smallest hash stays.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    sketches, named = classes(docs, workspace)
    judged = sketches.select("doc_id", "print").join(named.select("print", "kept", "class_id"), "print")
    stays = (F.col("print") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    ids = judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(stays, F.col("print"))).alias("print"))
    ids = workspace.store("ids", ids.where("n > 1 or print is null").select(F.col("doc_id").alias("_id"), F.col("print").alias("_kept")))
    few, repeated = ids.agg(F.count(F.lit(1)), F.count("_kept")).first()  # that go or need a closer look, and of these those of which a row stays
    hinted = lambda df: F.broadcast(df) if few <= broadcast_rows else df
    own = docs["doc_id"].cast("long").eqNullSafe(ids["_id"])
    single = docs.join(hinted(ids.select("_id")), own, "left_anti")
    if not repeated:
        return single
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    again = docs.select(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("order"))
    again = again.join(hinted(ids.where("_kept is not null")), F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id")))
    again = again.where(printed(F.col("row.text").cast("string")) == F.col("_kept"))
    chosen = again.groupBy("_id").agg(F.min_by("row", "order").alias("row"))
    return single.unionByName(chosen.select("row.*"))
