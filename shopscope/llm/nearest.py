"""Nearest neighbours over randomly rotated one-bit codes.

Every vector is centred, rotated by a random orthogonal matrix and kept as one sign bit a dimension, with two
correction scalars: the length of the centred vector, and the inner product f between its direction and that of its
code. A query's inner product with the direction is estimated from the code as <code, query> / f, and it errs by
more than ``deviations * sqrt((1 - f^2) / f^2 / (D - 1))`` only with a probability that falls exponentially in the
square of ``deviations``. So each distance has a lower and an upper bound; the k-th smallest upper bound among a
block's codes tells which of its vectors may still be among the nearest, and only those are measured exactly. Blocks
give up to k rows a query, and a ranked window keeps k of them.

The index holds every valid vector, in blocks of at most ``BLOCK`` rows. Queries lie in files of bounded size on
shared storage, which each block's task reads one after another, so that neither side is ever broadcast or held whole.
Only the centre is fitted on a bounded sample (``sample`` rows in the order of a hash of their ids).

Defined cases: rows without id, and vectors that are null, empty, zero or hold null or non-finite components, take no
part; vectors of different sizes are never compared; equal distances rank by id; rows that repeat an id are candidates
of their own, but never neighbours of a query with that id, and such a query is asked once (with its smallest vector);
a query with fewer than k candidates gets them all; empty tables give no rows.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.batches import pieces
from shopscope.llm.storage import Output, reader
from shopscope.sources.workspace import Workspace

#: Vectors of an index block, and queries of a file.
BLOCK, QUERY_FILE = 8192, 4096
#: Queries whose bounds are held against a block at once.
STRIP = 256


def valid(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


@functools.lru_cache(maxsize=8)
def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * np.sign(np.diag(r))).astype(np.float64)


def quantise(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths of the centred vectors, and inner products of code and direction."""
    rest = vectors - centre
    norms = np.linalg.norm(rest, axis=1)
    turned = rest @ rotation(vectors.shape[1]) / np.where(norms > 0, norms, 1)[:, None]
    fits = np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), norms, np.where(norms > 0, fits, 1)


def _matrix(column: pa.Array, rows: np.ndarray, size: int) -> np.ndarray:
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, size)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, one matrix for each vector size."""
    ids, sizes = batch.column(0).to_numpy(), pa.compute.list_value_length(batch.column(1)).to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield ids[rows], _matrix(batch.column(1), rows, int(size))


def centres(vectors: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """The mean of the sampled vectors of each size."""
    keyed = vectors.withColumn("order", F.xxhash64("id", F.hash("vector")))
    # hashes first, so that no task sends more vectors than are wanted in all
    last = keyed.select("order").distinct().orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    rows = keyed.where(F.col("order") <= F.lit(last).cast("long")).dropDuplicates(["order"]).orderBy("order").collect()
    sizes = {len(row["vector"]) for row in rows}
    return {size: np.mean([row["vector"] for row in rows if len(row["vector"]) == size], axis=0, dtype=np.float64) for size in sizes}


INDEX = pa.schema([("dims", pa.int32()), ("ids", pa.binary()), ("codes", pa.binary()), ("norms", pa.binary()), ("fits", pa.binary()), ("vectors", pa.binary())])


def build(vectors: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """The index of (id, vector): a row a block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BLOCK):
            for ids, matrix in _by_size(batch):
                dims = matrix.shape[1]
                codes, norms, fits = quantise(matrix, middle.get(dims, np.zeros(dims)))
                row = [dims, ids.tobytes(), codes.tobytes(), norms.tobytes(), fits.tobytes(), matrix.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, INDEX)], schema=INDEX)

    return vectors.mapInArrow(task, "dims int, ids binary, codes binary, norms binary, fits binary, vectors binary")


def write_queries(queries: DataFrame, folder: str) -> DataFrame:
    """Files of queries of one size each, one path a row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = []
        for batch in pieces(batches, QUERY_FILE):
            for ids, matrix in _by_size(batch):
                held = io.BytesIO()
                np.savez(held, ids=ids, vectors=matrix)
                out = Output(folder, ".npz")
                out.write(held.getvalue())
                out.close()
                paths.append({"dims": matrix.shape[1], "path": out.uri})
        yield pa.RecordBatch.from_pylist(paths, pa.schema([("dims", pa.int32()), ("path", pa.string())]))

    return queries.mapInArrow(task, "dims int, path string")


def distances(gap: np.ndarray) -> np.ndarray:
    """Lengths of rows; where squares leave the range of doubles, of the rows scaled by their largest component."""
    with np.errstate(over="ignore", under="ignore"):
        plain = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    largest = np.abs(gap).max(1, initial=0)
    odd = ~np.isfinite(plain) | (largest > 0) & (largest < 1e-150)
    if odd.any():
        scaled = gap[odd] / largest[odd, None]
        plain[odd] = largest[odd] * np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return plain


class Block:
    """An index block held against queries."""

    def __init__(self, row: dict, deviations: float):
        self.dims = row["dims"]
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.norms, fits = read("ids", np.int64), read("norms", np.float64), read("fits", np.float64)
        self.vectors = read("vectors", np.float64).reshape(-1, self.dims)
        bits = np.unpackbits(read("codes", np.uint8).reshape(len(self.ids), -1), axis=1, count=self.dims)
        self.signs = (bits.astype(np.float32) * 2 - 1) / np.float32(np.sqrt(self.dims))
        self.scale = (2 * self.norms / fits)[:, None]
        self.error = (2 * self.norms * deviations * np.sqrt(np.maximum(0, 1 - fits**2)) / fits / np.sqrt(max(1, self.dims - 1)))[:, None]

    def nearest(self, ids: np.ndarray, queries: np.ndarray, centre: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Query ids, vector ids and exact distances of up to k survivors a query, and how many were measured."""
        rest = queries - centre
        lengths = np.linalg.norm(rest, axis=1)
        turned = (rest @ rotation(self.dims)).astype(np.float32)
        middle = (self.norms**2)[:, None] + lengths**2 - self.scale * (self.signs @ turned.T)
        slack = self.error * lengths + 1e-5 * ((self.norms**2)[:, None] + lengths**2)
        own = self.ids[:, None] == ids
        if len(self.ids) > k:
            upper = np.where(own, np.inf, middle + slack)
            limit = np.partition(upper, k - 1, axis=0)[k - 1]
            rows, columns = np.nonzero(~(middle - slack > limit) & ~own)  # bounds that overflow rule nothing out
        else:
            rows, columns = np.nonzero(~own)
        exact = np.empty(len(rows))
        for at in range(0, len(rows), 1 << 15):
            part = slice(at, at + (1 << 15))
            gap = self.vectors[rows[part]] - queries[columns[part]]
            exact[part] = distances(gap)
        order = np.lexsort((self.ids[rows], exact, columns))
        rows, columns, exact = rows[order], columns[order], exact[order]
        starts = np.searchsorted(columns, np.arange(len(ids)))
        best = np.arange(len(rows)) - starts[columns] < k
        return ids[columns[best]], self.ids[rows[best]], exact[best], len(rows)


def search(vectors: DataFrame, queries: DataFrame, workspace: Workspace, k: int = 10, deviations: float = 3.0, sample: int = 4096) -> DataFrame:
    """The k nearest of ``vectors`` (id, vector) for each of ``queries`` (id, vector), both already valid."""
    middle = centres(vectors, sample)
    index = workspace.store("index", build(vectors, middle))
    asked = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    files = workspace.store("queries", write_queries(asked, workspace.location("query_files"))).collect()  # a row for thousands of queries
    files = [(row["dims"], row["path"]) for row in files]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("measured", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for one in pieces([batch], 1) for row in one.to_pylist()):
            block = Block(row, deviations)
            for dims, path in files:
                if dims != block.dims:
                    continue
                with reader(path) as file:
                    held = np.load(io.BytesIO(file.read()))
                ids, matrix = held["ids"], held["vectors"]
                for at in range(0, len(ids), STRIP):
                    found = block.nearest(ids[at : at + STRIP], matrix[at : at + STRIP], middle.get(dims, np.zeros(dims)), k)
                    measured = np.full(len(found[0]), found[3])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*found[:3], measured)], schema=schema)

    near = index.mapInArrow(task, "query_id long, vec_id long, score double, measured long")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
