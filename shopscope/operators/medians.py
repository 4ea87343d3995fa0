"""Exact median per group, whatever the sizes of the groups, with one shuffle of the rows.

Rows are range-partitioned and sorted by (key, value), so that a group is a run of consecutive rows, and a large one goes
on over several partitions. One narrow pass over each sorted partition takes the middle of every run that lies inside of
it. The first and the last run may have neighbours in other partitions: their values are kept in chunks, with their
numbers. Sums of these numbers (a row a chunk, not the values) say which chunk holds a group's middle, and it is picked
there. No step holds a group together, and no value is shuffled a second time.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.session import shuffle_width
from shopscope.sources.workspace import Workspace

#: Values in a chunk of a run that touches the edge of a partition.
CHUNK = 100_000


def _changes(keys: pa.Array) -> np.ndarray:
    """Where a new run begins; NULLs are equal to each other."""
    if len(keys) < 2:
        return np.zeros(0, np.int64)
    here, before = keys.slice(1), keys.slice(0, len(keys) - 1)
    other = pc.fill_null(pc.not_equal(here, before), False)
    nulls = pc.not_equal(pc.is_null(here), pc.is_null(before))
    return np.flatnonzero(pc.or_(other, nulls).to_numpy(zero_copy_only=False)) + 1


def _runs(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, value) to: key, part, chunk, n, low, high (middle values of an inner run) and values (of the others)."""
    part, first, numbered = TaskContext.get().partitionId(), True, 0
    key: pa.Array | None = None  # of the run that isn't finished, with its values
    held: list[np.ndarray] = []

    def inner(keys: pa.Array, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        zeros, none = np.zeros(len(n), np.int32), pa.nulls(len(n), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(zeros + part, pa.int32()), pa.array(zeros), pa.array(n), pa.array(low), pa.array(high), none],
            names=["key", "part", "chunk", "n", "low", "high", "values"],
        )

    def closed(edge: bool) -> Iterator[pa.RecordBatch]:
        nonlocal numbered
        values = np.concatenate(held)
        n = len(values)
        if not edge:
            yield inner(key, np.array([n]), values[[(n - 1) // 2]], values[[n // 2]])
            return
        for at in range(0, n, chunk):
            own = values[at : at + chunk]
            yield pa.RecordBatch.from_arrays(
                [key, pa.array([part], pa.int32()), pa.array([numbered], pa.int32()), pa.array([len(own)]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([own], pa.list_(pa.int64()))],
                names=["key", "part", "chunk", "n", "low", "high", "values"],
            )
            numbered += 1

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, values = batch.column(0), batch.column(1).to_numpy()
        edges = np.concatenate([[0], _changes(keys), [len(keys)]])
        if key is not None and len(_changes(pa.concat_arrays([key, keys.slice(0, 1)]))):
            yield from closed(first)
            key, held, first = None, [], False
        starts, ends = edges[:-1], edges[1:]
        held.append(values[: ends[0]])
        key = keys.slice(0, 1)
        if len(starts) > 1:
            yield from closed(first)
            first = False
            start, n = starts[1:-1], (ends - starts)[1:-1]
            if len(start):
                yield inner(keys.take(pa.array(start)), n, values[start + (n - 1) // 2], values[start + n // 2])
            key, held = keys.slice(int(starts[-1]), 1), [values[starts[-1] :]]
    if key is not None:
        yield from closed(True)


def median_by_key(rows: DataFrame, key: str, value: str, workspace: Workspace, name: str, chunk: int = CHUNK) -> DataFrame:
    """(key, median) of a non-NULL decimal(16,10) ``value``; a NULL key is a group like any other."""
    number = (F.col(value) * F.lit(10**10).cast("decimal(11,0)")).cast("bigint")
    pairs = rows.select(F.col(key).alias("key"), number.alias("value"))
    ordered = pairs.repartitionByRange(shuffle_width(rows.sparkSession), "key", "value").sortWithinPartitions("key", "value")
    kind = rows.schema[key].dataType.simpleString()
    fields = f"key {kind}, part int, chunk int, n bigint, low bigint, high bigint, values array<bigint>"
    runs = workspace.store(name, ordered.mapInArrow(lambda batches: _runs(batches, chunk), fields))

    chunks = runs.where("values is not null").select("key", "part", "chunk", "n")
    of_key = Window.partitionBy("key")
    earlier = of_key.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("total", F.sum("n").over(of_key))
    middle = placed.withColumn("at", F.explode(F.array(F.expr("(total - 1) div 2"), F.expr("total div 2"))))
    wanted = middle.where("at >= before and at < before + n").select("part", "chunk", (F.col("at") - F.col("before") + 1).cast("int").alias("place"))
    # two rows a group on an edge, so at most four a partition of the sort
    picked = runs.where("values is not null").join(F.broadcast(wanted), ["part", "chunk"]).select("key", F.element_at("values", F.col("place")).alias("v"))
    edges = picked.groupBy("key").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    found = runs.where("values is null").select("key", "low", "high").unionByName(edges)
    half = (F.col("low").cast("decimal(20,0)") + F.col("high")) * F.lit(Decimal("0.00000000005"))
    return found.select(F.col("key").alias(key), half.cast("decimal(18,11)").alias("median"))
