"""Bounded pieces of Arrow batches for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession


def bounded(spark: SparkSession | None = None) -> None:
    """Let Spark hand over texts in batches of bounded rows and bytes, unless the session has its own limits.

    A batch is held several times over: by Spark, by Arrow and as Python objects.
    """
    spark = spark or SparkSession.getActiveSession()
    for name, value in (("maxRecordsPerBatch", "500"), ("maxBytesPerBatch", "4m")):
        if spark is not None and spark.conf.get(f"spark.sql.execution.arrow.{name}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they have so many bytes."""
    held: list[pa.RecordBatch] = []
    used = 0
    for batch in batches:
        held.append(batch)
        used += batch.nbytes
        if used >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, used = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pieces(batches: Iterable[pa.RecordBatch], rows: int, column: int | str | None = None, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows, and of about ``size`` bytes of one column unless a single row has more."""
    for batch in batches:
        if column is None:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for at, length in enumerate(lengths):
            if at > start and (at - start >= rows or held + length > size):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers live on, and other stages need the memory
