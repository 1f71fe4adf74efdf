"""Hand an object of bounded size to every task."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Bytes of a slice of a batch.
PORTION = 1 << 20


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` with the classes of this package by value; call to get it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def give_back(cycles: bool = True) -> None:
    """Return freed memory to the system: workers live on, and several share an executor.

    Objects that hold each other are looked for first, which takes longer than the rest.
    """
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def portions(batches: Iterator[pa.Array], most: int = PORTION) -> Iterator[pa.Array]:
    """The same rows in slices of about ``most`` bytes, one row at least: what a worker makes of them is as small.

    A batch has so many rows, however long they are; several workers share an executor.
    """
    for batch in batches:
        rows = max(1, len(batch) * most // max(1, batch.nbytes))
        for at in range(0, max(1, len(batch)), rows):
            yield batch.slice(at, rows)


def tidy(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` for ``mapInArrow``; what it held is given back when it has ended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run


def column_udf(fn: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str):
    """An Arrow UDF over batches of one column.

    It is marked as not deterministic so that the optimiser never runs it twice, once
    for a filter and once for a projection.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for out in fn(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        give_back()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()
