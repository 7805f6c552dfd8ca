"""What the operators share: lineage cuts, size-checked joins, batches.

Intermediate results are cut by writing Parquet to the folder named in
``spark.checkpoint.dir``, which every executor can read.  A lost executor costs
a task retry and never an intermediate table.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut, discard, shared_dir

__all__ = ["cut", "discard", "shared_dir"]

#: Rows of a side that may be broadcast.  The rows broadcast here hold a few
#: numbers or short digests (at most about 200 bytes each), so 200,000 of them
#: stay under 40 MB.
BROADCAST_ROWS = 200_000

#: Rows of a batch sent to a Python worker.
BATCH_ROWS = 1000

#: Bytes of text that numpy works on at once, so that arrays stay in the CPU's cache.
WORK_BYTES = 1 << 18


def bounded_batches(spark: SparkSession) -> None:
    """Rows reach Python workers in batches of 1,000 at most, so that batches of long texts stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: What operators keep in a Python worker between tasks: name to a function that drops it.
KEPT: dict[str, Callable[[], None]] = {}
_trimmed = [0.0]


def trim() -> None:
    """Give freed memory back to the system, so that idle workers stay small; at most twice a second."""
    if time.monotonic() - _trimmed[0] < 0.5:
        return
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
    _trimmed[0] = time.monotonic()


def lean(f: Callable, keep: str = "") -> Callable:
    """A function over batches that starts without what other operators kept, and trims memory at its end."""

    def run(batches):
        for name, drop in KEPT.items():
            if name != keep:
                drop()
        try:
            yield from f(batches)
        finally:
            trim()

    return run


def lean_group(f: Callable) -> Callable:
    """The same for functions of one or two grouped tables."""

    def one(table):
        out = f(table)
        trim()
        return out

    def two(left, right):
        out = f(left, right)
        trim()
        return out

    return one if f.__code__.co_argcount == 1 else two


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, right_rows: int) -> DataFrame:
    """Join a counted side: broadcast up to BROADCAST_ROWS rows, else shuffle both sides."""
    if right_rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, on, how)


def join_by_size(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with a stored side of one row per key, whose column ``_n`` counts the key's rows on the left.

    A small side is broadcast.  Of a large one, the keys of many rows are broadcast (few can be large), so that no
    shuffle key is hot, and the others are shuffled.  ``_n`` is dropped.
    """
    keys, rows = right.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if keys <= BROADCAST_ROWS:
        return left.join(F.broadcast(right.drop("_n")), on)
    limit = max(1000, -(-rows // BROADCAST_ROWS))
    large = right.where(F.col("_n") >= limit).drop("_n")
    small = right.where(F.col("_n") < limit).drop("_n")
    rest = left.join(F.broadcast(large.select(*on)), on, "left_anti").join(small.hint("merge"), on)
    return left.join(F.broadcast(large), on).unionByName(rest)


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of consecutive items of at most ``limit`` bytes each, single larger items alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
