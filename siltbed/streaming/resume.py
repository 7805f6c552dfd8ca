"""Resumable generation.

Results are appended in parts under a key for each row, so a run that stops goes
on with the keys that are not there; the order of completion does not matter.
The same as a stream: each micro-batch of new input files is one part, and the
stream's checkpoint remembers which files are done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.responses import retry_slots, samples
from ..sources.scratch import file_system, shared_dir


def fingerprint(df: DataFrame, *columns: str) -> str:
    """Names an input by the contents of some columns (all by default), whatever the order of its rows."""
    cells = [F.col(c) for c in columns or df.columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")) for seed in (1, 2)]
    n, a, b = df.agg(F.count("*"), *sums).first()
    return f"{n}-{int(a or 0) % (1 << 64):016x}{int(b or 0) % (1 << 64):016x}"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - only a missing or empty folder is expected
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def run_in_parts(df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], path: str, part_rows: int = 2000) -> DataFrame:
    """Apply ``work`` to the rows whose key is not in ``path`` yet, one part at a time, and return all results.

    The open rows are written once, in a folder for each part, so the input is
    scanned and compared with what is done once, however many parts there are.
    Parts are chosen by the hash of the key, so they do not depend on the order
    of rows.  Of rows that share a key, one is worked on.
    """
    spark = df.sparkSession
    done = _read(spark, path)
    left = df if done is None else df.join(done.select(key).distinct(), key, "left_anti")
    parts = max(1, -(-df.count() // part_rows))
    store = f"{shared_dir(spark)}/open-{uuid.uuid4().hex}"
    fs, target = file_system(spark, store)
    numbered = left.dropDuplicates([key]).withColumn("_part", F.pmod(F.xxhash64(key, F.lit(17)), F.lit(parts)))
    numbered.repartition("_part").write.partitionBy("_part").parquet(store)
    found = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(target) if s.isDirectory())
    for p in found:
        rows = spark.read.schema(df.schema).parquet(f"{store}/_part={p}")
        work(rows).write.mode("append").parquet(path)
    fs.delete(target, True)
    out = _read(spark, path)
    return out if out is not None else work(df.limit(0))


def repair(results: DataFrame, key: str, stored: str, n: int, again: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    """Results with failed or missing slots filled by new calls; good slots stay.

    ``again`` takes the rows to repair (with ``slots``) and that column, and
    returns (key, samples).
    """
    slots = retry_slots(samples(F.col(stored)), n)
    todo = results.withColumn("slots", slots).where(F.size("slots") > 0)
    fresh = again(todo, F.col("slots")).select(F.col(key), F.col("samples").alias("_new")).dropDuplicates([key])
    old = samples(F.col(stored))
    every = F.array(*[F.lit(i) for i in range(n)])
    merged = F.transform(every, lambda i: F.when(F.array_contains(slots, i), F.try_element_at("_new", i + 1)).otherwise(F.try_element_at(old, i + 1)))
    joined = results.join(fresh, key, "left")
    return joined.withColumn(stored, F.when(F.size("_new") > 0, F.to_json(merged)).otherwise(F.col(stored))).drop("_new")


def stream_parts(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: str = "key") -> None:
    """Process the files of ``source`` that are new since the last call, each batch once.

    A batch that is replayed after a failure appends only the keys that are missing.
    """

    def each(batch: DataFrame, _: int) -> None:
        done = _read(spark, path)
        rows = batch.dropDuplicates([key])
        rows = rows if done is None else rows.join(done.select(key).distinct(), key, "left_anti")
        work(rows).write.mode("append").parquet(path)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
