"""Exact cosine nearest neighbours in rounds.

The database side is dealt to chunks of at most about ``GROUP_BYTES`` of vectors.
A round broadcasts one chunk, and all tasks compare their queries with it; so a
worker holds one chunk whatever the size of the tables, no vector is shuffled
more than once, and a task's work is bounded by its queries times a chunk.  Each
round yields each query's best k of its chunk, and these are merged by query; no
pair of single rows is ever emitted.  The products grow with the square of the
rows, as exact search does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import cut, file_system, shared_dir, shuffles_dropped

#: Database rows that a product takes at once, and query rows.
BLOCK = 2048
QUERIES = 512
#: The database side is one chunk up to this many bytes of vectors.
BROADCAST_BYTES = 32 << 20
#: Bytes of vectors of a chunk beyond that.
GROUP_BYTES = 64 << 20
#: Bytes of vectors of a stored file of queries.
FILE_BYTES = 4 << 20


def with_unit_vectors(df: DataFrame, vector_col: str = "embedding", out: str = "unit") -> DataFrame:
    """Adds the vector over its L2 norm, in doubles; the zero vector stays."""
    v = F.col(vector_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    safe = F.when(norm > 0, norm).otherwise(1.0)
    return df.withColumn("_n", safe).withColumn(out, F.transform(v, lambda x: x / F.col("_n"))).drop("_n")


def parsed_vectors(df: DataFrame, candidates: tuple[str, ...] = ("embedding", "emb", "vector", "embedding_vector")) -> DataFrame:
    """``embedding`` as array<float> from the first of the candidate columns that has a value.

    Strings are read as JSON arrays or tuples.  Rows without a vector are dropped.
    """
    kinds = dict(df.dtypes)
    have = [c for c in candidates if c in kinds]
    if not have:
        raise ValueError(f"no vector column among {df.columns}")
    plain = lambda c: F.regexp_replace(F.trim(df[c]), r"^\((.*?),?\s*\)$", "[$1]")
    read = [F.from_json(plain(c), "array<float>") if kinds[c] == "string" else df[c].cast("array<float>") for c in have]
    return df.withColumn("embedding", F.coalesce(*read)).drop(*[c for c in have if c != "embedding"]).where(F.col("embedding").isNotNull())


def _readable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows whose vector has no missing number."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows over their norms, from the flat values of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return v / np.where(norm == 0, 1.0, norm)


def _vectors(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column, or of a binary one that holds them already."""
    if not pa.types.is_binary(column.type):
        return _matrix(column)
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _unit(rows: DataFrame) -> DataFrame:
    """(id, v): unit vectors as binaries of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("v"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([v.tobytes() for v in unit], pa.binary())], names=["id", "v"])

    return rows.mapInArrow(run, "id long, v binary")


def _first_k(row: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k entries of each row, the smallest id first among equals."""
    order = np.lexsort((ids, -sims, row))
    row, ids, sims = row[order], ids[order], sims[order]
    use = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[use], ids[use], sims[use]


def _best(
    q_ids: np.ndarray, q: np.ndarray, d_ids: np.ndarray, d: np.ndarray, low: np.ndarray, k: int, exclude_self: bool, block: int = BLOCK
) -> tuple[np.ndarray, ...]:
    """(query id, match id, similarity) of each query's best k; the smallest id first among equals (``d_ids`` ascend).

    Products of single precision (``low``: ``d`` in it) find what may be among the best k, by more than their error;
    only these are computed in double precision.
    """
    own = np.searchsorted(d_ids, q_ids), np.searchsorted(d_ids, q_ids, "right")
    spare = np.float32((2 * d.shape[1] + 16) * 2.0**-24)
    q_low = q.astype(np.float32)
    row, ids, sims = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.full(len(q), -np.inf, np.float32)  # what the best k known so far reach
    for a in range(0, len(d), block):
        b = min(a + block, len(d))
        rough = q_low @ low[a:b].T
        skip = (np.zeros(0, np.int64),) * 2  # places of the queries themselves
        if exclude_self:
            first, last = np.maximum(own[0], a), np.minimum(own[1], b)
            n = np.maximum(last - first, 0)
            r = np.repeat(np.arange(len(q)), n)
            skip = r, np.repeat(first - a, n) + np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            rough[skip] = -np.inf
        bound = least - spare
        if b - a > k and np.isneginf(least).any():
            bound = np.maximum(bound, (rough.max(1) if k == 1 else np.partition(rough, b - a - k, axis=1)[:, b - a - k]) - spare)
        hit = rough >= bound[:, None]
        hit[skip] = False
        if np.count_nonzero(hit) <= hit.size // 16:
            r, c = np.nonzero(hit)
            exact = np.einsum("ij,ij->i", q[r], d[a:b][c])
        else:  # many equal vectors
            r, c = np.nonzero(hit)
            exact = (q @ d[a:b].T)[r, c]
        if not len(r):
            continue
        exact = np.round(exact, 12)  # equal vectors tie whatever the order of additions
        keep = np.isfinite(exact)
        parts = (row, r[keep]), (ids, d_ids[a:b][c[keep]]), (sims, exact[keep])
        row, ids, sims = _first_k(*(np.concatenate(p) for p in parts), k)
        full = np.searchsorted(row, np.arange(len(q))) + k - 1
        known = (full < len(row)) & (row[np.minimum(full, len(row) - 1)] == np.arange(len(q))) if len(row) else np.zeros(len(q), bool)
        least[known] = sims[full[known]]
    return q_ids[row], ids, sims


def _found(*parts: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in parts])) for i in range(3)], names=["query_id", "match_id", "sim"])


RESULT = "query_id long, match_id long, sim double"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of a partitioned table."""
    fs, target = file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory())


def nearest(
    queries: DataFrame,
    database: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    block: int = BLOCK,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(query_id, match_id, sim, rank): the k most similar database rows of each query.

    Null and empty vectors, and vectors that hold a null or NaN, are left out.
    Vectors of unlike lengths raise ``ValueError``.
    """
    spark = database.sparkSession
    same = queries is database
    side = _readable(database, id_col, vector_col)
    asked = side if same else _readable(queries, id_col, vector_col)
    measure = [F.count("*"), F.min(F.size("v")), F.max(F.size("v"))]
    n, low, high = side.agg(*measure).first()
    q_n, q_low, q_high = (n, low, high) if same else asked.agg(*measure).first()
    if not n or not q_n:
        return spark.createDataFrame([], RESULT + ", rank int")
    if len({low, high, q_low, q_high}) > 1:
        raise ValueError(f"vectors of {min(low, q_low)} to {max(high, q_high)} numbers cannot be compared")

    rounds = 1 if n * high * 8 <= broadcast_bytes else max(1, -(-n * high * 8 // group_bytes))

    def compared(rows: DataFrame, chunk: DataFrame):
        """(each query's best k of a chunk, which is bounded, so it may meet on the driver; what is broadcast)."""
        got = chunk.toArrow().combine_chunks()
        ids = got.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        parts = [_vectors(p) for p in got.column("v").chunks]
        unit = np.concatenate(parts)[order] if parts else np.zeros((0, high))
        sent = spark.sparkContext.broadcast((ids[order], unit))

        def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, unit = sent.value
            low = unit.astype(np.float32)
            for batch in batches:
                for at in range(0, batch.num_rows, QUERIES):
                    part = batch.slice(at, QUERIES)
                    yield _found(_best(part.column("id").to_numpy(), _vectors(part.column("v")), ids, unit, low, k, exclude_self, block))

        return rows.mapInArrow(against, RESULT), sent

    if rounds == 1:
        found, _ = compared(asked, side)
    else:
        # Vectors are stored once, in a folder for each chunk, and read again in each round.
        store = f"{shared_dir(spark)}/vectors-{uuid.uuid4().hex}"
        chunk = F.pmod(F.xxhash64("id"), F.lit(rounds))
        with shuffles_dropped(spark):
            files = max(rounds, -(-n * high * 8 // FILE_BYTES))
            dealt = _unit(side).withColumn("chunk", chunk).repartition(files, "chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(-(-files // rounds))))
            dealt.write.partitionBy("chunk").parquet(store)
        read = spark.read.schema("id long, v binary")
        folders = _folders(spark, store)
        if same:
            rows = read.parquet(*folders)
        else:
            rows = cut(_unit(asked).repartition(max(1, -(-q_n * high * 8 // FILE_BYTES)), "id"), "asked")
        parts = []
        for path in folders:
            part, sent = compared(rows, read.parquet(path))
            parts.append(cut(part, "nearest-part"))
            sent.destroy()
        fs, target = file_system(spark, store)
        fs.delete(target, True)
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    by = Window.partitionBy("query_id").orderBy(F.desc("sim"), "match_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
