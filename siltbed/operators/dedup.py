"""Exact deduplication, resume anti-joins, and greedy deduplication by nearest neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut, discard
from .similarity import nearest, with_unit_vectors

#: Edges of 16 bytes that one task resolves.
SMALL_EDGES = 200_000


def first_of_each(df: DataFrame, key: Column, position: str) -> DataFrame:
    """The first row by position of each key; rows with a null key all stay.

    Least positions are aggregated before the shuffle, so a frequent key costs
    one row per task; the rows are then found again by digest and position.  Of
    rows that share both, one stays.
    """
    keyed = df.withColumn("_key", key)
    known = keyed.where("_key is not null").withColumn("_h", F.sha2(F.col("_key").cast("binary"), 256))
    least = known.groupBy("_h").agg(F.min(position).alias("_least"))
    kept = known.join(least.withColumnRenamed("_h", "_g"), (F.col("_h") == F.col("_g")) & (F.col(position) == F.col("_least")), "left_semi")
    return kept.dropDuplicates(["_h"]).drop("_h").unionByName(keyed.where("_key is null")).drop("_key")


def not_done(df: DataFrame, key: Column, done: DataFrame, done_key: Column) -> DataFrame:
    """Rows whose key is not in ``done``; keys are compared by digest."""
    seen = done.select(F.sha2(done_key.cast("binary"), 256).alias("_h")).distinct()
    marked = df.withColumn("_h", F.sha2(key.cast("binary"), 256))
    return marked.join(seen, "_h", "left_anti").drop("_h")


def _small_forest(edges: DataFrame) -> DataFrame:
    """(node, alive) of a counted, small forest in one task: parents come after their children, so ids ascend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        child = np.concatenate([b.column("child").to_numpy() for b in parts]) if parts else np.zeros(0, np.int64)
        parent = np.concatenate([b.column("parent").to_numpy() for b in parts]) if parts else child
        dead: set[int] = set()
        for c, p in sorted(zip(child.tolist(), parent.tolist(), strict=True)):
            if c not in dead:
                dead.add(p)
        nodes = np.union1d(child, parent)
        alive = [n not in dead for n in nodes.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(alive, pa.bool_())], names=["node", "alive"])

    return cut(edges.select(F.col("child").cast("long"), F.col("parent").cast("long")).coalesce(1).mapInArrow(run, "node long, alive boolean"), "alive")


def _forest(edges: DataFrame) -> DataFrame:
    """(node, alive) of a forest of any size: one level a round, leaves first."""
    nodes = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
    leaves = nodes.join(edges.select(F.col("parent").alias("node")), "node", "left_anti")
    state = cut(nodes.join(leaves.withColumn("alive", F.lit(True)), "node", "left"), "alive")
    while state.where("alive is null").limit(1).count():
        children = edges.join(state.withColumnsRenamed({"node": "child", "alive": "_a"}), "child")
        seen = children.groupBy(F.col("parent").alias("node")).agg(F.bool_or("_a").alias("_any"), F.count_if(F.col("_a").isNull()).alias("_open"))
        verdict = F.when(F.col("_any"), F.lit(False)).when(F.col("_open") == 0, F.lit(True))
        after = cut(state.join(seen, "node", "left").select("node", F.coalesce("alive", verdict).alias("alive")), "alive")
        discard(state)
        state = after
    return state


def greedy_dedup(vectors: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", small_edges: int = SMALL_EDGES) -> DataFrame:
    """Adds kept, best_id, best_sim: each row's nearest neighbour at the threshold or above, and the greedy verdict.

    In order of ids, a row that is still kept looks at its nearest neighbour (the
    smallest id of equals): if that is earlier the row goes, else the neighbour
    goes.  Edges from a row to a later neighbour form a forest in which a row is
    alive exactly if no child is.  Up to ``small_edges`` counted edges are resolved
    in one task; beyond that levels are resolved in parallel, leaves first, and
    each round's state is written to the shared folder.  A row is kept if it is
    alive and its neighbour is not earlier.
    """
    near = nearest(vectors, vectors, 1, id_col, vector_col, exclude_self=True)
    best = near.where(F.col("sim") >= threshold).select(F.col("query_id").alias("_id"), F.col("match_id").alias("_nn"), F.col("sim").alias("_sim"))
    best = cut(best, "nearest")
    edges = best.where("_nn > _id").select(F.col("_id").alias("child"), F.col("_nn").alias("parent"))
    state = _small_forest(edges) if edges.count() <= small_edges else _forest(edges)
    dead = state.where("not alive").select(F.col("node").alias("_dead"))
    out = vectors.join(best, vectors[id_col] == best["_id"], "left").join(dead, vectors[id_col] == dead["_dead"], "left")
    kept = F.col("_dead").isNull() & ~F.coalesce(F.col("_nn") < F.col(id_col), F.lit(False))
    return out.withColumns({"kept": kept, "best_id": F.col("_nn"), "best_sim": F.col("_sim")}).drop("_id", "_nn", "_sim", "_dead")


def decontaminate(
    train: DataFrame, test: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Adds kept, matched_test_index, matched_test_sim (and matched_test_<column> for ``carry``) to the train rows.

    A train row goes if its most similar test row reaches the threshold.  An
    empty test set keeps everything.
    """
    near = nearest(train, test, 1, id_col, vector_col)
    best = near.where(F.col("sim") >= threshold).select(
        F.col("query_id").alias("_id"), F.col("match_id").alias("matched_test_index"), F.col("sim").alias("matched_test_sim")
    )
    if carry:
        more = test.select(F.col(id_col).alias("matched_test_index"), *[F.col(c).alias(f"matched_test_{c}") for c in carry])
        best = best.join(more, "matched_test_index", "left")
    out = train.join(best, train[id_col] == best["_id"], "left").drop("_id")
    return out.withColumn("kept", F.col("matched_test_index").isNull())


__all__ = ["decontaminate", "first_of_each", "greedy_dedup", "not_done", "with_unit_vectors"]
