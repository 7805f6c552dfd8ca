"""Sharding through fixed virtual slots.

Records hash into a fixed number of virtual slots (4,096).  Bytes per slot are
aggregated, and a versioned table maps slots to shards.  Rebalancing edits the
table, never the hash: ``assign`` places slots by falling size on the least
filled shard, ``rebalance`` moves slots off shards that grew too large, and
``grow`` gives one more shard its part by moving slots to it alone.

The map has one row per slot whatever the input size, so it is the one thing
that the driver holds and that is broadcast.  Only DataFrame functions touch
the records.

Cases: a null text counts as no bytes and the CRC of the empty string.  A null
id hashes like any other value.  Repeated rows each get a place of their own.
An empty table gives an empty result and a map with empty slots.  Only the named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import shared_dir

N_SLOTS = 4096
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, rows long"


def virtual_slot(key: Column, n_slots: int = N_SLOTS) -> Column:
    """The fixed slot of a record."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(n_slots)).cast("int")


def slot_sizes(records: DataFrame, n_slots: int = N_SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of each slot; ``records`` has vslot and size.  One row per slot reaches the driver."""
    sizes = [(0, 0)] * n_slots
    for s, b, n in records.groupBy("vslot").agg(F.sum("size"), F.count("*")).collect():
        sizes[s] = (b, n)
    return sizes


def assign(sizes: list[tuple[int, int]], n_shards: int) -> list[int]:
    """Shard of each slot: slots by falling bytes, each to the least filled shard."""
    heap = [(0, 0, k) for k in range(n_shards)]
    shard_of = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s][0], s)):
        b, n, k = heapq.heappop(heap)
        shard_of[slot] = k
        heapq.heappush(heap, (b + sizes[slot][0], n + 1, k))
    return shard_of


def rebalance(shard_of: list[int], sizes: list[tuple[int, int]], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """Edit a map for new sizes: slots move from the fullest to the emptiest shard while that helps."""
    out = list(shard_of)
    load, held = [0] * n_shards, [set() for _ in range(n_shards)]
    for slot, k in enumerate(out):
        load[k] += sizes[slot][0]
        held[k].add(slot)
    mean = sum(load) / n_shards
    for _ in range(len(out)):
        top, low = max(range(n_shards), key=load.__getitem__), min(range(n_shards), key=load.__getitem__)
        gap = load[top] - load[low]
        fitting = [s for s in held[top] if 0 < sizes[s][0] < gap]
        if gap <= tolerance * mean or not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(sizes[s][0] - gap / 2), s))
        out[slot] = low
        held[top].remove(slot)
        held[low].add(slot)
        load[top] -= sizes[slot][0]
        load[low] += sizes[slot][0]
    return out


def grow(shard_of: list[int], sizes: list[tuple[int, int]], n_shards: int) -> list[int]:
    """Edit a map for one more shard, which alone receives slots."""
    out = list(shard_of)
    load = [0] * n_shards
    held = [[] for _ in range(n_shards)]
    for slot, k in enumerate(out):
        load[k] += sizes[slot][0]
        held[k].append(slot)
    mean = sum(load) / (n_shards + 1)
    for slots in held:
        slots.sort(key=lambda s: (sizes[s][0], -s))
    new = 0
    while new < mean:
        k = max(range(n_shards), key=load.__getitem__)
        if not held[k]:
            break
        slot = held[k].pop()
        if new + sizes[slot][0] > mean * 1.05 and new:
            held[k] = []
            load[k] = -1
            if not any(held):
                break
            continue
        out[slot] = n_shards
        new += sizes[slot][0]
        load[k] -= sizes[slot][0]
    return out


def map_frame(spark: SparkSession, version: int, shard_of: list[int], sizes: list[tuple[int, int]]) -> DataFrame:
    rows = [(version, s, k, int(sizes[s][0]), int(sizes[s][1])) for s, k in enumerate(shard_of)]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def store_map(frame: DataFrame, path: str) -> None:
    """Add a version to the stored map; earlier versions stay readable."""
    frame.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One stored version, the latest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def shard_documents(
    docs: DataFrame,
    n_shards: int = 16,
    n_slots: int = N_SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    map_path: str | None = None,
) -> DataFrame:
    """Each record's id, size, text_crc32, vslot, shard, and its place ``slot`` in the shard, gapless from 0.

    With ``map_path`` the map is stored there as version 1; if one is stored
    already, it is edited by ``rebalance`` and stored as the next version.
    """
    spark = docs.sparkSession
    raw = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    records = docs.select(
        docs[id_col].alias("_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        virtual_slot(docs[id_col], n_slots).alias("vslot"),
    )
    sizes = slot_sizes(records, n_slots)
    version, shard_of = 1, None
    if map_path:
        try:
            old = load_map(spark, map_path).collect()
        except Exception as e:  # noqa: BLE001 - only "nothing stored yet" is expected
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            old = []
        if len(old) == n_slots:
            version = old[0]["version"] + 1
            before = [r["shard"] for r in sorted(old, key=lambda r: r["vslot"])]
            shard_of = rebalance(before, sizes, n_shards)
    shard_of = shard_of or assign(sizes, n_shards)
    if map_path:
        store_map(map_frame(spark, version, shard_of, sizes), map_path)

    base, filled = [], [0] * n_shards
    for slot, k in enumerate(shard_of):
        base.append((slot, k, filled[k]))
        filled[k] += sizes[slot][1]
    places = F.broadcast(spark.createDataFrame(base, "vslot int, shard int, _base long"))
    order = Window.partitionBy("vslot").orderBy("_id", "size", "text_crc32")
    return (
        records.withColumn("_r", F.row_number().over(order))
        .join(places, "vslot")
        .select(
            F.col("_id").alias(id_col),
            "size",
            "text_crc32",
            "vslot",
            "shard",
            (F.col("_base") + F.col("_r") - 1).cast("long").alias("slot"),
        )
    )



def new_map_path(spark: SparkSession) -> str:
    """A folder of its own for one map, in the shared folder."""
    return f"{shared_dir(spark)}/siltbed-slot-map-{uuid.uuid4().hex}"
