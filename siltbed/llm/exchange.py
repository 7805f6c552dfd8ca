"""Asking all other documents about keys, without rows per key.

Operators that need to know whether a key (a hash, a window) occurs elsewhere
work in blocks of a few MB of text.  A block sends the keys of each group of the
key space as one packed row (an ask); a group's task merges the asks of all
blocks and sends each block its answers as packed rows; a block's task combines
them with the block's directory (its documents, and what it knew on its own).

Keys that repeat inside a block are sent once, so a key held by a third of all
rows costs its group one entry per block.  Rows: (grp, block, body).  A group
number below 0 marks a directory row, which passes through to its block.

Blocks are numbered by input partition and place in it, so a task that runs
again builds the same blocks.  That needs an input whose partitions keep their
rows in order, as a scan's do; ``stable`` stores any other input first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordarrays as wa
from .shared import bounded_batches, chunks, cut, lean_group

ASK_SCHEMA = "grp long, block long, body binary"
ANSWER_SCHEMA = "block long, kind int, body binary"
_ASK = pa.schema([("grp", pa.int64()), ("block", pa.int64()), ("body", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])
BLOCK_BYTES = 2 << 20
MAX_BLOCK_ROWS = 1 << 15
#: Bytes that a group of the key space should not pass, and the most groups there are.
GROUP_BYTES = 64 << 20
MAX_GROUPS = 1 << 20
#: A side is broadcast up to this many bytes of payload.
BROADCAST_BYTES = 24 << 20


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(body: bytes, *kinds) -> list[np.ndarray]:
    n = len(kinds)
    at = 8 * (n + 1)
    out = []
    for size, kind in zip(np.frombuffer(body, np.int64, n, 8).tolist(), kinds, strict=True):
        out.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def plan_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of a table's size; for scans it follows the files' sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def n_groups(df: DataFrame, growth: float = 2.0) -> int:
    """Two groups for each shuffle partition, which even out their hashing; more where groups would pass GROUP_BYTES.

    ``growth``: bytes sent for a byte of the table.
    """
    least = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MAX_GROUPS, int(plan_bytes(df) * growth) // GROUP_BYTES))


def stable(docs: DataFrame) -> DataFrame:
    """``docs`` itself if its plan is a scan with projections and filters, else a stored copy."""
    todo, simple = [docs._jdf.queryExecution().optimizedPlan()], {"LogicalRelation", "Project", "Filter"}
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in simple:
            return cut(docs, "input")
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return docs


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(k1, k2, id, text, more): two hashes of id and text name a row; rows equal in both share them."""
    bounded_batches(docs.sparkSession)
    both = [docs[id_col].cast("string"), docs[text_col]]
    return docs.select(
        F.xxhash64(F.lit(1), *both).alias("k1"),
        F.xxhash64(F.lit(2), both[1], both[0]).alias("k2"),
        docs[id_col].alias("id"),
        docs[text_col].alias("text"),
        *[docs[c] for c in more],
    )


def blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES, max_rows: int = MAX_BLOCK_ROWS) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(block number, rows): the input in blocks of about ``limit`` bytes of text."""
    part, k, held, size, rows = TaskContext.get().partitionId(), 0, [], 0, 0
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
        for a, b in chunks(sizes, limit):
            for c in range(a, b, max_rows):
                d = min(b, c + max_rows)
                more = sum(sizes[c:d])
                if held and (size + more > limit or rows + d - c > max_rows):
                    yield part << 32 | k, _one(held)
                    k, held, size, rows = k + 1, [], 0, 0
                held.append(batch.slice(c, d - c))
                size, rows = size + more, rows + d - c
    if held:
        yield part << 32 | k, _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def ask_rows(block: int, group: np.ndarray, directory: bytes, *entries: np.ndarray) -> pa.RecordBatch:
    """The directory row and one row per group with that group's entries, in their order."""
    short = np.uint16 if not len(group) or group.max() < 1 << 16 else np.uint32  # 16-bit keys are sorted by radix
    order = np.argsort(group.astype(short), kind="stable")
    group = group[order]
    cut_at = np.flatnonzero(np.diff(group)) + 1
    lo = np.concatenate([[0], cut_at]) if len(group) else np.zeros(0, np.int64)
    hi = np.concatenate([cut_at, [len(group)]]) if len(group) else lo
    entries = [e[order] for e in entries]
    bodies = [pack(*(e[a:b] for e in entries)) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
    return ask_batch(block, [int(g) for g in group[lo]] if len(group) else [], directory, bodies)


def ask_batch(block: int, groups: list[int], directory: bytes, bodies: list[bytes]) -> pa.RecordBatch:
    names = [-1 - block, *groups]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array([block] * len(names), pa.int64()), pa.array([directory, *bodies], pa.binary())], schema=_ASK
    )


def local_counts(keys: np.ndarray, in_order: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether it stands for its key, and whether the key occurs again.

    One entry stands for each key, always the same one; the first with ``in_order``, which takes longer.
    """
    order = np.argsort(keys, kind="stable" if in_order else None)
    s = keys[order]
    same = s[1:] == s[:-1]
    again, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    again[1:] |= same
    again[:-1] |= same
    later[1:] = same
    out_again, out_first = np.empty_like(again), np.empty_like(later)
    out_again[order], out_first[order] = again, ~later
    return out_first, out_again


def repeat_asks(block: int, keys: np.ndarray, groups: int, directory: bytes) -> pa.RecordBatch:
    """Asks which of a block's keys repeat: per key once, 31 bits of its hash, whether the block holds it twice, and
    its number among the keys sent, as the step from the one before in its group."""
    first, again = local_counts(keys)
    sent = np.flatnonzero(first)
    h = wa.mix(keys[sent] ^ wa.U(0x2545F4914F6CDD1D))
    cell = (h & wa.U(0xFFFFFFFE)).astype(np.uint32) | again[sent]
    group = (h >> wa.U(33)) % wa.U(groups)
    order = np.argsort(group.astype(np.uint16 if groups <= 1 << 16 else np.uint32), kind="stable")  # 16-bit keys are sorted by radix
    group, cell = group[order].astype(np.int64), cell[order]
    edge = np.flatnonzero(np.diff(group)) + 1
    names, bodies = [], []
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(group)], strict=True) if len(group) else []:
        step = np.diff(order[lo:hi], prepend=0)
        names.append(int(group[lo]))
        bodies.append(pack(cell[lo:hi], step.astype(np.min_scalar_type(int(step.max())))))
    return ask_batch(block, names, directory, bodies)


def repeat_answers(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
    """Answers: the numbers of the keys that two blocks hold, or one twice."""
    parts = []
    for body in bodies:
        cell, step = unpack(body, np.uint32, np.uint8)
        width = len(step) // len(cell)
        parts.append((cell, np.cumsum(step.view(f"u{width}"), dtype=np.uint32)))
    cell = np.concatenate([p[0] for p in parts])
    order = np.argsort(cell)
    s = cell[order]
    new = np.concatenate([[0], np.flatnonzero(s[1:] >> 1 != s[:-1] >> 1) + 1])
    count = np.add.reduceat(1 + (s & 1).astype(np.int64), new)
    hit = np.empty(len(s), bool)
    hit[order] = np.repeat(count >= 2, np.diff(np.concatenate([new, [len(s)]])))
    out, at = [], 0
    for own, number in parts:
        got = number[hit[at : at + len(own)]]
        at += len(own)
        out.append(pack(got) if len(got) else None)
    return out


def answered(
    asks: DataFrame, merge: Callable[[list[int], list[bytes]], list[bytes | None]], combine: Callable[[bytes, list[bytes]], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Merge asks by group, then combine answers by block.

    ``merge`` takes the block numbers and bodies of one group and returns a body
    or None per ask; ``combine`` takes a block's directory and answers and
    returns rows of ``schema``.
    """

    def by_group(table: pa.Table) -> pa.Table:
        groups, block, body = table.column("grp"), table.column("block").to_pylist(), table.column("body").to_pylist()
        if groups[0].as_py() < 0:
            out = list(zip(block, [0] * len(block), body, strict=True))
        else:
            order = sorted(range(len(block)), key=block.__getitem__)
            block, body = [block[i] for i in order], [body[i] for i in order]
            out = [(b, 1, x) for b, x in zip(block, merge(block, body), strict=True) if x is not None]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_ANSWER)], schema=_ANSWER)

    def by_block(table: pa.Table) -> pa.Table:
        kind, body = table.column("kind").to_pylist(), table.column("body").to_pylist()
        out = combine(next(x for k, x in zip(kind, body, strict=True) if k == 0), [x for k, x in zip(kind, body, strict=True) if k])
        return pa.Table.from_batches([out])

    merged = asks.groupBy("grp").applyInArrow(lean_group(by_group), ANSWER_SCHEMA)
    return merged.groupBy("block").applyInArrow(lean_group(by_block), schema)


def join_payload(rows: DataFrame, found: DataFrame, payload: str, how: str) -> DataFrame:
    """Join ``rows`` with a stored (k1, k2, payload): broadcast up to BROADCAST_BYTES, else by shuffle."""
    size = found.agg(F.sum(F.octet_length(payload) + 40)).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found.hint("merge")
    return rows.join(found, ["k1", "k2"], how)
