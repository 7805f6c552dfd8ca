"""Removing repeated windows of words, with a count-min prefilter.

A window is ``window`` consecutive words of one document; a word goes if a
window covering it also starts anywhere else.

Pass 1, the sketch.  Each window has an anchor: of its ``gram``-word grams, the
one with the least hash (leftmost of equals).  Equal windows have equal anchors
at equal offsets, so an anchor occurs at least as often as each of its windows:
a count of anchors overestimates window counts, at one key for about thirteen
windows.  A count-min sketch has ``DEPTH`` rows of counters, cut into ranges of
``CELLS`` counters; there are so many ranges that about one counter in ``SPARE``
is used.  Each block sends its own sketch, the counters that are not 0, by range;
a range's task adds them in an array of fixed size, and each block learns which of
its anchors have counters of 2 or more in all rows.  Anchors that share counters
are overestimated and go on needlessly; no estimate is below the true count, so
no repeated window is lost.

Pass 2, exact.  Only windows of such anchors are grouped, by 128 bits (the
anchor's hash and the window's, also inside a block), in groups of the anchor's
hash, and a window that occurs twice goes.

Cases: null and empty texts have no words.  Texts shorter than the window keep
all words.  Repeated rows count as documents of their own, so their windows go.
Texts of any length are read whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from . import wordarrays as wa
from .exchange import ASK_SCHEMA, answered, ask_batch, ask_rows, blocks, join_payload, keyed, local_counts, n_groups, pack, plan_bytes, stable, unpack
from .shared import WORK_BYTES, chunks, cut, discard, lean

WINDOW = 35
GRAM = 10
DEPTH = 2
#: Counters of one row in a range (2 MB of counters of one byte), and counters for each anchor.
CELLS = 1 << 21
SPARE = 16
#: Anchors for a byte of the table's files, at most about this many.
ANCHORS_PER_BYTE = 0.05
_SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
FOUND_SCHEMA = "k1 long, k2 long, ranges binary"


def anchored(words: wa.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start word, text) of each window, its anchor's word index, and the hash of the gram at each word."""
    start, text = words.windows(window)
    grams = wa.rolling(words.hash, gram, 1)
    least = wa.window_argmin(grams, window - gram + 1)
    return start, text, least[start] if len(start) else start, grams


def anchor_runs(start: np.ndarray, text: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index ranges [a, b) of windows that follow each other in one text and share an anchor."""
    if not len(start):
        return start, start
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(text) != 0) | (np.diff(start) != 1)) + 1
    return np.concatenate([[0], new]), np.concatenate([new, [len(start)]])


def cells(keys: np.ndarray, row: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """(range, counter in it) of keys in one row of the sketch."""
    h = wa.mix(keys ^ wa.U(_SEEDS[row]))
    return ((h >> wa.U(33)) % wa.U(ranges)).astype(np.int64), (h & wa.U(CELLS - 1)).astype(np.uint32)


def n_ranges(rows: DataFrame) -> int:
    """Ranges of counters, by the size of the table."""
    return max(n_groups(rows), int(plan_bytes(rows) * ANCHORS_PER_BYTE * SPARE) // CELLS)


def _pair_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``local_counts`` in order, for keys of two numbers."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    same = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
    first, again = np.ones(len(a), bool), np.zeros(len(a), bool)
    first[order[1:]] = ~same
    again[order[1:]] = same
    again[order[:-1]] |= same
    return first, again


def sketch_asks(block: int, keys: np.ndarray, groups: int, depth: int, directory: bytes) -> pa.RecordBatch:
    """A block's partition sketch: per key once, its cell of each row and whether the block holds it twice."""
    first, again = local_counts(keys)
    sent = np.flatnonzero(first)
    group, cell, entry = [], [], []
    for row in range(depth):
        g, c = cells(keys[sent], row, groups)
        group.append(g)
        cell.append(c)
        entry.append(np.arange(len(sent), dtype=np.uint32))
    row_of = np.repeat(np.arange(depth, dtype=np.uint8), len(sent))
    return ask_rows(
        block, np.concatenate(group), directory, np.concatenate(cell), row_of, np.tile(again[sent].astype(np.uint8), depth), np.concatenate(entry)
    )


def merge_sketch(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
    """Add the blocks' sketches in one range of counters; answers: the entries whose counter is 2 or more."""
    parts = [unpack(b, np.uint32, np.uint8, np.uint8, np.uint32) for b in bodies]
    counters = np.zeros((max(int(p[1].max()) for p in parts) + 1) * CELLS, np.uint8)
    for cell, row, extra, _ in parts:
        at = row.astype(np.int64) * CELLS + cell
        own, times = np.unique(np.concatenate([at, at[extra > 0]]), return_counts=True)
        counters[own] = np.minimum(counters[own] + times, 2)  # 2 stands for more
    out = []
    for cell, row, _, entry in parts:
        got = entry[counters[row.astype(np.int64) * CELLS + cell] >= 2]
        out.append(pack(got) if len(got) else None)
    return out


def repeated_entries(n_sent: int, answers: list[bytes], depth: int) -> np.ndarray:
    """Which sent keys are estimated to repeat: those hit in every row (the minimum of the rows is 2 or more)."""
    hits = np.zeros(n_sent, np.int64)
    for a in answers:
        np.add.at(hits, unpack(a, np.uint32)[0], 1)
    return hits == depth


def found_batch(k1: np.ndarray, k2: np.ndarray, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows (k1, k2, ranges): the ranges [a, b) of each text, sorted and merged."""
    rows = []
    order = np.lexsort((a, text))
    text, a, b = text[order], a[order], b[order]
    cut_at = np.flatnonzero(np.diff(text)) + 1
    for lo, hi in zip([0, *cut_at.tolist()], [*cut_at.tolist(), len(text)], strict=True) if len(text) else []:
        top = np.maximum.accumulate(b[lo:hi])
        new = np.concatenate([[True], a[lo + 1 : hi] > top[:-1]])
        at = np.flatnonzero(new)
        end = top[np.concatenate([at[1:] - 1, [hi - lo - 1]])]
        rows.append((int(k1[text[lo]]), int(k2[text[lo]]), np.stack([a[lo:hi][at], end], 1).astype(np.int32).tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
        names=["k1", "k2", "ranges"],
    )


def long_arrays(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return rows.column("k1").to_numpy(), rows.column("k2").to_numpy()


def candidates(rows: DataFrame, window: int, gram: int, depth: int) -> DataFrame:
    """(k1, k2, ranges of window starts) whose anchors are estimated to repeat."""
    groups = n_ranges(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches):
            texts, got = part.column("text").to_pylist(), []
            for lo, hi in chunks([len(t or "") for t in texts], WORK_BYTES):
                words = wa.Words(texts[lo:hi])
                start, text, anchor, grams = anchored(words, window, gram)
                a, b = anchor_runs(start, text, anchor)
                if len(a):
                    got.append((grams[anchor[a]], start[a] - words.first[text[a]], b - a, text[a] + lo))
            if not got:
                continue
            keys, where, size, text = (np.concatenate([g[i] for g in got]) for i in range(4))
            # Entries are keys, sent once; the directory maps each run to its key's entry.
            first, _ = local_counts(keys)
            _, entry = np.unique(keys, return_inverse=True)
            rank = np.empty(int(first.sum()), np.int64)
            rank[entry[first]] = np.arange(int(first.sum()))
            k1, k2 = long_arrays(part)
            directory = pack(k1, k2, text.astype(np.uint16), where.astype(np.uint32), size.astype(np.uint16), rank[entry].astype(np.uint32))
            yield sketch_asks(block, keys, groups, depth, directory)

    def combine(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        k1, k2, text, where, n, entry = unpack(directory, np.int64, np.int64, np.uint16, np.uint32, np.uint16, np.uint32)
        hit = repeated_entries(int(entry.max()) + 1, answers, depth)[entry]
        a = where[hit].astype(np.int64)
        return found_batch(k1, k2, text[hit], a, a + n[hit])

    asks = rows.select("k1", "k2", "text").mapInArrow(lean(ask), ASK_SCHEMA)
    return answered(asks, merge_sketch, combine, FOUND_SCHEMA)


def repeated(rows: DataFrame, found: DataFrame, window: int, gram: int) -> DataFrame:
    """(k1, k2, ranges of window starts) that repeat exactly, among the candidates ``found``."""
    groups = n_groups(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches):
            words = wa.Words(part.column("text").to_pylist())
            start, text, anchor, grams = anchored(words, window, gram)
            wanted = np.zeros(len(words.hash) + 1, bool)
            for t, r in enumerate(part.column("ranges").to_pylist()):
                pairs = np.frombuffer(r, np.int32).reshape(-1, 2).astype(np.int64)
                wanted[wa.expand(pairs[:, 0], pairs[:, 1]) + words.first[t]] = True
            use = np.flatnonzero(wanted[start])
            start, text, anchor = start[use], text[use], anchor[use]
            if not len(start):
                continue
            key = grams[anchor]
            own = wa.rolling(words.hash, window, 2)[start]
            # Inside the block: later copies are answered here, the first is sent with a mark.
            first, again = _pair_counts(key, own)
            k1, k2 = long_arrays(part)
            where = start - words.first[text]
            directory = pack(k1, k2, text[again].astype(np.uint16), where[again].astype(np.uint32))
            start, text, anchor, key, own, mark, where = (x[first] for x in (start, text, anchor, key, own, again, where))
            a, b = anchor_runs(start, text, anchor * 2 + mark)
            group = (wa.mix(key[a] ^ wa.U(_SEEDS[3])) >> wa.U(33)) % wa.U(groups)
            order = np.argsort(group, kind="stable")
            a, b, group = a[order], b[order], group[order].astype(np.int64)
            edge = np.flatnonzero(np.diff(group)) + 1
            names, bodies = [], []
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(a)], strict=True):
                at = a[lo:hi]
                bodies.append(
                    pack(
                        key[at],
                        text[at].astype(np.uint16),
                        where[at].astype(np.uint32),
                        (b[lo:hi] - at).astype(np.uint16),
                        mark[at].astype(np.uint8),
                        own[wa.expand(at, b[lo:hi])],
                    )
                )
                names.append(int(group[lo]))
            yield ask_batch(block, names, directory, bodies)

    kinds = (np.uint64, np.uint16, np.uint32, np.uint16, np.uint8, np.uint64)

    def merge(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
        parts = [unpack(b, *kinds) for b in bodies]
        n = [p[3].astype(np.int64) for p in parts]
        key = np.concatenate([np.repeat(p[0], m) for p, m in zip(parts, n, strict=True)])
        extra = np.concatenate([np.repeat(p[4], m) for p, m in zip(parts, n, strict=True)])
        own = np.concatenate([p[5] for p in parts])
        order = np.argsort(own + wa.mix(key))
        k, o = key[order], own[order]
        new = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (o[1:] != o[:-1])) + 1])
        count = np.add.reduceat(1 + extra[order].astype(np.int64), new)
        hit = np.empty(len(k), bool)
        hit[order] = np.repeat(count >= 2, np.diff(np.concatenate([new, [len(k)]])))
        out, at = [], 0
        for p, m in zip(parts, n, strict=True):
            got = hit[at : at + len(p[5])] & ~np.repeat(p[4], m).astype(bool)  # marked ones are known
            at += len(p[5])
            text = np.repeat(p[1], m)[got]
            where = wa.expand(p[2].astype(np.int64), p[2] + m)[got].astype(np.uint32)
            out.append(pack(text, where) if len(text) else None)
        return out

    def combine(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        k1, k2, text, where = unpack(directory, np.int64, np.int64, np.uint16, np.uint32)
        got = [(text, where), *(tuple(unpack(a, np.uint16, np.uint32)) for a in answers)]
        text, where = (np.concatenate([g[i] for g in got]).astype(np.int64) for i in range(2))
        return found_batch(k1, k2, text, where, where + 1)

    asks = join_payload(rows.select("k1", "k2", "text"), found, "ranges", "inner").mapInArrow(lean(ask), ASK_SCHEMA)
    return answered(asks, merge, combine, FOUND_SCHEMA).dropDuplicates(["k1", "k2"])


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with k1, k2, id, text; stored (k1, k2, ranges) of the starts of repeated windows)."""
    rows = keyed(stable(docs), id_col, text_col)
    first = cut(candidates(rows, window, min(gram, window), depth).dropDuplicates(["k1", "k2"]), "window-candidates")
    found = cut(repeated(rows, first, window, min(gram, window)), "window-repeats")
    discard(first)
    return rows, found


SCHEMA = "n_words long, n_removed long, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """id, n_words, n_removed and the SHA-256 of the kept words joined by one space; ``with_text`` adds that text."""
    rows, found = repeated_windows(docs, window, gram, depth, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}" + ", kept string" * with_text
    names = [id_col, "n_words", "n_removed", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, r in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                raw = (text or "").encode()
                words = [w for w in raw.translate(_TO_SPACE).split(b" ") if w]
                gone = 0
                n = len(words)
                if r is not None:
                    kept, at = [], 0
                    for a, b in np.frombuffer(r, np.int32).reshape(-1, 2).tolist():
                        b += window - 1
                        kept += words[at : max(a, at)]
                        gone += b - max(a, at)
                        at = max(at, b)
                    words = kept + words[at:]
                kept = b" ".join(words)
                out.append((n, gone, hashlib.sha256(kept).hexdigest(), *[kept.decode()] * with_text))
            columns = list(zip(*out, strict=True)) if out else [[]] * (len(names) - 1)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))], names=names)

    return join_payload(rows, found, "ranges", "left").select("id", "text", "ranges").mapInArrow(lean(run), schema)


_TO_SPACE = bytes(0x20 if wa.SPACE[b] else b for b in range(256))
