"""Removing repeated substrings with blockwise suffix sorting.

A string of ``length`` bytes of one document is repeated if the same string also
starts earlier: in a document of smaller id, or earlier in the same document.
Every byte that a repeated string covers goes.

1. Anchors.  Each string has an anchor: of its ``gram``-byte grams, the one with
   the least hash (leftmost of equals).  Equal strings have equal anchors at
   equal offsets.  Anchors are counted like the windows of ``window_dedup``, by
   sparse sketches that never underestimate, and only strings whose anchors
   repeat go on.  Copies of whole documents, found by hash and compared, go on
   once.
2. Suffix buckets.  The suffixes that start such strings, with as much text as
   comparing them takes, go to the bucket of their anchor; all suffixes that
   share ``length`` bytes share a bucket.  So buckets cut the suffixes by content
   and not by alphabet: order between buckets is not needed here.  What a block of
   texts holds twice is sorted there first, and sent once.
3. Blockwise construction.  A task sorts one bucket's suffixes at a time (small
   buckets together, up to ``BUCKET`` suffixes).  The ranks of a difference-cover
   sample of the bucket's text are computed first; suffixes are sorted by their
   first ``COVER`` bytes, and longer ties are resolved by the ranks of sample
   suffixes at a common distance below ``COVER``, which the cover guarantees for
   every pair.  Memory is bounded by the bucket, whatever the repeats' lengths.
4. Neighbours in suffix order that agree in ``length`` bytes form groups; all but
   the earliest of a group are repeated.

Cases: null texts are empty.  Texts shorter than ``length`` keep all bytes, and
texts of any length are read whole.  Rows equal in id and text count as one
document, none of them earlier.  A null id counts as the earliest.  Cuts fall on
bytes; ``kept_text`` replaces characters that a cut broke.  An empty table gives
an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordarrays as wa
from .exchange import ASK_SCHEMA, answered, ask_batch, blocks, join_payload, keyed, local_counts, n_groups, pack, repeat_answers, repeat_asks, stable, unpack
from .shared import WORK_BYTES, chunks, cut, discard, join_by_size, lean
from .window_dedup import FOUND_SCHEMA, found_batch, long_arrays

LENGTH = 100
GRAM = 32
COVER = 32
BUCKET = 1 << 18
NULL_ID = -(1 << 63)


# -- suffix sorting


@functools.lru_cache(maxsize=4)
def difference_cover(v: int) -> tuple[np.ndarray, np.ndarray]:
    """Residues D such that every difference modulo v is one of two members, and per pair of residues the least
    shift that takes both into D."""
    chosen = [0, 1]
    while True:
        seen = {(a - b) % v for a in chosen for b in chosen}
        if len(seen) == v:
            break
        gain = lambda c: len(seen | {(c - a) % v for a in chosen} | {(a - c) % v for a in chosen})  # noqa: B023, E731
        chosen.append(max((c for c in range(v) if c not in chosen), key=lambda c: (gain(c), -c)))
    member = np.zeros(v, bool)
    member[chosen] = True
    shift = np.zeros((v, v), np.int64)
    for a in range(v):
        for b in range(v):
            shift[a, b] = next(d for d in range(v) if member[(a + d) % v] and member[(b + d) % v])
    return np.array(sorted(chosen)), shift


def _eights(text: np.ndarray) -> np.ndarray:
    """The big-endian number of the 8 bytes at each position."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out |= padded[k : k + len(text)].astype(np.uint64) << wa.U(56 - 8 * k)
    return out


def _ordered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of numbers from 0 on, and the numbers in it.

    A number and its index are sorted as one word where both fit, which is faster than sorting indices.
    """
    place = len(x).bit_length()
    if len(x) and int(x.max()).bit_length() + place <= 64:
        both = np.sort(x.astype(np.uint64) << wa.U(place) | np.arange(len(x), dtype=np.uint64))
        return (both & wa.U((1 << place) - 1)).astype(np.int64), both >> wa.U(place)
    order = np.argsort(x, kind="stable")
    return order, x[order]


def _dense(x: np.ndarray) -> np.ndarray:
    """Ranks of numbers from 0 on, equal ones alike."""
    order, s = _ordered(x)
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], s[1:] != s[:-1]])) if len(x) else 0
    return out


def _prefix_ranks(eights: np.ndarray, v: int) -> np.ndarray:
    """Ranks of all positions by the ``v`` bytes there, doubled from 5 bytes on (which leave room for an index)."""
    rank, known = _dense(eights >> wa.U(24)), 5
    while known < v:
        step = min(known, v - known)
        later = np.zeros_like(rank)
        later[:-step] = rank[step:]
        rank, known = _dense(rank * (len(rank) + 1) + later), known + step
    return rank


class CoverSample:
    """Ranks of the difference-cover sample of a text, by prefixes of at least ``depth`` bytes."""

    def __init__(self, text: np.ndarray, v: int = COVER, depth: int = LENGTH):
        if v % 8:
            raise ValueError("v is a multiple of 8")
        self.v, (self.cover, self.shift) = v, difference_cover(v)
        n = -(-(len(text) + depth + 2 * v) // v) * v
        self.text = np.zeros(n + v, np.uint8)
        self.text[: len(text)] = text
        self.eights = _eights(self.text)
        at = (np.arange(0, n, v)[:, None] + self.cover).ravel()
        step = len(self.cover)
        self.prefix = _prefix_ranks(self.eights, v)
        rank = _dense(self.prefix[at])
        known, ahead = v, step
        while known < depth:  # a sample position plus a multiple of v is one too, ``ahead`` places on
            later = np.zeros_like(rank)
            later[:-ahead] = rank[ahead:] + 1
            both = rank * (len(rank) + 2) + later
            rank = _dense(both)
            known, ahead = known * 2, ahead * 2
        slot = np.full(v, -1)
        slot[self.cover] = np.arange(step)
        self._slot, self._slots, self._step, self.rank = slot, slot.tolist(), step, rank

    def at(self, position: np.ndarray) -> np.ndarray:
        """Ranks of sample positions."""
        return self.rank[position // self.v * self._step + self._slot[position % self.v]]

    def one(self, position: int) -> int:
        """The rank of one sample position."""
        return self.rank[position // self.v * self._step + self._slots[position % self.v]]


def sort_suffixes(text: np.ndarray, at: np.ndarray, depth: int = LENGTH, v: int = COVER) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): indices of ``at`` in suffix order, and whether each shares ``depth`` bytes with the one before.

    Suffixes that share v + depth bytes keep their given order.
    """
    sample = CoverSample(text, v, depth)
    tie = _dense(sample.prefix[at])
    order, sorted_tie = _ordered(tie)
    # Long ties.  Within one tie, a shift that takes all residues into the cover makes the ranks comparable.
    residue = at % v
    first = np.concatenate([[0], np.flatnonzero(np.diff(sorted_tie)) + 1]) if len(at) else np.zeros(0, np.int64)
    if len(at):
        low = np.minimum.reduceat(residue[order], first)
        high = np.maximum.reduceat(residue[order], first)
        mixed = (residue != low[tie]) & (residue != high[tie])
        rank = sample.at(at + sample.shift[low[tie], high[tie]])
        order, _ = _ordered(tie * (int(rank.max()) + 1) + rank)
        places, shift = (at.tolist(), sample.shift.tolist()) if mixed.any() else ([], [])
        for t in np.unique(tie[mixed]):  # three residues or more: compare pair by pair
            a, b = np.searchsorted(sorted_tie, np.array([t, t + 1], sorted_tie.dtype))

            def before(x: int, y: int) -> int:
                i, j = places[x], places[y]
                d = shift[i % v][j % v]
                p, q = sample.one(i + d), sample.one(j + d)
                return int(p > q) - int(p < q)

            order[a:b] = sorted(order[a:b].tolist(), key=functools.cmp_to_key(before))
    s = at[order]
    same = np.zeros(len(at), bool)
    if len(at) > 1:
        alike = np.flatnonzero(tie[order][1:] == tie[order][:-1]) if depth >= v else np.arange(len(at) - 1)
        x, y = s[alike], s[alike + 1]
        ok = np.ones(len(alike), bool)
        if depth >= v:
            steps, equal = [*range(v, depth - v + 1, v), depth - v], sample.prefix
        else:
            steps, equal = [*range(0, depth - 7, 8), depth - 8] if depth >= 8 else [], sample.eights
        for k in steps:
            ok &= equal[x + k] == equal[y + k]
        if depth < 8:
            drop = wa.U(64 - 8 * depth)
            ok &= sample.eights[x] >> drop == sample.eights[y] >> drop
        same[alike[ok] + 1] = True
    return order, same


# -- the operator


class Strings:
    """Byte ranges of texts as one array, and the anchor of each string in them.

    ``pieces``: (text index, first byte) of each range; ranges are apart by one byte.
    """

    def __init__(self, raw: list[bytes], length: int, gram: int):
        self.bytes = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        n = np.array([len(r) for r in raw], np.int64)
        self.first = np.cumsum(n + 1) - n - 1
        self.n = np.maximum(n - length + 1, 0)
        values = wa.BYTE_VALUES[self.bytes]
        self.grams = wa.rolling(values, gram, 1)
        self.anchor = wa.window_argmin(self.grams, length - gram + 1)
        self.values = values

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges [a, b) of strings in one piece that share an anchor, and the piece."""
        use = np.flatnonzero(self.n)
        start, stop = self.first[use], self.first[use] + self.n[use]
        turn = np.flatnonzero(self.anchor[1:] != self.anchor[:-1]) + 1
        a = np.union1d(turn, start)
        piece = np.searchsorted(start, a, "right") - 1
        inside = (piece >= 0) & (a < stop[np.maximum(piece, 0)])
        a, piece = a[inside], piece[inside]
        b = np.minimum(np.concatenate([a[1:], [len(self.anchor)]]), stop[piece]) if len(a) else a
        return a, b, use[piece]


def distinct_rows(part: pa.RecordBatch) -> np.ndarray:
    """Indices of the first of rows that share k1 and k2."""
    k1, k2 = long_arrays(part)
    order = np.lexsort((k2, k1))
    new = np.ones(len(order), bool)
    new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
    return np.sort(order[new])


def candidates(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, ranges of string starts) whose anchors are estimated to repeat."""
    groups = n_groups(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches):
            part = part.take(pa.array(distinct_rows(part)))
            raw, got = [(t or "").encode() for t in part.column("text").to_pylist()], []
            for lo, hi in chunks([len(r) for r in raw], WORK_BYTES):
                s = Strings(raw[lo:hi], length, gram)
                a, b, text = s.runs()
                if len(a):
                    got.append((s.grams[s.anchor[a]], a - s.first[text], b - a, text + lo))
            if not got:
                continue
            keys, where, size, text = (np.concatenate([g[i] for g in got]) for i in range(4))
            first, _ = local_counts(keys)
            _, entry = np.unique(keys, return_inverse=True)
            rank = np.empty(int(first.sum()), np.int64)
            rank[entry[first]] = np.arange(int(first.sum()))
            k1, k2 = long_arrays(part)
            directory = pack(k1, k2, text.astype(np.uint16), where.astype(np.uint32), size.astype(np.uint16), rank[entry].astype(np.uint32))
            yield repeat_asks(block, keys, groups, directory)

    def combine(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        k1, k2, text, where, n, entry = unpack(directory, np.int64, np.int64, np.uint16, np.uint32, np.uint16, np.uint32)
        hit = np.zeros(int(entry.max()) + 1, bool)
        for body in answers:
            hit[unpack(body, np.uint32)[0]] = True
        hit = hit[entry]
        a = where[hit].astype(np.int64)
        return found_batch(k1, k2, text[hit], a, a + n[hit])

    asks = rows.select("k1", "k2", "text").mapInArrow(lean(ask), ASK_SCHEMA)
    return answered(asks, repeat_answers, combine, FOUND_SCHEMA)


_KINDS = (np.uint64, np.int64, np.uint16, np.uint32, np.uint16, np.uint8, np.uint8)


def repeated(rows: DataFrame, found: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, ranges of string starts) that are repeated, among the candidates ``found``."""
    groups = n_groups(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches):
            part = part.take(pa.array(distinct_rows(part)))
            raw, text_of, from_ = [], [], []
            for t, (text, r) in enumerate(zip(part.column("text").to_pylist(), part.column("ranges").to_pylist(), strict=True)):
                data = text.encode()
                for a, b in np.frombuffer(r, np.int32).reshape(-1, 2).tolist():
                    raw.append(data[a : b + length - 1])
                    text_of.append(t)
                    from_.append(a)
            s = Strings(raw, length, gram)
            text_of, from_ = np.array(text_of), np.array(from_)
            ids = part.column("id").fill_null(NULL_ID).to_numpy()
            k1, k2 = long_arrays(part)
            a, b, piece = s.runs()
            if not len(a):
                continue
            key, text, where, lead = s.grams[s.anchor[a]], text_of[piece], a - s.first[piece] + from_[piece], s.anchor[a] - a
            # Anchors that the block holds again are sorted here: the earliest copy of a string is sent, later ones are known.
            _, again = local_counts(key)
            runs = np.flatnonzero(again)
            n, a_of = b - a, a
            run, x, y = sorted_hits(key[runs], ids[text[runs]], where[runs], n[runs], a[runs], lead[runs], s.bytes, length)
            run = runs[run]
            directory = pack(k1, k2, text[run].astype(np.uint16), (where[run] + x).astype(np.uint32), (y - x).astype(np.uint32))
            known = np.zeros(len(s.bytes) + 1, bool)
            known[wa.expand(a[run] + x, a[run] + y)] = True
            at = wa.expand(a, b)
            of = np.repeat(np.arange(len(a)), n)
            left = ~known[at]
            at, of = at[left], of[left]
            new = np.flatnonzero((np.diff(of) != 0) | (np.diff(at) != 1)) + 1
            first, stop = np.concatenate([[0], new]), np.concatenate([new, [len(at)]])
            of, a, n = of[first], at[first], stop - first
            key, text, lead, where = key[of], text[of], s.anchor[a] - a, where[of] + (a - a_of[of])
            group = ((wa.mix(key) >> wa.U(33)) % wa.U(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            a, n, key, text, where, lead, group = (z[order] for z in (a, n, key, text, where, lead, group))
            edge = np.flatnonzero(np.diff(group)) + 1
            names, bodies = [], []
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(a)], strict=True):
                bodies.append(
                    pack(
                        key[lo:hi],
                        ids[text[lo:hi]],
                        text[lo:hi].astype(np.uint16),
                        where[lo:hi].astype(np.uint32),
                        n[lo:hi].astype(np.uint16),
                        lead[lo:hi].astype(np.uint8),
                        s.bytes[wa.expand(a[lo:hi], a[lo:hi] + n[lo:hi] + length - 1)],
                    )
                )
                names.append(int(group[lo]))
            yield ask_batch(block, names, directory, bodies)

    def merge(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
        parts = [unpack(b, *_KINDS) for b in bodies]
        key, ids, text, start, n, lead = (np.concatenate([p[i] for p in parts]) for i in range(6))
        data = np.concatenate([p[6] for p in parts])
        n = n.astype(np.int64)
        size = n + length - 1
        offset = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        run, a, b = sorted_hits(key, ids, start, n, offset, lead, data, length)
        by = owner[run]
        out: list[bytes | None] = []
        for k in range(len(parts)):
            mine = by == k
            got = run[mine]
            out.append(pack(text[got], (start[got] + a[mine]).astype(np.uint32), (b - a)[mine].astype(np.uint32)) if len(got) else None)
        return out

    def combine(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        k1, k2, *own = unpack(directory, np.int64, np.int64, np.uint16, np.uint32, np.uint32)
        got = [own, *(unpack(a, np.uint16, np.uint32, np.uint32) for a in answers)]
        text, a, n = (np.concatenate([g[i] for g in got]).astype(np.int64) for i in range(3))
        return found_batch(k1, k2, text, a, a + n)

    asks = join_payload(rows.select("k1", "k2", "id", "text"), found, "ranges", "inner").mapInArrow(lean(ask), ASK_SCHEMA)
    return answered(asks, merge, combine, FOUND_SCHEMA).dropDuplicates(["k1", "k2"])


def split_runs(a: np.ndarray, b: np.ndarray, piece: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut runs of entries where the piece changes or places do not follow each other."""
    if not len(a):
        return a, b
    stops = np.flatnonzero((np.diff(piece) != 0) | (np.diff(where) != 1)) + 1
    starts = np.union1d(a, stops)
    run = np.searchsorted(a, starts, "right") - 1
    inside = (run >= 0) & (starts < b[np.maximum(run, 0)])
    starts, run = starts[inside], run[inside]
    return starts, np.minimum(np.concatenate([starts[1:], [b[-1]]]), b[run])


def sorted_hits(key, ids, start, n, offset, lead, data, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, first, end) of the strings of each run that are repeated, by suffix sorting of one bucket at a time.

    Runs: their anchor's hash, document, place in it, number of strings, place in ``data``, and the anchor's distance.
    """
    order = np.argsort(key, kind="stable")
    keys = key[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    size, filled = n + length - 1, np.cumsum(n[order])
    hits: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
    at = 0
    while at < len(order):
        # Whole anchors up to BUCKET suffixes, one at least.
        done = filled[at - 1] if at else 0
        stop = int(np.searchsorted(filled, done + BUCKET, "right"))
        if stop < len(order):
            later = edge[np.searchsorted(edge, at, "right") :]
            ends = later[: np.searchsorted(later, stop, "right")]
            stop = int(ends[-1] if len(ends) else later[0] if len(later) else len(order))
        hits.append(_bucket(order[at:stop], ids, start, n, size, offset, lead, data, length))
        at = stop
    return tuple(np.concatenate([h[i] for h in hits]) for i in range(3))


def _bucket(runs, ids, start, n, size, offset, lead, data, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort one bucket: (run, first, end) of the strings of each run that are repeated."""
    # Runs lie with their anchors at multiples of COVER, so equal strings have equal residues.
    ahead = (-lead[runs].astype(np.int64)) % COVER
    room = -(-(ahead + size[runs]) // COVER) * COVER
    base = np.cumsum(room) - room + ahead
    text = np.zeros(int(room.sum()), np.uint8)
    text[wa.expand(base, base + size[runs])] = data[wa.expand(offset[runs], offset[runs] + size[runs])]
    at = wa.expand(base, base + n[runs])
    run = np.repeat(np.arange(len(runs)), n[runs])
    order, same = sort_suffixes(text, at, length)
    group = np.cumsum(~same) - 1
    both = same.copy()
    both[:-1] |= same[1:]
    pick = np.flatnonzero(both)
    order, group = order[pick], group[pick]
    r = run[order]
    doc, where = ids[runs[r]], start[runs[r]] + (at[order] - base[r])
    by = np.lexsort((where, doc, group))
    order, group, doc, where = order[by], group[by], doc[by], where[by]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    nth = np.repeat(first, np.diff(np.concatenate([first, [len(group)]])))
    later = (doc != doc[nth]) | (where != where[nth])
    hit = np.zeros(len(at), bool)
    hit[order[later]] = True
    a, b = wa.ranges(np.flatnonzero(hit))
    a, b = split_runs(a, b, run, at)
    return runs[run[a]], at[a] - base[run[a]], at[a] - base[run[a]] + (b - a)


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with k1, k2, id, text; stored (k1, k2, ranges) of the starts of repeated strings)."""
    rows = keyed(stable(docs), id_col, text_col)
    gram = min(gram, length)
    # Later copies of whole texts: every string of theirs starts earlier in the first copy.  Copies are found by hash;
    # groups whose least and greatest text differ are no copies and go on with the others.
    text_key = [F.xxhash64(F.lit(3), "text").alias("t1"), F.xxhash64(F.lit(4), "text", F.lit(5)).alias("t2")]
    long_ = rows.where(F.octet_length("text") >= length)
    brief = long_.select("k1", "k2", "id", F.octet_length("text").alias("n"), *text_key)
    groups = brief.groupBy("t1", "t2").agg(F.min(F.coalesce("id", F.lit(NULL_ID))).alias("least"), F.count("*").alias("_n")).where("_n > 1")
    groups = cut(groups, "suffix-groups")
    texts = join_by_size(long_.select("text", *text_key), groups.select("t1", "t2", "_n"), ["t1", "t2"])
    ends = texts.groupBy("t1", "t2").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).where("lo = hi").select("t1", "t2")
    equal = cut(groups.join(ends.hint("merge"), ["t1", "t2"], "left_semi"), "suffix-equal")
    later = join_by_size(brief, equal, ["t1", "t2"]).where(F.coalesce("id", F.lit(NULL_ID)) > F.col("least"))
    copies = cut(later.select("k1", "k2", "n").distinct(), "suffix-copies")
    discard(groups, equal)
    first = cut(candidates(rows, length, gram).dropDuplicates(["k1", "k2"]), "suffix-candidates")
    own = cut(repeated(rows, first.join(copies, ["k1", "k2"], "left_anti"), length, gram), "suffix-repeats")
    discard(first)
    whole = F.to_binary(F.concat(F.lit("00000000"), _little(F.col("n") - (length - 1))), F.lit("hex"))
    found = own.unionByName(copies.select("k1", "k2", whole.alias("ranges")))
    return rows, found


def _little(n):
    """The hex digits of a number as four bytes, least first."""
    digits = F.lpad(F.hex(n), 8, "0")
    return F.concat(*(F.substring(digits, k, 2) for k in (7, 5, 3, 1)))


SCHEMA = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept; ``with_text`` adds them as text."""
    rows, found = repeated_strings(docs, length, gram, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}" + ", kept_text string" * with_text
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, r in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                raw = (text or "").encode()
                kept, at, spans = [], 0, 0
                for a, b in np.frombuffer(r or b"", np.int32).reshape(-1, 2).tolist():
                    if a > at or not spans:
                        spans += 1
                        kept.append(raw[at:a])
                    at = max(at, b + length - 1)
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest(), *[left.decode("utf-8", "replace")] * with_text))
            columns = list(zip(*out, strict=True)) if out else [[]] * (len(names) - 1)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=False))], names=names)

    return join_payload(rows, found, "ranges", "left").select("id", "text", "ranges").mapInArrow(lean(run), schema)
