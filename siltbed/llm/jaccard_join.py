"""Joining near-duplicate documents by n-gram Jaccard similarity, with signature trees.

A document's set holds its distinct shingles of ``shingle`` lower-cased words.
Two documents link when their sets have a Jaccard similarity of at least
``PERCENT`` / 100; the result is the connected components of all links, and no
step misses a link.

1. Prefilter.  In a common order of shingles (by hash), sets that link share
   many of their least shingles: with a = ceil(0.75 n) and l = max(1, n // 4), the
   first n - a + l shingles of both hold at least min(l, l') common ones, and a
   partner has at least a shingles.  Sparse sketches (see ``window_dedup``) count
   the shingles of these prefixes over all documents, never too low; documents
   with fewer repeated ones than that link with nothing.
2. Equal sets fall into one class, and one set of each class goes on.
3. A first join inside buckets of equal least shingles (under ``BANDS``
   permutations, large buckets cut at random) finds most links, which merge
   classes into components.
4. The exact join: in any common order, two classes that link share a shingle of
   their shortest prefixes (n - a + 1).  The order is by the number of classes that
   hold a shingle (from sketches, up to 255), rarest first.  Lists of classes that share such a shingle and are not
   yet one component lose the classes that cannot overlap enough after it, and are
   joined inside (equal lists once; lists of more than ``LIST`` classes as pairs of
   parts by size).  Together with the first join,
   every pair of classes that can link has been either tested or is connected.

Inside a bucket or list the sets stand in a signature tree: leaves of sets next
to each other by size and least shingle, and above them nodes with the OR of
their token bitmaps and their range of sizes.  Traversing pairs of nodes, a pair
is dropped if no two sets below can overlap enough (by sizes, by common bits
plus the most tokens that share bits) or if all sets below are one component
already.  Pairs of sets that are left are compared exactly.

Cases: null texts, and texts without words, have empty sets and link with
nothing.  With fewer words than a shingle, the whole sequence is the one
shingle.  Ids are longs; rows that share an id count as one document holding
each of their links, and a null id as the least.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordarrays as wa
from .components import components
from .exchange import ASK_SCHEMA, MAX_GROUPS, answered, ask_rows, blocks, join_payload, keyed, n_groups, pack, stable, unpack
from .shared import BROADCAST_ROWS, WORK_BYTES, chunks, cut, discard, join_by_size, lean, lean_group

SHINGLE = 5
PERCENT = 75
BANDS = 2
BUCKET = 1000
LIST = 2000
SMALL = 400
#: Lists of one key that meet in a task.
KEY_LISTS = 256
LEAF = 16
FAN = 8
BLOCK_ROWS = 4096
HASH_BITS = 52
MARK = 0xFFFF
NULL_ID = -(1 << 63)
_SEEDS = (0x8CB92BA72F3D8DD7, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x589965CC75374CC3)


# -- sets


def shingle_sets(texts: list[str | None], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, n): the distinct shingle hashes of all texts, ascending within each, and how many each text has."""
    parts = [_shingle_sets(texts[a:b], shingle) for a, b in chunks([len(t or "") for t in texts], WORK_BYTES)]
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(2)) if parts else (np.zeros(0, wa.U), np.zeros(0, np.int64))


def _shingle_sets(texts: list[str | None], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    words = wa.Words(texts, lower=True)
    start, text = words.windows(shingle)
    h = wa.rolling(words.hash, shingle, 1)[start] if len(start) else np.zeros(0, wa.U)
    short = np.flatnonzero((words.count > 0) & (words.count < shingle))
    if len(short):
        whole = wa.span(wa.prefix(words.hash, 1), words.first[short], words.first[short + 1], 1)
        h, text = np.concatenate([h, whole]), np.concatenate([text, short])
    key = np.sort(text.astype(wa.U) << wa.U(HASH_BITS) | h >> wa.U(64 - HASH_BITS))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    n = np.bincount((key >> wa.U(HASH_BITS)).astype(np.int64), minlength=len(texts))
    return key & wa.U((1 << HASH_BITS) - 1), n


def least_overlap(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n with any partner."""
    return -(-n * PERCENT // 100)


def _lengths(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix length, repeated shingles needed) of the prefilter."""
    spare = np.maximum(n // 4, 1)
    partner = least_overlap(n)
    return np.minimum(n - partner + spare, n), np.maximum(partner // 4, 1)


# -- signature trees


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class SignatureTree:
    """Nodes over sets sorted by size and least token: children, range of sets, sizes, bitmap and excess."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        middle = int(np.median(self.size)) if len(sets) else 1
        self.bits = max(256, min(1 << 16, 1 << (8 * max(middle, 1) - 1).bit_length()))
        words = self.bits // 64
        self.map = np.zeros((len(sets), words), np.uint64)
        for i, s in enumerate(sets):
            at = (wa.mix(s) & wa.U(self.bits - 1)).astype(np.int64)
            flags = np.zeros(self.bits, np.uint8)
            flags[at] = 1
            self.map[i] = np.packbits(flags).view(np.uint64)
        self.excess = self.size - np.bitwise_count(self.map).sum(1, dtype=np.int64)
        # Levels: ranges [a, b) of sets, leaves first; OR of the bitmaps, least and largest size, largest excess.
        self.levels = []
        edges = list(range(0, len(sets), LEAF)) + [len(sets)]
        a, b = np.array(edges[:-1]), np.array(edges[1:])
        bitmap = np.bitwise_or.reduceat(self.map, a, axis=0)
        self.levels.append([a, b, bitmap, self.size[a], self.size[b - 1], np.maximum.reduceat(self.excess, a)])
        while len(self.levels[-1][0]) > 1:
            a, b, bitmap, low, high, excess = self.levels[-1]
            at = np.arange(0, len(a), FAN)
            last = np.minimum(at + FAN, len(a)) - 1
            self.levels.append(
                [a[at], b[last], np.bitwise_or.reduceat(bitmap, at, axis=0), low[at], high[last], np.maximum.reduceat(excess, at)]
            )

    def pairs(self, forest: _Forest) -> Iterator[tuple[int, int]]:
        """Pairs of sets that may link and are not in one tree of ``forest`` when they come up."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, x, y = stack.pop()
            a, b, bitmap, low, high, excess = self.levels[level]
            # y is not before x, so its sets are not smaller.
            if 100 * high[x] < PERCENT * low[y]:
                continue
            need = -(-PERCENT * (low[x] + low[y]) // (100 + PERCENT))
            common = int(np.bitwise_count(bitmap[x] & bitmap[y]).sum()) + min(excess[x], excess[y])
            if common < need or high[x] < need:
                continue
            if len({forest.find(i) for i in range(a[x], b[x])} | {forest.find(i) for i in range(a[y], b[y])}) == 1:
                continue
            if level == 0:
                yield from self._leaf_pairs(a[x], b[x], a[y], b[y], x == y, forest)
                continue
            n = len(self.levels[level - 1][0])
            xs, ys = range(x * FAN, min(x * FAN + FAN, n)), range(y * FAN, min(y * FAN + FAN, n))
            inner = [(level - 1, i, j) for i in xs for j in ys if i <= j]
            inner.sort(key=lambda t: t[1] - t[2])  # near pairs come off the stack first
            stack += inner

    def _leaf_pairs(self, a, b, c, d, same, forest) -> Iterator[tuple[int, int]]:
        common = np.bitwise_count(self.map[a:b, None, :] & self.map[None, c:d, :]).sum(2, dtype=np.int64)
        common += np.minimum(self.excess[a:b, None], self.excess[None, c:d])
        need = -(-PERCENT * (self.size[a:b, None] + self.size[None, c:d]) // (100 + PERCENT))
        fit = (common >= need) & (np.minimum(self.size[a:b, None], self.size[None, c:d]) >= need)
        for i, j in np.argwhere(fit).tolist():
            i, j = i + int(a), j + int(c)
            if (not same or i < j) and forest.find(i) != forest.find(j):
                yield i, j


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def linked(sets: list[np.ndarray], known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between the sets (indices) that join all their components; ``known`` names components that hold already."""
    if len(sets) == 2:
        if known is not None and known[0] == known[1]:
            return []
        return [(0, 1)] if similar(sets[0], sets[1]) else []
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
    forest = _Forest(len(sets))
    if known is not None:
        first: dict[int, int] = {}
        for k, i in enumerate(order):
            forest.join(first.setdefault(known[i], k), k)
    tree = SignatureTree([sets[i] for i in order])
    out = []
    for i, j in tree.pairs(forest):
        if similar(tree.sets[i], tree.sets[j]) and forest.join(i, j):
            out.append((order[i], order[j]))
    return out


# -- steps


def _counted(rows: DataFrame, shingle: int) -> DataFrame:
    """(k1, k2, id, n, alive) of every row; alive: the prefilter leaves it."""
    groups = n_groups(rows)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches, max_rows=BLOCK_ROWS):
            h, n = shingle_sets(part.column("text").to_pylist(), shingle)
            text = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            length, _ = _lengths(n)
            use = place < length[text]
            h, text = h[use], text[use]
            # A shingle held twice in the block is known to repeat; it is sent once, with a mark.
            order = np.argsort(h)
            s = h[order]
            again = np.zeros(len(s), bool)
            again[1:] = s[1:] == s[:-1]
            more = np.zeros(len(s), bool)
            more[:-1] = again[1:]
            twice = again | more
            own = np.bincount(text[order][twice], minlength=len(n))
            first = np.flatnonzero(~again)
            mixed = wa.mix(s[first])
            group = ((mixed >> wa.U(33)) % wa.U(groups)).astype(np.int64)
            who = np.where(twice[first], MARK, text[order][first]).astype(np.uint16)
            k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
            ids = part.column("id").fill_null(NULL_ID).to_numpy()
            directory = pack(k1, k2, ids, n.astype(np.int64), own.astype(np.int64))
            yield ask_rows(block, group, directory, (mixed & wa.U(0xFFFFFFFF)).astype(np.uint32), who)

    def merge(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
        parts = [unpack(b, np.uint32, np.uint16) for b in bodies]
        cell, who = (np.concatenate([p[i] for p in parts]) for i in range(2))
        order = np.argsort(cell)
        s = cell[order]
        new = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
        count = np.add.reduceat(1 + (who[order] == MARK).astype(np.int64), new)
        hit = np.empty(len(s), bool)
        hit[order] = np.repeat(count >= 2, np.diff(np.concatenate([new, [len(s)]])))
        hit &= who != MARK
        out, at = [], 0
        for p in parts:
            got, times = np.unique(who[at : at + len(p[0])][hit[at : at + len(p[0])]], return_counts=True)
            at += len(p[0])
            out.append(pack(got, times.astype(np.uint32)) if len(got) else None)
        return out

    def combine(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        k1, k2, ids, n, own = unpack(directory, *[np.int64] * 5)
        hits = own.copy()
        for a in answers:
            who, times = unpack(a, np.uint16, np.uint32)
            hits[who] += times
        _, need = _lengths(n)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (k1, k2, ids, n, (n > 0) & (hits >= need))], names=["k1", "k2", "id", "n", "alive"])

    asks = rows.select("k1", "k2", "id", "text").mapInArrow(lean(ask), ASK_SCHEMA)
    return answered(asks, merge, combine, "k1 long, k2 long, id long, n long, alive boolean")


def _sets(rows: DataFrame, alive: DataFrame, shingle: int) -> DataFrame:
    """(id, n, s1, s2, m0.., tokens) of the rows that are alive; s1, s2 name the set, m its least hashes by band."""
    bands = [f"m{j}" for j in range(BANDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                h, n = shingle_sets(part.column("text").to_pylist(), shingle)
                at = np.cumsum(n) - n
                name = [np.add.reduceat(wa.mix(h ^ wa.U(s)), at).view(np.int64) for s in _SEEDS[:2]]
                low = [np.minimum.reduceat(wa.mix(h ^ wa.U(s + 2)), at).view(np.int64) for s in _SEEDS[2 : 2 + BANDS]]
                tokens = [h[i : i + k].tobytes() for i, k in zip(at.tolist(), n.tolist(), strict=True)]
                columns = [part.column("id").fill_null(NULL_ID), pa.array(n), *map(pa.array, name + low), pa.array(tokens, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "s1", "s2", *bands, "tokens"])

    found = join_payload(rows.select("k1", "k2", "id", "text"), alive.select("k1", "k2", F.lit(b"").alias("x")), "x", "left_semi")
    return found.mapInArrow(lean(run), "id long, n long, s1 long, s2 long, " + ", ".join(f"{m} long" for m in bands) + ", tokens binary")


def _joined(members: DataFrame, name: str) -> DataFrame:
    """Links (a, b) inside each value of (grp, part); rows: grp, part, node, comp, tokens."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        tokens = table.column("tokens").to_pylist()
        order = np.lexsort((node, part))
        edge = np.flatnonzero(np.diff(part[order])) + 1
        out = []
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(order)], strict=True):
            if hi - lo > 1:
                mine = order[lo:hi]
                links = linked([np.frombuffer(tokens[i], wa.U) for i in mine], comp[mine].tolist())
                out += [(int(node[mine[i]]), int(node[mine[j]])) for i, j in links]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return cut(members.groupBy("grp").applyInArrow(lean_group(run), "a long, b long"), name)


def _first_links(reps: DataFrame) -> DataFrame:
    """Links inside buckets of equal least shingles."""
    groups = n_groups(reps)
    pairs = reps.select("node", F.posexplode(F.array(*[f"m{j}" for j in range(BANDS)])).alias("band", "low"))
    sizes = pairs.groupBy("band", "low").agg(F.count("*").alias("c")).where("c > 1")
    placed = pairs.join(sizes, ["band", "low"]).withColumn(
        "part", F.xxhash64("band", "low", F.pmod(F.xxhash64("node", "band"), F.ceil(F.col("c") / BUCKET)))
    )
    tokens = reps.select("node", F.col("node").alias("comp"), "tokens")
    rows = placed.select("node", "part").join(tokens.hint("merge"), "node")
    return _joined(rows.withColumn("grp", F.pmod("part", F.lit(groups))), "links")


def _open_lists(reps: DataFrame) -> DataFrame:
    """(key, members): lists of nodes that share a shingle of their shortest prefixes and are not one component."""
    groups = n_groups(reps)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                block = part << 32 | k
                k += 1
                h = np.concatenate([np.frombuffer(t, wa.U) for t in rows.column("tokens").to_pylist()])
                mixed = wa.mix(h)
                group = ((mixed >> wa.U(33)) % wa.U(groups)).astype(np.int64)
                directory = pack(*(rows.column(c).to_numpy() for c in ("node", "comp", "n")), h)
                entry = np.arange(len(h), dtype=np.uint32)
                yield ask_rows(block, group, directory, (mixed & wa.U(0xFFFFFFFF)).astype(np.uint32), entry)

    def frequencies(block: list[int], bodies: list[bytes]) -> list[bytes | None]:
        parts = [unpack(b, np.uint32, np.uint32) for b in bodies]
        cell = np.concatenate([p[0] for p in parts])
        order = np.argsort(cell)
        s = cell[order]
        new = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
        times = np.diff(np.concatenate([new, [len(s)]]))
        count = np.empty(len(s), np.uint8)
        count[order] = np.repeat(np.minimum(times, 255), times)
        out, at = [], 0
        for p in parts:
            mine = count[at : at + len(p[0])]
            at += len(p[0])
            more = mine > 1
            out.append(pack(p[1][more], mine[more]) if more.any() else None)
        return out

    def prefixes(directory: bytes, answers: list[bytes]) -> pa.RecordBatch:
        # The rarest shingles first; those of one set only match nothing but fill their part of the prefix.
        node, comp, n, h = unpack(directory, np.int64, np.int64, np.int64, np.uint64)
        count = np.ones(len(h), np.uint8)
        for a in answers:
            entry, times = unpack(a, np.uint32, np.uint8)
            count[entry] = times
        owner = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((h, count, owner))
        place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        use = (place < (n - least_overlap(n) + 1)[owner]) & (count[order] > 1)
        h, left, owner = h[order[use]], (n[owner] - place)[use], owner[use]
        group = (wa.mix(h) >> wa.U(33)) % wa.U(groups)
        order = np.argsort(group, kind="stable")
        h, left, owner, group = h[order], left[order], owner[order], group[order].astype(np.int64)
        edge = np.flatnonzero(np.diff(group)) + 1
        lo, hi = ([0, *edge.tolist()], [*edge.tolist(), len(group)]) if len(group) else ([], [])
        columns = h, node[owner], comp[owner], n[owner], left
        bodies = [pack(*(c[a:b] for c in columns)) for a, b in zip(lo, hi, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([int(group[a]) for a in lo], pa.int64()), pa.array(bodies, pa.binary())], names=["grp", "body"])

    def lists(table: pa.Table) -> pa.Table:
        parts = [unpack(b, np.uint64, *[np.int64] * 4) for b in table.column("body").to_pylist()]
        h, node, comp, n, left = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.lexsort((node, n, h))
        h, node, comp, n, left = (x[order] for x in (h, node, comp, n, left))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        last = np.concatenate([first[1:], [len(h)]])
        mixed = np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first)
        out: dict[bytes, int] = {}
        for a, b in zip(first[mixed].tolist(), last[mixed].tolist(), strict=True):
            if b - a <= SMALL:
                # The shingle is the first common one of some pairs: of these, keep sets that can overlap enough.
                x, y, c = n[a:b], left[a:b], comp[a:b]
                need = PERCENT * (x[:, None] + x)
                fit = ((100 + PERCENT) * np.minimum(y[:, None], y) >= need) & (c[:, None] != c)
                own = np.sort(node[a:b][fit.any(1)])
                if len(own):
                    out[own.tobytes()] = int(own[0])
                continue
            # Parts by size; a pair of parts is joined if its sizes allow a link, and a part in no pair by itself.
            edges = [*range(a, b, LIST // 2 if b - a > LIST else b - a), b]
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            pairs = [(i, j) for i, (_, q) in enumerate(spans) for j in range(i + 1, len(spans)) if 100 * n[q - 1] >= PERCENT * n[spans[j][0]]]
            paired = {i for pair in pairs for i in pair}
            for i, j in pairs + [(i, i) for i in range(len(spans)) if i not in paired]:
                (p, q), (r, s) = spans[i], spans[j]
                own = np.sort(node[p:q] if i == j else np.concatenate([node[p:q], node[r:s]]))
                out[own.tobytes()] = int(wa.mix(h[a : a + 1] + wa.U(i << 20 | r)).view(np.int64)[0])
        return pa.table({"key": pa.array(list(out.values()), pa.int64()), "members": pa.array(list(out), pa.binary())})

    asks = reps.select("node", "comp", "n", "tokens").mapInArrow(lean(ask), ASK_SCHEMA)
    found = answered(asks, frequencies, prefixes, "grp long, body binary").groupBy("grp").applyInArrow(lean_group(lists), "key long, members binary")
    return found.distinct()


def dealt(open_: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """((grp, members), (grp, node)): stored lists (key, members) dealt to groups, and the nodes that each group wants.

    Lists with a key meet, so a node goes once to each key's task; the lists of a key that has many go to several.
    """
    counts = open_.groupBy("key").agg(F.count("*").alias("c"))
    total = open_.count()
    limit = max(KEY_LISTS, -(-total // BROADCAST_ROWS))
    many = F.broadcast(counts.where(F.col("c") > limit))
    salt = F.coalesce(F.pmod(F.xxhash64("members"), F.ceil(F.col("c") / limit)), F.lit(0))
    lists = open_.join(many, "key", "left").select(F.pmod(F.xxhash64("key", salt), F.lit(groups)).alias("grp"), "members")

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(b, np.int64) for b in batch.column("members").to_pylist()]
            grp = np.repeat(batch.column("grp").to_numpy(), [len(r) for r in rows])
            pair = np.stack([grp, np.concatenate(rows) if rows else np.zeros(0, np.int64)], 1)
            pair = np.unique(pair, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["grp", "node"])

    return lists, lists.mapInArrow(lean(nodes), "grp long, node long").distinct()


def _list_links(open_: DataFrame, reps: DataFrame, node_groups: int | None = None) -> DataFrame:
    """Links (a, b) inside the open lists, in at most ``node_groups`` groups: a set goes to each group that wants it."""
    lists, pairs = dealt(open_, min(node_groups or MAX_GROUPS, 16 * n_groups(reps)))

    def run(lists: pa.Table, sets: pa.Table) -> pa.Table:
        names = sets.column("node").to_pylist()
        index = {x: i for i, x in enumerate(names)}
        tokens = [np.frombuffer(t, wa.U) for t in sets.column("tokens").to_pylist()]
        forest, first = _Forest(len(names)), {}
        for i, c in enumerate(sets.column("comp").to_pylist()):
            forest.join(first.setdefault(c, i), i)
        out = []
        for body in sorted(lists.column("members").to_pylist(), key=lambda b: (len(b), b)):
            mine = [index[x] for x in np.frombuffer(body, np.int64).tolist()]
            known = [forest.find(i) for i in mine]
            if len(set(known)) == 1:
                continue
            for i, j in linked([tokens[i] for i in mine], known):
                forest.join(mine[i], mine[j])
                out.append((names[mine[i]], names[mine[j]]))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    sets = pairs.join(reps.select("node", "comp", "tokens").hint("merge"), "node")
    return cut(lists.groupBy("grp").cogroup(sets.groupBy("grp")).applyInArrow(lean_group(run), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Document id, n_shingles and component_id (the least id that links reach, itself included) of each row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = keyed(stable(docs).withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col)
    counted = cut(_counted(rows, shingle), "jaccard-counts")
    alive = counted.where("alive").select("k1", "k2").distinct()
    sets = cut(_sets(rows, alive, shingle), "jaccard-sets")

    # Classes of equal sets, named by their least id.  One set of each goes on: it is found by class and id, so the
    # sets of many copies do not meet; only their ids do, and not in one task.
    classes = cut(sets.groupBy("s1", "s2").agg(F.min("id").alias("node"), F.count("*").alias("_n")), "jaccard-classes")
    least = classes.select("s1", "s2", F.col("node").alias("id"))
    reps = sets.join(least.hint("merge"), ["s1", "s2", "id"], "left_semi").withColumnRenamed("id", "node").drop("s1", "s2").dropDuplicates(["node", "n", "m0"])
    reps = cut(reps, "jaccard-reps")
    equal = join_by_size(sets.select("id", "s1", "s2"), classes.where("_n > 1"), ["s1", "s2"]).where("id <> node")
    equal = cut(equal.select(F.col("id").alias("a"), F.col("node").alias("b")).distinct(), "jaccard-equal")

    links = _first_links(reps)
    near = cut(components(links), "jaccard-near")
    known = reps.join(near.hint("merge"), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    known = cut(known.select("node", "comp", "n", "tokens"), "jaccard-known")
    open_ = cut(_open_lists(known), "jaccard-open")
    more = _list_links(open_, known)
    all_links = links.unionByName(more).unionByName(equal)
    final = components(all_links)
    final = cut(final, "jaccard-components")
    discard(sets, classes, reps, equal, links, near, known, open_, more)
    n = final.count()
    out = counted.join(F.broadcast(final) if n <= BROADCAST_ROWS else final.hint("merge"), counted["id"] == final["node"], "left")
    real = F.when(F.col("id") != NULL_ID, F.col("id")).cast(id_type)
    name = F.coalesce("component", "id")
    return out.select(real.alias(id_col), F.col("n").alias("n_shingles"), F.when(name != NULL_ID, name).cast(id_type).alias("component_id"))
