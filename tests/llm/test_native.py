"""Exact dedup, sharding and mixing."""

import hashlib
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from siltbed.llm import exact_dedup, mixing, sharding

from .fixture import SPACES, clashing, documents, empty, rows, unique, words


def norm(text):
    return SPACES.sub(" ", text or "")


def expected_groups(table):
    groups = {}
    for i, text, *_ in table:
        groups.setdefault(norm(text), []).append(i)
    out = []
    for i, text, *_ in table:
        ids = groups[norm(text)]
        least = min((x for x in ids if x is not None), default=None)
        out.append((i, least, len(ids), i == least, hashlib.sha256(norm(text).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("digest", [None, lambda t: F.substring(F.md5(t.cast("binary")), 1, 1).cast("binary"), lambda t: F.lit(b"one")])
def test_exact_groups_even_when_digests_collide(spark, digest):
    docs = clashing(documents(spark))
    got = exact_dedup.exact_groups(docs, **({"digest": digest} if digest else {})).collect()
    assert Counter(map(tuple, got)) == expected_groups(rows())


def test_exact_groups_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 2)
    got = exact_dedup.exact_groups(documents(spark)).collect()
    assert Counter(map(tuple, got)) == expected_groups(rows())


def test_exact_dedup_keeps_columns_and_rows(spark):
    docs, own = unique(spark)
    docs = docs.withColumn("extra", F.lit(1))
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == docs.columns
    least = {}
    for i, text, *_ in own:
        least[norm(text)] = min(i, least.get(norm(text), i))
    assert sorted(r.doc_id for r in got.collect()) == sorted(least.values())


def test_shards_balance_and_places_have_no_gaps(spark):
    docs = clashing(documents(spark))
    got = sharding.shard_documents(docs, n_shards=4).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows()
    )
    for k in range(4):
        places = sorted(r.slot for r in got if r.shard == k)
        assert places == list(range(len(places)))
    assert {r.vslot: r.shard for r in got}.keys() <= set(range(sharding.N_SLOTS))
    assert len({(r.vslot, r.shard) for r in got}) == len({r.vslot for r in got})


def test_slot_maps_are_versioned_and_edited(spark, tmp_path):
    sizes = [(100 + s % 7, 1) for s in range(512)]
    first = sharding.assign(sizes, 4)
    load = lambda m, n: [sum(sizes[s][0] for s, k in enumerate(m) if k == x) for x in range(n)]
    assert max(load(first, 4)) - min(load(first, 4)) <= 106
    grown = sharding.grow(first, sizes, 4)
    assert all(a == b or b == 4 for a, b in zip(first, grown, strict=True))
    assert max(load(grown, 5)) <= 1.1 * sum(load(grown, 5)) / 5
    sizes = [(s[0] * (5 if first[i] == 0 else 1), 1) for i, s in enumerate(sizes)]
    moved = sharding.rebalance(first, sizes, 4)
    assert max(load(moved, 4)) < max(load(first, 4)) * 0.7
    assert sum(a != b for a, b in zip(first, moved, strict=True)) < 300
    path = f"file://{tmp_path}/map"
    sharding.store_map(sharding.map_frame(spark, 1, first, sizes), path)
    sharding.store_map(sharding.map_frame(spark, 2, moved, sizes), path)
    latest = {r.vslot: r.shard for r in sharding.load_map(spark, path).collect()}
    assert [latest[s] for s in range(512)] == moved
    assert sharding.load_map(spark, path, 1).count() == 512


def test_a_stored_map_is_reused(spark, tmp_path):
    docs, path = documents(spark), f"file://{tmp_path}/own"
    a = {r.vslot: r.shard for r in sharding.shard_documents(docs, 4, map_path=path).collect()}
    b = {r.vslot: r.shard for r in sharding.shard_documents(docs, 4, map_path=path).collect()}
    assert sum(a[k] != b[k] for k in a) <= len(a) // 4
    assert sharding.load_map(spark, path).first().version == 2


def expected_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / total for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("scale", [None, {"a": 3, "b": 1000, "c": 10, None: 40, "d": 0}, {"x": 5}, {"a": 1, "b": 100000, "c": 1}])
def test_targets(spark, scale):
    sizes = scale or {"a": 500, "b": 300, "é": 2, None: 7}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    for s, t in expected_targets(sizes).items():
        assert got[s] == pytest.approx(t, abs=1e-6)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_mix_meets_targets(spark, block):
    docs = clashing(documents(spark))
    got = mixing.Mix(docs, block=block).taken().collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(words(t))) for i, t, *_ in rows())
    sizes = Counter()
    for _, t, _, s, _ in rows():
        sizes[s] += len(words(t))
    by_size = {}
    for r in got:
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
        assert 0 <= r.taken <= 3 * r["size"]
    target = expected_targets(sizes)
    for s, n in sizes.items():
        mine = by_size[(n, round(target[s], 6))]
        assert abs(sum(r.taken for r in mine) - target[s]) <= 0.5
    again = mixing.Mix(docs, block=block).taken().collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_blocks_hold_the_words(spark):
    docs, own = unique(spark)
    mix = mixing.Mix(docs, block=16, slots_per_shard=32)
    blocks = mixing.mixed_blocks(mix, docs).collect()
    taken = Counter()
    by_id = {i: (t, s) for i, t, _, s, _ in own}
    for r in mix.taken_pieces().collect():
        taken.update(words(by_id[r._id][0])[r.block * 16 + r.lo - r.start : r.block * 16 + r.hi - r.start])
    assert Counter(w for b in blocks for w in words(b.text)) == taken
    assert all(len(words(b.text)) <= 16 for b in blocks)
    places = sorted((b.shard, b.position) for b in blocks)
    assert len(set(places)) == len(places) and max(p for _, p in places) < 32
    assert mixing.shard_counts(mix).agg(F.sum("slots")).first()[0] == len(blocks)


def spark_hash(*values):
    """Spark's xxhash64 of integers: (value, width in bytes) each hashed with the one before as its seed."""
    seed = 42
    for v, width in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(width, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_shuffle(x, n, *key):
    for r in range(1, mixing.ROUNDS + 1):
        partner = (spark_hash((11, 4), (r, 4), *key) % n - x) % n
        if spark_hash((13, 4), (r, 4), (max(x, partner), 8), *key) & 1:
            x = partner
    return x


def test_the_draw(spark):
    """Every slot against a plain version of both permutations; and the rows' places against the slots."""
    docs, own = unique(spark)
    mix = mixing.Mix(docs, block=16, slots_per_shard=32)
    sizes = Counter()
    for _, t, _, s, _ in own:
        sizes[s] += len(words(t))
    target = expected_targets(sizes)
    plan = []
    for sid, s in enumerate(sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))):
        full, tail = divmod(sizes[s], 16)
        left, j = round(target[s]), 0
        while left > 0:
            p, r = divmod(j, full + (tail > 0))
            block = plain_shuffle(r, full, (1, 4), (sid, 4), (p, 8)) if r < full else full
            take = min(left, 16 if block < full else tail)
            plan.append((sid, block, take, p))
            left, j = left - take, j + 1
    want = Counter()
    for k, slot in enumerate(plan):
        x = plain_shuffle(k, len(plan), (1, 4))
        want[(*slot, x // 32, x % 32)] += 1
    got = Counter((r.sid, r.block, r["take"], r["pass"], r.shard, r.position) for r in mix.slots.collect())
    assert got == want
    counts = Counter()
    for (sid, _, _, _, shard, _), n in want.items():
        counts[shard, sid] += n
    assert {(r.shard, r.sid): r.slots for r in mixing.shard_counts(mix).collect()} == counts
    for r in mix.taken().collect():
        assert (r.slots > 0) == (r.taken > 0) and (r.first_shard is not None) == (r.taken > 0)
    other = mixing.Mix(docs, block=16, slots_per_shard=32, seed=2).taken()
    assert {(r.doc_id, r.placement) for r in other.collect()} != {(r.doc_id, r.placement) for r in mix.taken().collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_shuffle_is_a_permutation(spark, n):
    got = spark.range(n).select(mixing.shuffled(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("y")).collect()
    assert sorted(r.y for r in got) == list(range(n))


def test_empty_tables(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert sharding.shard_documents(empty(spark)).count() == 0
    assert mixing.Mix(empty(spark)).taken().count() == 0
