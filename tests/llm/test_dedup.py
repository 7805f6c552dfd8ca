"""Window, substring, line and near-duplicate operators against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltbed.llm import components, jaccard_join, line_dedup, suffix_dedup, window_dedup
from siltbed.llm import wordarrays as wa

from .fixture import LOWER, SCHEMA, clashing, documents, empty, rows, unique, words


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("window", [3, 35])
def test_windows(spark, window):
    table, count = rows(), Counter()
    for _, text, *_ in table:
        w = words(text)
        count.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    want = Counter()
    for i, text, *_ in table:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i, len(w), sum(gone), sha(kept.encode())] += 1
    got = window_dedup.remove_repeats(clashing(documents(spark)), window=window, gram=min(10, window)).collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("length", [12, 100])
def test_substrings(spark, length):
    docs, own = unique(spark)
    seen, want = set(), Counter()
    for i, text, *_ in sorted(own):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            part = raw[k : k + length]
            if part in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(part)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        want[i, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))] += 1
    got = suffix_dedup.remove_repeats(clashing(docs), length=length, gram=min(32, length)).collect()
    assert Counter(map(tuple, got)) == want


@pytest.fixture
def by_value():
    """Workers get a module as the test has changed it."""
    from pyspark import cloudpickle

    held = []

    def register(module):
        cloudpickle.register_pickle_by_value(module)
        held.append(module)

    yield register
    for module in held:
        cloudpickle.unregister_pickle_by_value(module)


@pytest.mark.parametrize("cells", [1, 64])
def test_sketches_of_any_size_lose_nothing(spark, monkeypatch, by_value, cells):
    """Counters that many anchors share overestimate; the exact pass decides."""
    docs, own = unique(spark)
    want = {r.doc_id: r.kept_sha256 for r in window_dedup.remove_repeats(docs).collect()}
    by_value(window_dedup)
    monkeypatch.setattr(window_dedup, "CELLS", cells)
    assert {r.doc_id: r.kept_sha256 for r in window_dedup.remove_repeats(docs).collect()} == want


def test_the_sketch_decides_what_goes_on(spark, monkeypatch):
    docs, own = unique(spark)
    monkeypatch.setattr(window_dedup, "merge_sketch", lambda block, bodies: [None] * len(bodies))
    assert window_dedup.remove_repeats(docs).where("n_removed > 0").count() == 0


def test_suffix_sorting_decides_what_goes(spark, monkeypatch, by_value):
    """Without sorting nothing is removed, in blocks either, but later copies of whole texts."""
    docs, own = unique(spark)
    none = lambda text, at, depth, v=32: (np.arange(len(at)), np.zeros(len(at), bool))
    by_value(suffix_dedup)
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", none)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs.coalesce(1)).collect()}
    by_text = {}
    for i, t, *_ in sorted(own, key=lambda r: r[0]):
        whole = len((t or "").encode())
        assert got[i] == (whole if whole >= 100 and t in by_text else 0)
        by_text.setdefault(t, i)


def test_texts_above_one_block(spark, monkeypatch):
    """Blocks of a few hundred bytes, so that texts are longer than a block and blocks hold one text each."""
    from siltbed.llm import exchange

    docs, own = unique(spark)
    runs = [
        lambda: {r.doc_id: (r.n_removed, r.kept_sha256) for r in window_dedup.remove_repeats(docs).collect()},
        lambda: {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()},
        lambda: {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()},
        lambda: {r.doc_id: (r.n_removed, r.kept_sha256) for r in line_dedup.line_report(docs).collect()},
    ]
    want = [f() for f in runs]
    small = lambda f: lambda batches, limit=500, max_rows=3: f(batches, limit, max_rows)
    for module in (window_dedup, suffix_dedup, jaccard_join, line_dedup):
        monkeypatch.setattr(module, "blocks", small(exchange.blocks))
    assert [f() for f in runs] == want


def test_rows_that_repeat_are_one_document_for_substrings(spark):
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "short"), (2, text)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == {(1, 0): 2, (None, 0): 1, (2, 300): 1}


@given(st.binary(min_size=0, max_size=300), st.integers(1, 4), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_suffix_order(data, letters, depth):
    text = np.frombuffer(data, np.uint8) % letters
    raw = text.tobytes() + bytes(2 * depth + 400)
    at = np.arange(len(text))
    order, same = suffix_dedup.sort_suffixes(text, at, depth)
    parts = [raw[i : i + depth] for i in order]
    assert parts == sorted(parts) and sorted(order) == list(range(len(text)))
    assert [bool(x) for x in same] == [k > 0 and parts[k] == parts[k - 1] for k in range(len(parts))]


@pytest.mark.parametrize("v", [8, 32, 64])
def test_difference_cover(v):
    cover, shift = suffix_dedup.difference_cover(v)
    assert len(cover) <= 2 * v**0.5 + 2
    for a in range(v):
        for b in range(v):
            assert {(a + shift[a, b]) % v, (b + shift[a, b]) % v} <= set(cover.tolist())


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_near(own):
    own = sorted(own)
    sets = []
    for _, text, *_ in own:
        w = words((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    u = Union(len(own))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                u.join(i, j)
    return {(own[i][0], len(sets[i]), own[u.find(i)][0]) for i in range(len(own))}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    docs, own = unique(spark, seed)
    got = jaccard_join.near_duplicates(clashing(docs)).collect()
    assert {tuple(r) for r in got} == brute_near(own)


@pytest.mark.parametrize("limits", [(2, 4, 2), (1000, 6, 3)])
def test_near_duplicates_with_small_limits(spark, monkeypatch, limits):
    """Buckets and lists that are cut lose no link."""
    for name, value in zip(("BUCKET", "LIST", "SMALL"), limits, strict=True):
        monkeypatch.setattr(jaccard_join, name, value)
    docs, own = unique(spark)
    assert {tuple(r) for r in jaccard_join.near_duplicates(docs).collect()} == brute_near(own)


def test_parts_of_a_list_between_size_jumps(spark, monkeypatch):
    """A part whose sizes are far from all other parts' is joined by itself."""
    monkeypatch.setattr(jaccard_join, "LIST", 600)
    table = []
    for g, size in enumerate((40, 60, 90)):  # each group is one part; all share the shingles of their prefixes
        for k in range(300):
            node = 300 * g + k
            own = [*range(1, 31), *range(10_000 * (g + 1), 10_000 * (g + 1) + size - 32), 10**6 + 2 * node, 10**6 + 2 * node + 1]
            table.append((node, node, size, bytearray(np.array(own, np.uint64).tobytes())))
    reps = spark.createDataFrame(table, "node long, comp long, n long, tokens binary")
    u = Union(900)
    for r in jaccard_join._list_links(jaccard_join._open_lists(reps), reps).collect():
        u.join(r.a, r.b)
    assert [u.find(i) for i in range(900)] == [i // 300 * 300 for i in range(900)]


def test_near_duplicates_of_odd_rows(spark):
    got = jaccard_join.near_duplicates(documents(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())


@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=30), min_size=2, max_size=60))
@settings(max_examples=60, deadline=None)
def test_signature_trees_find_all_links(sets):
    arrays = [np.array(sorted(s), np.uint64) * wa.U(0x9E3779B97F4A7C15) for s in sets]
    arrays = [np.sort(a) for a in arrays]
    want, got = Union(len(sets)), Union(len(sets))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                want.join(i, j)
    links = jaccard_join.linked(arrays)
    for i, j in links:
        assert 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
        got.join(i, j)
    assert [want.find(i) for i in range(len(sets))] == [got.find(i) for i in range(len(sets))]


def test_components(spark):
    r = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (2000, 2001)]
    index = sorted({x for p in pairs for x in p if p[0] != p[1]})
    u = Union(2002)
    for a, b in pairs:
        u.join(a, b)
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: u.find(x) for x in index}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_key(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")


def brute_lines(own):
    first = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(i, k, line_key(x)) for i, text, *_ in first for k, x in enumerate((text or "").split("\n")) if line_key(x)]
    nodes = sorted({x for *_, x in lines})
    sets = [line_dedup.shingles(x) for x in nodes]
    u = Union(len(nodes))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if line_dedup.near(a, b):
                u.join(i, j)
    seen, gone = set(), Counter()
    for i, _, x in lines:
        c = u.find(nodes.index(x))
        gone[i] += c in seen
        seen.add(c)
    return gone


def test_lines(spark):
    docs, own = unique(spark)
    got = line_dedup.line_report(clashing(docs)).collect()
    want = brute_lines(own)
    assert {r.doc_id: r.n_removed for r in got} == {i: want[i] for i, *_ in own}
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    by_id = {r.doc_id: r for r in kept.collect()}
    report = {r.doc_id: r for r in got}
    for i, text, lang, source, n in own:
        r = by_id[i]
        assert (r.lang, r.source, r.n_chars) == (lang, source, n)
        assert sha((r.text or "").encode()) == report[i].kept_sha256
        assert (r.text is None) == (text is None)


def test_lines_with_small_buckets(spark, monkeypatch):
    """Keys that are cut into parts lose no link, also where lines hang together by single links."""
    monkeypatch.setattr(line_dedup, "BUCKET", 2)
    r = random.Random(1)
    chains = [["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(60)] for _ in range(5)]
    lines = [" ".join(c[k : k + 12]) for c in chains for k in range(49)]
    own = [(k, x, None, None, 0) for k, x in enumerate(r.sample(lines, 245))]
    want = brute_lines(own)
    assert sum(want.values()) == 5 * 48
    got = line_dedup.line_report(spark.createDataFrame(own, SCHEMA).repartition(2)).collect()
    assert sum(r.n_removed != want[r.doc_id] for r in got) == 0


def test_few_lines_of_hot_keys_go_to_few_groups(spark, monkeypatch):
    """A large group of near lines is in many lists; its texts are not copied for each of them."""
    monkeypatch.setattr(line_dedup, "BUCKET", 20)
    seen, dealt = [], line_dedup.jaccard_join.dealt
    monkeypatch.setattr(line_dedup.jaccard_join, "dealt", lambda lists, groups: seen.append(groups) or dealt(lists, groups))
    r = random.Random(4)
    stem = "".join(r.choice("abcdefghij ") for _ in range(120))
    own = [(k, stem[: 2 * k] + "#%02d" % k + stem[2 * k + 3 :], None, None, 0) for k in range(50)]
    got = line_dedup.line_report(spark.createDataFrame(own, SCHEMA).repartition(2)).collect()
    assert sum(x.n_removed for x in got) == sum(brute_lines(own).values()) == 49
    assert len(seen) == 2 and seen[1] == 8


def test_copies_of_lines_name_no_keys(spark, monkeypatch):
    """Of equal lines one asks for its keys, and it has only those that other lines share."""
    held, cut = {}, line_dedup.cut

    def keep(df, name):
        held[name] = cut(df, name)
        return held[name]

    monkeypatch.setattr(line_dedup, "cut", keep)
    monkeypatch.setattr(line_dedup, "discard", lambda *tables: None)
    r = random.Random(7)
    alone = ["".join(r.choice("abcdefghij") for _ in range(80)) for _ in range(20)]
    near = alone[0][:40] + "#" + alone[0][41:]
    texts = ["\n".join(alone[k : k + 3]) for k in range(0, 18)] * 3 + [near, near + "\n" + near]
    own = [(k, x, None, None, 0) for k, x in enumerate(texts)] + [(0, texts[0], None, None, 0)]
    got = line_dedup.line_report(spark.createDataFrame(own, SCHEMA).repartition(4)).collect()
    want = brute_lines(own[:-1])
    assert {x.doc_id: x.n_removed for x in got} == {i: want[i] for i, *_ in own}
    named = {x.text for x in held["lines"].where("text is not null").collect()}
    assert {alone[0], near} <= named and len(named) <= 4  # the lines of the row that repeats ask twice


def test_lines_of_39_characters_bear_a_typo():
    line = "the quick brown fox jumps over lazy dog"
    typo = line[:19] + "#" + line[20:]
    five = [{x[i : i + 5] for i in range(35)} for x in (line, typo)]
    assert len(line) == 39 and 100 * len(five[0] & five[1]) >= 75 * len(five[0] | five[1])
    assert line_dedup.near(line_dedup.shingles(line), line_dedup.shingles(typo))
    assert line_dedup.Shingled({0: line, 1: typo}).near(0, 1)


def test_unrelated_lines_seldom_meet():
    """Lines of one vocabulary share keys by chance, more pairs the more lines there are; near lines still meet."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(40)]
    lines = [" ".join(r.choice(vocabulary) for _ in range(24)) for _ in range(2000)]
    lines += [x[:60] + "#" + x[61:] for x in lines[:40]]
    keys, checks = line_dedup.Lines(lines).bands()
    order = np.argsort(keys, axis=None, kind="stable")
    key, own = keys.ravel()[order], order // line_dedup.BANDS
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    shared = np.repeat(np.diff(np.append(new, len(key))) > 1, np.diff(np.append(new, len(key))))
    met = line_dedup._met(new, checks.ravel()[order], np.zeros(len(key), bool))
    assert {*own[met].tolist()} >= {*range(40), *range(2000, 2040)}
    assert 3 * len({*own[met].tolist()}) < len({*own[shared].tolist()})


def test_packed_shingles_compare_as_sets():
    r = random.Random(2)
    for letters in ("ab", "abcdeéß", "ab日😀", "abcdefghijklmnop"):
        for _ in range(60):
            x = "".join(r.choice(letters) for _ in range(r.randint(1, 60)))
            k = r.randint(0, len(x))
            y = x[:k] + r.choice(letters) + x[k + 1 :]
            assert line_dedup.near_lines(x, y) == line_dedup.near(line_dedup.shingles(x), line_dedup.shingles(y))


def test_lines_are_packed_once_and_for_all_their_pairs(monkeypatch):
    """Pairs are decided by sets made beforehand; only lines with characters above 12 bits are packed again."""
    r, again, plain = random.Random(4), [], line_dedup.near_lines
    monkeypatch.setattr(line_dedup, "near_lines", lambda a, b: again.append(a + b) or plain(a, b))
    lines = {"a", "ab", "abc", "日", "b日"}
    for letters in ("ab", "abcdeéß", "abжд", "ab日"):
        for _ in range(12):
            x = "".join(r.choice(letters) for _ in range(r.randint(1, 40)))
            lines |= {x, x + x[:2], x[1:] or x, x[: len(x) // 2] + "#" + x[len(x) // 2 + 1 :], "日" + x}
    lines = sorted(lines)
    sets = line_dedup.Shingled(dict(enumerate(lines)))
    for j, y in enumerate(lines):
        for i, x in enumerate(lines[:j]):
            assert sets.near(i, j) == line_dedup.near(line_dedup.shingles(x), line_dedup.shingles(y)), (x, y)
    assert again and all("日" in x for x in again)


def test_white_space_of_lines():
    r, space = random.Random(6), " \t\x0b\x0c\r"
    for letters in ("aB", "aÀ\xa0\x85", "İΣ日\x1c"):
        for _ in range(40):
            texts = [r.choice([None, "", "".join(r.choice(letters + space + "\n") for _ in range(r.randint(1, 40)))]) for _ in range(4)]
            want = []
            for t, text in enumerate(texts):
                for n, line in enumerate((text or "").lower().split("\n")):
                    if tidy := re.sub(f"[{space}]+", " ", line).strip(" "):
                        want.append((t, n, tidy))
            lines = line_dedup.Lines(texts)
            got = zip(lines.text.tolist(), lines.number.tolist(), [lines.string(i) for i in range(len(lines.text))], strict=True)
            assert list(got) == want


def test_empty_bins_copy_the_next_filled_one():
    r = np.random.default_rng(3)
    for share in (0, 0.1, 0.9, 0.99, 1):
        low = r.integers(0, 1 << 32, (40, line_dedup.BINS), dtype=np.uint32)
        low[r.random(low.shape) < share] = line_dedup._NONE
        want = [[next((x for x in [*row[k:], *row[:k]] if x != line_dedup._NONE), line_dedup._NONE) for k in range(len(row))] for row in low.tolist()]
        assert line_dedup._filled(low.copy()).tolist() == want


def test_lines_of_odd_rows(spark):
    got = line_dedup.line_report(documents(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())


def test_empty_tables(spark):
    none = empty(spark)
    assert window_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert line_dedup.line_report(none).count() == 0
    assert line_dedup.dedup_lines(none).columns == none.columns


def test_shuffled_payloads(spark, monkeypatch):
    """The same results when nothing is broadcast."""
    from siltbed.llm import exact_dedup, exchange, shared

    for module in (exchange, line_dedup):
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    for module in (shared, exact_dedup, jaccard_join):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    docs, own = unique(spark)
    got = line_dedup.line_report(docs).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: brute_lines(own)[i] for i, *_ in own}
    assert {tuple(r) for r in jaccard_join.near_duplicates(docs).collect()} == brute_near(own)
