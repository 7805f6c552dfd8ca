"""Language ID, SentencePiece and JPEG."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import jpeg, langid, queries, sentencepiece_fst

from .fixture import clashing, documents, empty, rows, texts

SMALL = "/root/testdata/sf0.001"


def test_language_id_on_held_out_documents(spark):
    got = queries.op3_language_id(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(labels, "doc_id")
    right, n = held.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 30 and right / n > 0.95
    assert got.where("score < 0 or score > 1").count() == 0
    want = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got.collect()}
    assert {r.doc_id: r.held_out for r in got.collect()} == want


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    a, b = (langid.learn(d, ~held) for d in (docs, other))
    assert a.langs == b.langs and (a.slices == b.slices).all()


def test_language_id_of_odd_rows(spark):
    docs = clashing(documents(spark))
    filters = langid.learn(docs, F.lit(True))
    got = langid.identify(docs, filters).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())
    lone = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? 34"), (4, "é"), (5, "ab")], "doc_id long, text string")
    named = {r.doc_id: r for r in langid.identify(lone, filters).collect()}
    assert [named[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and named[1].score == 0
    assert named[4].lang_pred in filters.langs and named[5].lang_pred in filters.langs
    nothing = langid.learn(docs, F.lit(False))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty(spark), filters).count() == 0


def plain_language(train, texts, min_share=langid.MIN_SHARE):
    """N-gram sets by language without filters: the share of a text's n-grams that a language knows."""

    def grams(t):
        s = " " + "".join(c if c.isalpha() else " " for c in (t or "").lower()) + " "
        s = re.sub(" +", " ", s)
        return [s[i : i + langid.N] for i in range(len(s) - langid.N + 1)]

    known, n = {}, Counter(lang for lang, _ in train)
    for lang in n:
        held = Counter(g for x, t in train if x == lang for g in set(grams(t)))
        known[lang] = {g for g, c in held.items() if c >= max(2 if n[lang] > 1 else 1, min_share * n[lang])}
    order = sorted(n, key=lambda x: (-n[x], x))
    out = []
    for t in texts:
        if not any(c.isalpha() for c in t or ""):
            out.append({"und": 0.0})
            continue
        g = grams(t)
        out.append({lang: sum(x in known[lang] for x in g) / max(1, len(g)) for lang in order})
    return out


def test_filters_against_plain_sets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    filters = langid.learn(docs, F.lit(True))
    own = docs.collect()
    want = plain_language([(r.lang, r.text) for r in own if r.lang and r.text is not None], [r.text for r in own])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, filters).collect()}
    for r, shares in zip(own, want, strict=True):
        lang, score = got[r.doc_id]
        assert shares[lang] >= max(shares.values()) - 0.01 and abs(score - shares[lang]) < 0.01


def test_more_than_64_languages_are_learned(spark):
    r = random.Random(4)
    letters = [chr(0x4E00 + 40 * k + j) for k in range(100) for j in range(40)]
    made = lambda k: " ".join("".join(r.choice(letters[40 * k : 40 * k + 40]) for _ in range(3)) for _ in range(400))
    docs = spark.createDataFrame([(3 * k + j, made(k), f"l{k:03d}") for k in range(100) for j in range(3)], "doc_id long, text string, lang string")
    filters = langid.learn(docs, F.lit(True))
    assert len(filters.langs) == 100 and len(filters.slices) == 13
    wrong = langid.identify(docs, filters, keep=[docs["lang"]]).where("lang <> lang_pred").count()
    assert wrong == 0


def test_rows_of_one_id_are_learned_under_their_own_labels(spark):
    rows = [(1, "aaaa aaaa", "x"), (1, "bbbb bbbb", "y"), (1, "cccc cccc", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs, langid.learn(docs, F.lit(True)), keep=[docs["text"]]).collect()
    best = {r.text[0]: (r.lang_pred, r.score) for r in got}
    assert best["a"][0] == "x" and best["b"][0] == "y" and best["a"][1] == best["b"][1] == 1.0 and best["c"][1] == 0.0


def test_filters_return_all_languages_and_correct_for_chance():
    r = np.random.default_rng(1)
    bits, size = 19, 1 << langid.POSITION_BITS
    slices = np.zeros((3, size), np.uint8)
    filters = langid.Filters([f"l{k}" for k in range(bits)], slices)
    h = {k: r.integers(0, 1 << 63, 3000, dtype=np.int64).astype(np.uint64) for k in range(bits)}
    for k, x in h.items():
        for j in range(langid.HASHES):
            np.bitwise_or.at(slices[k // 8], langid.positions(x, j), np.uint8(1 << k % 8))
    counts = filters.counts(np.concatenate([h[3], h[17]]), np.repeat([0, 1], 3000), 2)
    assert counts[0, 3] == 3000 and counts[1, 17] == 3000
    assert counts.sum() - 6000 < 60
    assert (filters.chance() < 1e-3).all()


pieces = pytest.mark.skipif(not os.path.exists(sentencepiece_fst.DEFAULT_MODEL), reason="no model file")


@pieces
def test_bpe_ids_equal_the_library(spark):
    import sentencepiece

    own = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.DEFAULT_MODEL)
    r = random.Random(4)
    made = ["".join(r.choice(" aetinsthr.,'\"()=_-0123日あéß😀\n\t▁") for _ in range(r.randint(1, 80))) for _ in range(1500)]
    for t in made + [x for x in texts() if x] + ["e" * 300, "=" * 200, " " * 70 + "x", "▁▁ ▁a", "\x00"]:
        assert own.encode(t).tolist() == library.encode(t), t[:80]
        if "▁" not in t:
            assert own.decode(own.encode(t)) == t


def _unigram(pieces, fallback=True):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, fallback
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.escape_whitespaces = True, True
    m.normalizer_spec.remove_extra_whitespaces = False
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256) if fallback]:
        m.pieces.add(piece=piece, score=score, type=kind)
    for piece, score in pieces.items():
        m.pieces.add(piece=piece, score=score, type=1)
    return m.SerializeToString()


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_ids_equal_the_library(fallback):
    import sentencepiece

    r = random.Random(2)
    table = {c: -9.0 - r.random() for c in "▁abcde"}
    table |= {"".join(r.choice("abcde") for _ in range(r.randint(2, 4))): -3 - 5 * r.random() for _ in range(60)}
    table |= {"▁" + "".join(r.choice("abcde") for _ in range(r.randint(1, 3))): -3 - 5 * r.random() for _ in range(20)}
    model = _unigram(table, fallback)
    own, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for _ in range(400):
        t = "".join(r.choice("abcde  é") for _ in range(r.randint(1, 30)))
        assert own.encode(t).tolist() == library.encode(t), t


def _changed(change):
    """The default model with another normaliser or more pieces."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(sentencepiece_fst.read_model())
    change(m)
    return m.SerializeToString()


def _charsmap(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    return m.normalizer_spec.precompiled_charsmap


ODD = ["ｶﾞｷﾞ①ﬁ ＡＢＣ", "a\u3000b\tc\nd", "  two  spaces  ", "é e\u0301 \u00a8x", "½ ㌀ ™", "\u200b\ufeffx", "", " ", "tab\t", "한글 각", "<x><y> <x>a<yy>", "a<x>", "no. <y>"]


@pieces
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_character_maps_equal_the_library(rule, squeeze):
    import sentencepiece

    def change(m):
        m.normalizer_spec.precompiled_charsmap = _charsmap(rule)
        m.normalizer_spec.remove_extra_whitespaces = squeeze

    model = _changed(change)
    own, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ODD + [t for t in texts()[:70] if t]:
        assert own.encode(t).tolist() == library.encode(t), t
        assert own.decode(own.encode(t)) == library.decode(library.encode(t)), t


@pieces
@pytest.mark.parametrize("rule", [None, "nmt_nfkc"])
def test_user_defined_pieces_equal_the_library(rule):
    import sentencepiece

    def change(m):
        known = {p.piece for p in m.pieces}
        for p in ("<x>", "<y>", "<yy>", "singi", "éé"):
            assert p not in known
            m.pieces.add(piece=p, score=0, type=4)
        if rule:
            m.normalizer_spec.precompiled_charsmap = _charsmap(rule)

    model = _changed(change)
    own, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ODD + ["singing kingéé", "ing ing"] + [t for t in texts()[:40] if t]:
        assert own.encode(t).tolist() == library.encode(t), t


@pieces
def test_white_space_suffixes_equal_the_library():
    import sentencepiece

    model = _changed(lambda m: setattr(m.trainer_spec, "treat_whitespace_as_suffix", True))
    own, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ODD + [t for t in texts()[:30] if t and len(t) < 2000]:
        assert own.encode(t).tolist() == library.encode(t), t


def test_unigram_models_with_user_defined_pieces():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    r = random.Random(6)
    table = {c: -9.0 - r.random() for c in "▁abcde"} | {"".join(r.choice("abcde") for _ in range(r.randint(2, 4))): -3 - 5 * r.random() for _ in range(60)}
    m = pb.ModelProto()
    m.ParseFromString(_unigram(table))
    for p in ("xyz", "abc"):
        if p not in table:
            m.pieces.add(piece=p, score=0, type=4)
    model = m.SerializeToString()
    own, library = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for _ in range(300):
        t = "".join(r.choice(["a", "b", "c", "d", "e", " ", "abc", "xyz", "x"]) for _ in range(r.randint(1, 20)))
        got, want = own.encode(t).tolist(), library.encode(t)
        if got != want:  # paths of one weight, in another order
            assert sorted(got) == sorted(want) and own.decode(got) == library.decode(want), t


def plain_shortest_path(t, s):
    """All arcs of the lattice, relaxed position by position with both weights summed."""
    states = {(0, None): (0.0, [])}
    for a in range(len(s)):
        for (at, before), (d, path) in list(states.items()):
            if at != a:
                continue
            for b in range(a + 1, len(s) + 1):
                i = t.ids.get(s[a:b])
                if i is None or (len(s[a:b]) > 1 and t.splits and t.splits[i] is None):
                    continue
                w = t.weight[i] + (0.0 if before is None or t.kind != sentencepiece_fst.BPE or t._fits(before * len(t.pieces) + i) else float("inf"))
                if d + w < states.get((b, i), (float("inf"),))[0]:
                    states[b, i] = (d + w, [*path, i])
    return min((v for (at, _), v in states.items() if at == len(s)), default=(float("inf"), None))[1]


@pieces
def test_paths_are_the_shortest():
    t = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    for word in ["▁interesting", "▁unbelievable", "▁dans", "èelleê", "▁naïveté", "aaaaaaa", "▁▁▁▁x", "tokenization"]:
        assert np.frombuffer(t._path(word), np.int32).tolist() == plain_shortest_path(t, word), word
    want = t._path("tokenization")
    t.weight = [float("inf")] * len(t.weight)
    assert t._path("tokenization") != want


@pieces
def test_small_memos_change_nothing(monkeypatch):
    monkeypatch.setattr(sentencepiece_fst, "MAX_SEGMENTS", 3)
    monkeypatch.setattr(sentencepiece_fst, "MAX_PAIRS", 2)
    small = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    monkeypatch.undo()
    large = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    for t in texts()[:60]:
        assert small.encode(t).tolist() == large.encode(t).tolist()


@pieces
def test_encoding_odd_rows(spark):
    got = sentencepiece_fst.encode_documents(clashing(documents(spark)), sentencepiece_fst.read_model()).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert sentencepiece_fst.encode_documents(empty(spark), sentencepiece_fst.read_model()).count() == 0


# -- JPEG: a scalar decoder, bit by bit


class Bits:
    def __init__(self, data):
        self.data, self.at = data, 0

    def bit(self):
        b = self.data[self.at >> 3] >> (7 - (self.at & 7)) & 1
        self.at += 1
        return b

    def bits(self, n):
        v = 0
        for _ in range(n):
            v = v << 1 | self.bit()
        return v

    def symbol(self, table):
        code, n = 0, 0
        while True:
            code, n = code << 1 | self.bit(), n + 1
            if (code, n) in table:
                return table[code, n]


def scalar_thumbnail(data):
    f = jpeg.parse(data)
    tables = [[{v: s for s, v in jpeg._codes(*c[k]).items()} for k in (4, 5)] for c in f.components]
    raw = data[f.scan[0] : f.scan[1]]
    parts, cur, i = [], bytearray(), 0
    while i < len(raw):
        if raw[i] == 255 and raw[i + 1] != 0:
            parts.append(bytes(cur))
            cur = bytearray()
            i += 2
        else:
            cur.append(raw[i])
            i += 2 if raw[i] == 255 else 1
    parts.append(bytes(cur))
    single = len(f.components) == 1
    hmax, vmax = max(c[1] for c in f.components), max(c[2] for c in f.components)
    across, down = f.grid if single else (-(-f.width // (8 * hmax)), -(-f.height // (8 * vmax)))
    h, v = (1, 1) if single else f.components[0][1:3]
    grid, m = np.zeros((down * v, across * h), int), 0
    for part in parts:
        b, pred = Bits(part + b"\0\0\0\0"), [0] * len(f.components)
        for _ in range(min(f.interval or 10**9, across * down - m)):
            for c, comp in enumerate(f.components):
                for t in range(1 if single else comp[1] * comp[2]):
                    s = b.symbol(tables[c][0])
                    x = b.bits(s)
                    pred[c] += x if not s or x >> (s - 1) else x - (1 << s) + 1
                    if c == 0:
                        grid[m // across * v + t // h, m % across * h + t % h] = pred[0]
                    k = 1
                    while k < 64:
                        rs = b.symbol(tables[c][1])
                        if not rs:
                            break
                        k += (rs >> 4) + 1
                        b.bits(rs & 15)
            m += 1
    grid = grid[: f.shape[1], : f.shape[0]]
    return np.clip((grid * f.components[0][3] + 4) // 8 + 128, 0, 255).astype(np.uint8)


def made_jpeg(r, comps, width, height, interval, apart=False):
    """A JPEG with random coefficients, written symbol by symbol; ``apart``: each component in a scan of its own, the first last."""
    dc, ac = jpeg._huffman_spec({k: 5 for k in range(12)}), jpeg._huffman_spec({0: 2, 0xF0: 9} | {run << 4 | s: 8 for run in range(4) for s in range(1, 9)})
    codes = jpeg._codes(*dc), jpeg._codes(*ac)
    seg = lambda m, body: bytes([255, m]) + (len(body) + 2).to_bytes(2, "big") + body
    out = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, bytes([0, 16]) + bytes([3]) * 63)
    out += seg(0xC0, bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(comps)]) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(comps)))
    out += seg(0xC4, b"\x00" + dc[0] + dc[1] + b"\x10" + ac[0] + ac[1])
    out += seg(0xDD, interval.to_bytes(2, "big")) if interval else b""
    hm, vm = max(h for h, _ in comps), max(v for _, v in comps)
    bits, body, restarts = "", b"", 0

    def put(kind, symbol, extra=0, n=0):
        nonlocal bits
        code, length = codes[kind][symbol]
        bits += f"{code:0{length}b}" + (f"{extra:0{n}b}" if n else "")

    def flush():
        nonlocal bits, body
        bits += "1" * (-len(bits) % 8)
        raw = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))
        body += raw.replace(b"\xff", b"\xff\0")
        bits = ""

    for scan in [[k] for k in reversed(range(len(comps)))] if apart else [list(range(len(comps)))]:
        out += seg(0xDA, bytes([len(scan)]) + b"".join(bytes([k + 1, 0]) for k in scan) + bytes([0, 63, 0]))
        single, body, restarts = len(scan) == 1, b"", 0
        h, v = comps[scan[0]]
        wide, high = (-(-width * h // hm), -(-height * v // vm)) if single else (width, height)
        mcus = -(-wide // (8 if single else 8 * hm)) * -(-high // (8 if single else 8 * vm))
        for m in range(mcus):
            if interval and m and m % interval == 0:
                flush()
                body += bytes([255, 0xD0 + restarts % 8])
                restarts += 1
            for h, v in [comps[k] for k in scan]:
                for _ in range(1 if single else h * v):
                    s = r.randint(0, 5)
                    put(0, s, r.getrandbits(s) if s else 0, s)
                    k = 1
                    while k < 64 and r.random() < 0.7:
                        run, s = r.randint(0, 3), r.randint(1, 8)
                        if k + run >= 64:
                            break
                        put(1, run << 4 | s, r.getrandbits(s), s)
                        k += run + 1
                    if k < 64:
                        put(1, 0)
        flush()
        out += body
    return out + b"\xff\xd9"


@pytest.mark.parametrize("comps", [[(1, 1), (1, 1), (1, 1)], [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 2)]])
def test_components_in_scans_of_their_own(comps):
    r = random.Random(9)
    images = [made_jpeg(r, comps, w, h, interval, apart=True) for w, h in ((8, 8), (50, 33), (17, 90)) for interval in (0, 3)]
    frames = [jpeg.parse(x) for x in images]
    assert all(f.end == len(x) for f, x in zip(frames, images, strict=True))
    for x, thumb in zip(images, jpeg.dc_thumbnails(list(zip(images, frames, strict=True))), strict=True):
        assert np.array_equal(thumb, scalar_thumbnail(x))


def test_every_image_is_parsed(monkeypatch):
    def refuse(data, at=0):
        raise ValueError("parsed")

    monkeypatch.setattr(jpeg, "parse", refuse)
    with pytest.raises(ValueError, match="parsed"):
        jpeg._described(["a text"])


@pytest.mark.parametrize("comps", [[(1, 1)], [(1, 1), (1, 1), (1, 1)], [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]])
@pytest.mark.parametrize("interval", [0, 3])
def test_thumbnails_of_any_baseline_jpeg(comps, interval):
    r = random.Random(7)
    images = [made_jpeg(r, comps, w, h, interval) for w, h in ((8, 8), (50, 33), (17, 90))]
    got = jpeg.dc_thumbnails([(x, jpeg.parse(x)) for x in images])
    for x, thumb in zip(images, got, strict=True):
        assert np.array_equal(thumb, scalar_thumbnail(x))


def test_bad_streams_are_refused():
    good = jpeg.encode_samples([b"x" * 192])[0]
    for bad in (b"", b"\xff\xd8", good[:-2], good[:40], b"GIF89a" + good, good[: jpeg.parse(good).scan[0] + 3] + b"\xff\xd9"):
        with pytest.raises(ValueError):
            jpeg.dc_thumbnails([(bad, jpeg.parse(bad))])


def test_media_round_trip(spark):
    docs = clashing(documents(spark))
    got = jpeg.media_table(docs, with_media=True).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows())
    by_text = {}
    for i, t, *_ in rows():
        raw = (t or "").encode()
        size = max(192, -(-len(raw) // 192) * 192)
        by_text.setdefault(i, []).append((len(raw), hashlib.sha256(raw.ljust(size)).hexdigest(), zlib.crc32(raw.ljust(size)[-16:])))
    for r in got:
        assert (r.n_bytes, r.payload_sha256, r.tail_crc32) in by_text[r.doc_id]
        media = bytes(r.media)
        assert (len(media), hashlib.sha256(media).hexdigest()) == (r.media_bytes, r.media_sha256)
        thumbs = jpeg.dc_thumbnails([(media, f) for f in jpeg.frames(media)])
        assert b"".join(t.tobytes() for t in thumbs).rstrip(b" ") == media_text(r, by_text)
    assert jpeg.media_table(empty(spark)).count() == 0


def media_text(r, by_text):
    for i, t, *_ in rows():
        if i == r.doc_id and len((t or "").encode()) == r.n_bytes and hashlib.sha256((t or "").encode().ljust(r.payload_bytes)).hexdigest() == r.payload_sha256:
            return (t or "").encode().rstrip(b" ")
    raise AssertionError(r.doc_id)


def test_long_payloads_take_several_images(monkeypatch):
    monkeypatch.setattr(jpeg, "MAX_ROWS", 3)
    text = "".join(chr(33 + k % 90) for k in range(192 * 7 + 5))
    ((n, size, sha, *_),) = jpeg._described([text])
    assert (n, size) == (len(text), 192 * 8)
    assert sha == hashlib.sha256(text.encode().ljust(192 * 8)).hexdigest()
    ((*_, media),) = jpeg._described([text], with_media=True)
    assert len(jpeg.frames(media)) == 3 and np.array_equal(scalar_thumbnail(media), np.frombuffer(text[:576].encode(), np.uint8).reshape(3, 192))
