"""SentencePiece encoding and decoding by weighted finite-state transduction.

A model file is compiled into machines:

* the normaliser, a transducer over characters: arcs of the model's character
  map (the longest that matches), user-defined pieces (which pass as they are),
  runs of spaces, the mark for a space, the dummy prefix or suffix;
* the pieces, an Aho-Corasick machine (a trie with failure arcs) whose states
  emit the ids of the pieces that end there;
* byte fallback, which emits the UTF-8 bytes of a character that no piece holds.

Their composition with an input is built as it is walked: a lattice over the
input's positions.  The encoding is its shortest path in the tropical semiring:
weights add along a path, and each position keeps the least sum.

Weights.  In unigram models an arc weighs minus its piece's score.  In BPE models
pieces weigh nothing, and a pair of consecutive pieces weighs 0 or infinity:
infinity if merging would not leave the two apart.  A piece sequence is what the
merges give exactly if each adjacent pair is, so exactly one path to each position
has finite weight.  A pair is judged from the machine of merges alone: undo the
later merge on either side of the border, step by step, and see whether a merge
across the border would have come first.

Characters that never meet inside a piece cannot be joined, so inputs fall into
independent segments; segments and pairs are memoised in bounded tables.  BPE
models with unused pieces, and models that are neither unigram nor BPE, are
refused with ``ValueError``.  Of unigram paths of one weight, the library, which
adds in single precision, may take another.

Cases: null and empty texts encode to no ids.  Any other text is kept whole,
whatever its length, and decodes to itself if the model's normaliser is the
identity; unpaired surrogates cannot occur in a Spark string.  Repeated rows
give equal rows.  An empty table gives an empty result.  Only the id and text
columns are read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import KEPT, bounded_batches, lean

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
INF = float("inf")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bounds of the memo tables, in entries.
MAX_SEGMENTS, MAX_PAIRS = 150_000, 250_000
#: Longer segments are encoded without being remembered.
MEMO_CHARS = 48


class _Memo(dict):
    """A bounded memo of two generations: when the young one is full it becomes the old one, whose entries
    come back when they are used again."""

    def __init__(self, make, limit: int, keep=lambda key: True):
        super().__init__()
        self.make, self.limit, self.keep, self.old = make, limit, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if not self.keep(key):
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class CharacterMap:
    """A model's compiled character map: a double-array trie over UTF-8 bytes whose final states point at replacements.

    Fixed format: the trie's size in bytes, its units of 32 bits, then the replacements, each closed by a zero byte.
    A unit holds a label (8 bits and bit 31), whether a final state follows (bit 8), and an offset (from bit 10, times
    256 if bit 9 is set).
    """

    def __init__(self, packed: bytes):
        size = int.from_bytes(packed[:4], "little")
        self.units = np.frombuffer(packed, "<u4", size // 4, 4).tolist()
        self.texts = packed[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[int, str]:
        """(bytes read, replacement) of the longest key that starts at ``at``; 0 bytes if there is none."""
        units = self.units
        node = self._offset(units[0])
        found, size = -1, 0
        for k in range(at, len(raw)):
            node ^= raw[k]
            unit = units[node]
            if unit & 0x800000FF != raw[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found, size = units[node] & 0x7FFFFFFF, k + 1 - at
        if found < 0:
            return 0, ""
        return size, self.texts[found : self.texts.index(b"\0", found)].decode()


class Transducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are compiled")
        if trainer.model_type == BPE and any(p.type == UNUSED for p in proto.pieces):
            raise ValueError("BPE models with unused pieces are not compiled")
        self.kind = trainer.model_type
        self.prefix, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.suffix = trainer.treat_whitespace_as_suffix
        self.user = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == USER}
        longest = sorted(self.user, key=len, reverse=True)
        self.user_pieces = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.map = CharacterMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.fallback, self.unk_surface = trainer.byte_fallback, trainer.unk_surface
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unk = next(i for i, t in enumerate(self.types) if t == UNKNOWN)
        least = min((s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL), default=0.0)
        self.unk_weight = 10.0 - least
        if self.kind == UNIGRAM:
            # User-defined pieces are pieces of a score that beats any others.
            best = max((s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL), default=0.0)
            for piece, i in self.user.items():
                self.scores[i] = len(piece.encode()) * best - 0.1
            self.ids |= self.user

        self.splits = [self._split(i) for i in range(len(self.pieces))] if self.kind == BPE else []
        self.joined: set[str] = set()
        self.machine = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.kind == BPE and len(piece) > 1 and self.splits[i] is None:
                continue  # no merges give it
            self.machine.add_word(piece, i)
            self.joined.update(a + b for a, b in zip(piece, piece[1:], strict=False))
        self.machine.make_automaton()
        self.single = {p for p in self.ids if len(p) == 1}
        self.length = [len(p) for p in self.pieces]
        self.weight = [0.0 if self.kind == BPE else -x for x in self.scores]
        known = {c for p in self.ids for c in p}
        # Marks start a segment if no piece continues from another character into one.
        self.cuts = not any(b == MARK and a != MARK for a, b in self.joined)
        inner = "".join(re.escape(c) for c in sorted(known - {MARK}))
        if self.cuts and inner:
            self.segment = re.compile(f"{MARK}*[{inner}]+|{MARK}+|[^{inner}{MARK}]")
        else:
            self.segment = re.compile(f"[{inner}{MARK}]+|[^{inner}{MARK}]")
        self.fits = _Memo(self._fits, MAX_PAIRS)
        self.parts = _Memo(self._path, MAX_SEGMENTS, lambda s: len(s) <= MEMO_CHARS)
        self.segments = _Memo(self._segment, MAX_SEGMENTS, lambda s: len(s) <= MEMO_CHARS)
        surfaces = []
        for i, (piece, t) in enumerate(zip(self.pieces, self.types, strict=True)):
            if t == BYTE:
                surfaces.append(bytes([int(piece[3:5], 16)]))
            elif t == CONTROL:
                surfaces.append(b"")
            elif t == UNKNOWN:
                surfaces.append((self.unk_surface if i == self.unk else piece).encode())
            else:
                surfaces.append(piece.replace(MARK, " ").encode())
        self.surfaces = surfaces

    def normalise(self, text: str) -> str:
        """The output of the normaliser.  Without a map and user-defined pieces, only runs of spaces change."""
        if self.map is None and self.user_pieces is None:
            if self.squeeze:
                text = re.sub(" +", " ", text.strip(" "))
        else:
            text = self._mapped(text)
        if not text:
            return ""
        if self.prefix:
            text = text + " " if self.suffix else " " + text
        return text.replace(" ", MARK) if self.escape else text

    def _mapped(self, text: str) -> str:
        """The walk over arcs of user-defined pieces and of the map; spaces after a space are dropped if asked."""
        raw, at, out, spaced = text.encode(), 0, [], self.squeeze
        user = {p.encode() for p in self.user}
        widths = sorted({len(p) for p in user}, reverse=True)
        while at < len(raw):
            got = next((raw[at : at + w] for w in widths if raw[at : at + w] in user), None)
            if got is not None:
                size, piece = len(got), got.decode()
            else:
                size, piece = self.map.longest(raw, at) if self.map else (0, "")
                if not size:
                    size = 1 + sum(raw[at] >= limit for limit in (0xC0, 0xE0, 0xF0))
                    piece = raw[at : at + size].decode()
            at += size
            if spaced:
                piece = piece.lstrip(" ")
            if piece:
                out.append(piece)
                spaced = self.squeeze and piece.endswith(" ")
        whole = "".join(out)
        return whole.rstrip(" ") if self.squeeze else whole

    # -- BPE pairs

    def _split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces that the merges join last to give ``piece``; None if they never give it or it is a character."""
        parts = list(self.pieces[piece])
        if len(parts) == 1 or self.types[piece] != NORMAL:
            return None
        while len(parts) > 2:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if parts[0] not in self.ids or parts[1] not in self.ids:
            return None
        return self.ids[parts[0]], self.ids[parts[1]]

    def _fits(self, pair: int) -> bool:
        """Whether the merges leave the two pieces apart.

        Along the border, the right edges of the left piece and the left edges of
        the right one appear in the order of their merges.  A merge of two edges
        that coexist would come first if its score beats the merge that ends
        either edge; the left of equal scores goes first.
        """
        a, b = divmod(pair, len(self.pieces))
        score, pieces, ids, splits = self.scores, self.pieces, self.ids, self.splits
        # Edges from the innermost character outwards, each with the score of the merge that replaces it.
        left, right = [], []
        end, p = -INF, a
        while True:
            left.append((p, end))
            s = splits[p]
            if s is None:
                break
            end, p = score[p], s[1]
        end, p = -INF, b
        while True:
            right.append((p, end))
            s = splits[p]
            if s is None:
                break
            end, p = score[p], s[0]
        i, j = len(left) - 1, len(right) - 1
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            m = ids.get(pieces[x] + pieces[y])
            if m is not None:
                s = score[m]
                # The merge ending x lies to the left of the border, so it goes first among equals.
                if s > x_end and s >= y_end:
                    return False
            if i == 0 and j == 0:
                return True
            if j == 0 or (i > 0 and x_end >= y_end):
                i -= 1
            else:
                j -= 1

    # -- shortest paths

    def _outside(self, c: str) -> list[int]:
        if self.fallback and len(self.bytes) == 256:
            return [self.bytes[b] for b in c.encode()]
        return [self.unk]

    def _path(self, s: str) -> bytes:
        """The ids of one part on the shortest path of its lattice, as int32 bytes."""
        n = len(s)
        if n == 1 and s not in self.single:
            return array("i", self._outside(s)).tobytes()
        # Per position: the least weight, and the piece that ends there on its path (-1: a character outside the pieces).
        dist, last = [INF] * (n + 1), [-1] * (n + 1)
        dist[0] = 0.0
        length, weight, fits, bpe, size = self.length, self.weight, self.fits, self.kind == BPE, len(self.pieces)
        if self.single.issuperset(s):
            for end, i in self.machine.iter(s):
                a = end + 1 - length[i]
                d = dist[a] + weight[i]
                if d < dist[end + 1] and (not bpe or not a or fits[last[a] * size + i]):
                    dist[end + 1], last[end + 1] = d, i
        else:
            arcs: list[list[int]] = [[] for _ in range(n)]
            for end, i in self.machine.iter(s):
                arcs[end].append(i)
            for end in range(n):
                for i in arcs[end]:
                    a = end + 1 - length[i]
                    d = dist[a] + weight[i]
                    if d < dist[end + 1] and (not bpe or last[a] < 0 or fits[last[a] * size + i]):
                        dist[end + 1], last[end + 1] = d, i
                if s[end] not in self.single and dist[end] + self.unk_weight < dist[end + 1]:
                    dist[end + 1], last[end + 1] = dist[end] + self.unk_weight, -1
        out, b = [], n
        while b:
            i = last[b]
            if i >= 0:
                out.append(i)
                b -= length[i]
            else:
                out += reversed(self._outside(s[b - 1]))
                b -= 1
        out.reverse()
        return array("i", out).tobytes()

    def _segment(self, s: str) -> bytes:
        if self.kind == UNIGRAM and not self.cuts:
            return self._path(s)
        joined = self.joined
        cut = [k for k in range(1, len(s)) if s[k - 1 : k + 1] not in joined]
        if not cut:
            return self.parts[s]
        return b"".join([self.parts[s[a:b]] for a, b in zip([0, *cut], [*cut, len(s)], strict=True)])

    def encode(self, text: str | None) -> np.ndarray:
        norm = self.normalise(text or "")
        find, segments = self.segment.findall, self.segments
        if self.kind == UNIGRAM or self.user_pieces is None:
            parts = map(segments.__getitem__, find(norm))
        else:
            # User-defined pieces stand for themselves, and nothing merges across them.
            parts, at = [], 0
            for m in self.user_pieces.finditer(norm):
                parts += [*map(segments.__getitem__, find(norm[at : m.start()])), array("i", [self.user[m[0]]]).tobytes()]
                at = m.end()
            parts += map(segments.__getitem__, find(norm[at:]))
        ids = np.frombuffer(b"".join(parts), np.int32)
        if self.fallback or self.unk not in ids:
            return ids
        return ids[np.r_[True, (ids[1:] != self.unk) | (ids[:-1] != self.unk)]]  # runs of unknowns are one

    def decode(self, ids) -> str:
        raw = b"".join(map(self.surfaces.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        if self.prefix and self.suffix and raw.endswith(b" "):
            raw = raw[:-1]
        elif self.prefix and not self.suffix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_COMPILED: dict[str, Transducer] = {}
KEPT["sentencepiece"] = _COMPILED.clear


def compiled(model: bytes) -> Transducer:
    """The machines of a model, compiled once in each worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def read_model(path: str = DEFAULT_MODEL) -> bytes:
    """The model file's bytes (about 0.5 MB), read by the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


SCHEMA = "n_tokens int, ids array<int>, decoded_sha256 string, round_trip boolean"


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids, the SHA-256 of the decoded text, and whether it equals the text."""
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, shas, same = [], [], []
                for text in part.column(1).to_pylist():
                    x = t.encode(text)
                    back = t.decode(x)
                    ids.append(x)
                    shas.append(hashlib.sha256(back.encode()).hexdigest())
                    same.append(back == (text or ""))
                n = np.array([len(x) for x in ids], np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), lists, pa.array(shas, pa.string()), pa.array(same, pa.bool_())],
                    names=[id_col, "n_tokens", "ids", "decoded_sha256", "round_trip"],
                )

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(lean(run, "sentencepiece"), f"`{id_col}` {id_type}, {SCHEMA}")
