"""Language identification with language-bitmask n-gram filters.

A filter is a bit-sliced Bloom filter: an array of language masks, one bit per
language.  An n-gram's ``HASHES`` positions are looked up and the masks are
ANDed, which returns all languages whose filters contain the n-gram at once.
Per document, popcounts of each language's bit are taken over all n-grams of the
whole text; with a language's share f of set bits, an n-gram that it lacks
passes by chance with probability f ** HASHES, so the estimate is
(count / n - f**k) / (1 - f**k).  The language with the largest estimate wins,
and the estimate is the score.

Learning reads at most ``DOCS_PER_LANG`` documents of each language (those with
the smallest hashes of their ids), whatever the table's size.  An n-gram enters a
language's filter if at least ``min_share`` of the language's sample (and two
documents) hold it.  Every label is learned: the filters take 1 MB for each 8
languages.

N-grams are windows of ``N`` characters of the lower-cased text in which each run
of characters that are not letters is one space, with a space at both ends.

Cases: a null text, or one without a letter, is ``und`` with score 0.  A text
whose n-grams are in no filter gets the language learned from most documents,
with score 0; so does a text when ties leave the order of languages to decide.
If nothing could be learned, everything is ``und``.  Texts of any length are read
whole, in batches of bounded size.  Rows that repeat an id are learned each under
its own label, and not at all under a null one.  Repeated rows give equal rows; an
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import BROADCAST_ROWS, bounded_batches, chunks, cut, lean

N = 4
HASHES = 3
POSITION_BITS = 20
DOCS_PER_LANG = 400
MIN_SHARE = 0.01
BATCH_CHARS = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index) of each n-gram, and whether each text holds a letter."""
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    x = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    letter = _letters()[x]
    has = np.bincount(owner[letter], minlength=len(texts)) > 0
    first = np.ones(len(x), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep |= first  # a run of other characters is kept as its first one, then made a space
    if len(x):
        x = np.where(letter, x, 32)[keep].astype(np.uint64)
        owner = owner[keep]
    n = len(x) - N + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    h = x[:n].copy()
    for k in range(1, N):
        h *= np.uint64(0x110000)
        h += x[k : n + k]
    # Two rounds of multiply and shift spread the packed characters over 64 bits.
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    same = owner[:n] == owner[N - 1 :]
    return h[same], owner[:n][same], has


def positions(h: np.ndarray, k: int) -> np.ndarray:
    return ((h >> np.uint64(k * POSITION_BITS)) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)


@dataclass
class Filters:
    """Languages in order of their learned documents, and mask slices of 8 languages each."""

    langs: list[str]
    slices: np.ndarray  # (ceil(languages / 8), 1 << POSITION_BITS) uint8

    def chance(self) -> np.ndarray:
        """Per language, the probability that an n-gram it lacks passes."""
        bits = np.stack([(self.slices[j // 8] >> (j % 8) & 1).mean() for j in range(len(self.langs))])
        return bits**HASHES

    def counts(self, h: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
        """Per text and language, how many n-grams the filter contains."""
        out = np.zeros((n_texts, 8 * len(self.slices)), np.int64)
        at = [positions(h, k) for k in range(HASHES)]
        bits = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
        for s, masks in enumerate(self.slices):
            got = masks[at[0]]
            for p in at[1:]:
                got = got & masks[p]
            by_mask = np.bincount(owner * 256 + got, minlength=n_texts * 256).reshape(n_texts, 256)
            out[:, 8 * s : 8 * s + 8] = by_mask @ bits
        return out[:, : len(self.langs)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        h, owner, has = ngrams(texts)
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)[:, None]
        fp = self.chance()
        share = np.clip((self.counts(h, owner, len(texts)) / n - fp) / np.maximum(1 - fp, 1e-9), 0.0, 1.0)
        best = share.argmax(1)
        return [(self.langs[b], float(share[i, b])) if has[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def learn(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG,
    min_share: float = MIN_SHARE,
) -> Filters:
    """Filters from a bounded sample of the rows where ``usable`` holds and lang is not null."""
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    labelled = docs.where(usable & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    named = [docs[id_col].alias("_id"), docs[lang_col].cast("string").alias("_lang")]
    rows = labelled.select(*named)
    found = rows.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").collect()  # one row per label
    if not found:
        return Filters([], np.zeros((0, 1 << POSITION_BITS), np.uint8))
    # The smallest hashes of a language lie below this limit (four times as many do on average), so few rows are ranked.
    span = 1 << 31
    limits = [(r["_lang"], min(span, 4 * docs_per_lang * span // r["count"] + 1)) for r in found]
    below = F.broadcast(spark.createDataFrame(limits, "_lang string, _below long"))
    rows = rows.withColumn("_hash", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(span))).join(below, "_lang").where("_hash < _below")
    order = Window.partitionBy("_lang").orderBy("_hash", "_id")
    chosen = cut(rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= docs_per_lang).select("_id", "_lang"), "lang-sample")
    langs, sizes = [r["_lang"] for r in found], [min(docs_per_lang, r["count"]) for r in found]
    need = [max(2 if n > 1 else 1, min_share * n) for n in sizes]
    index = {x: i for i, x in enumerate(langs)}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang in index:
                    h = np.unique(ngrams([text])[0]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), index[lang], np.int32)), pa.array(h)], names=["lang", "h"])

    # At most docs_per_lang short rows per label, so the sample's side is broadcast while labels are few.
    texts = labelled.select(*named, docs[text_col].alias("_text"))
    ids = chosen.distinct()
    ids = F.broadcast(ids) if docs_per_lang * len(langs) <= BROADCAST_ROWS else ids
    both = (texts["_lang"] == ids["_lang"]) & texts["_id"].eqNullSafe(ids["_id"])
    sample = texts.join(ids, both, "left_semi").select("_lang", "_text")
    counted = sample.mapInArrow(lean(grams), "lang int, h long").groupBy("lang", "h").count()
    enough = F.broadcast(spark.createDataFrame(list(enumerate(map(float, need))), "lang int, _need double"))
    bit = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), F.col("lang") % 8 + 1)
    at = [F.shiftrightunsigned("h", k * POSITION_BITS).bitwiseAND(F.lit((1 << POSITION_BITS) - 1)) for k in range(HASHES)]
    marks = counted.join(enough, "lang").where(F.col("count") >= F.col("_need")).select(
        F.floor(F.col("lang") / 8).cast("int").alias("slice"), F.explode(F.array(*[a.cast("int") for a in at])).alias("at"), bit.alias("bit")
    )
    # One row per filter position at most.
    got = marks.groupBy("slice", "at").agg(F.bit_or("bit").cast("int").alias("mask")).toArrow()
    slices = np.zeros((-(-len(langs) // 8), 1 << POSITION_BITS), np.uint8)
    slices[got.column("slice").to_numpy(), got.column("at").to_numpy()] = got.column("mask").to_numpy()
    return Filters(langs, slices)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """id, the columns of ``keep``, lang_pred and score of each row; only the text decides.

    ``keep`` may hold the text column itself, which then is sent once.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(filters)  # 1 MB for each 8 languages
    kept = docs.select(docs[id_col], *(keep or []))
    own = kept.columns.index(text_col) if text_col in kept.columns else -1
    rows = kept if own >= 0 else docs.select(docs[id_col], *(keep or []), docs[text_col].alias("_text"))
    fields = kept.schema.fields
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            texts = batch.column(own)
            sizes = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
            for a, b in chunks(sizes, BATCH_CHARS):
                got = learned.predict(texts.slice(a, b - a).to_pylist())
                columns = [c.slice(a, b - a) for c in batch.columns[: len(names)]]
                columns += [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    return rows.mapInArrow(lean(run), schema)
