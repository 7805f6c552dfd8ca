"""Mixing sources to target weights, in fixed-length blocks.

1. Targets: source weights share the words of all sources; a source's target
   stops at ``max_repeats`` times its size, and the excess is shared again.
2. The words of each source form one stream (documents in a fixed hashed
   order), packed into blocks of ``block`` words; only the last one is shorter.
3. Each source draws as many block slots as its target needs.  A pseudorandom
   permutation over all slots deals them to output shards.  A shard's counts of
   the sources are so drawn from the multinomial law conditioned on the sources'
   totals, which is the multivariate hypergeometric law: free multinomial draws
   would miss the targets of small sources by chance.
4. Slot j of a source maps to a block through the source's own pseudorandom
   permutation of its block indices, a new one for each pass over the source.
   The last slot of a source may take only the first words of its block, so the
   words taken equal the rounded target.
5. Slots and blocks are joined by (source, block index).

Both permutations are swap-or-not shuffles, which are bijections of [0, n) for
any n, computed per value with built-in functions.  No row is ever sorted with
all others of its source: a source's stream is cut into hashed buckets whose
offsets come from one row per bucket.

Cases: null or empty texts have size 0 and are taken 0 times.  A null source is
a source like any other, last in order.  Repeated rows are taken on their own.
A source without words has target 0.  An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import BROADCAST_ROWS, cut, join_small

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 64
SLOTS_PER_SHARD = 8192
ROUNDS = 16
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(x: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """The image of x under a keyed pseudorandom permutation of [0, n): a swap-or-not shuffle."""

    def step(acc: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(11), r, *key), n) - acc, n)
        flip = F.xxhash64(F.lit(13), r, F.greatest(acc, partner), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(flip, partner).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """Adds sid (rank by code point, null last) and target to (source, source_size), one row per source.

    A source is at its limit c exactly if c / w is at most the common share per
    weight; in the order of c / w, that share is what earlier limits leave over
    the weight that is left, and the first source whose limit exceeds its part
    ends the limited ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("sid"), F.lit(len(weights))) + 1)
    out = sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("_w", w)
    out = out.withColumn("_c", (F.col("source_size") * max_repeats).cast("double"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_c") / F.col("_w"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("_total", F.sum("source_size").over(everything).cast("double"))
    left = F.col("_total") - F.coalesce(F.sum("_c").over(before), F.lit(0.0))
    weight = F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("_share", left / weight)
    out = out.withColumn("_free", F.col("_c") > F.col("_share") * F.col("_w"))
    share = F.min(F.when(F.col("_free"), F.struct(F.col("_c") / F.col("_w"), F.col("sid"), F.col("_share")))).over(everything)
    level = share.getField("_share")
    target = F.when(level.isNull(), F.col("_c")).otherwise(F.least(F.col("_c"), level * F.col("_w")))
    return out.select("sid", "source", "source_size", target.alias("target"))


def sources(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size) of each row, written once so that texts are read once."""
    return cut(
        docs.select(docs[id_col].alias("_id"), docs[source_col].alias("source"), n_words(docs[text_col]).alias("size")),
        "mix-sizes",
    )


class Mix:
    """The plan of one mix; its parts are DataFrames.

    rows: _id, source, size, sid, source_size, target, start (offset in the source's stream)
    slots: sid, block, take (words used of the block), pass, shard, position
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = WEIGHTS,
        block: int = BLOCK_WORDS,
        max_repeats: int = 3,
        slots_per_shard: int = SLOTS_PER_SHARD,
        seed: int = 1,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
    ):
        self.block, self.seed = block, seed
        sized = sources(docs, id_col, text_col, source_col)
        per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
        self.sources = cut(targets(per_source.select("source", "source_size"), weights, max_repeats), "mix-targets")
        n_sources, n_rows = self.sources.count(), sized.count()
        right = self.sources.withColumnRenamed("source", "_s")
        right = F.broadcast(right) if n_sources <= BROADCAST_ROWS else right
        rows = sized.join(right, sized["source"].eqNullSafe(right["_s"])).drop("_s")

        # Streams: hashed buckets of each source, then the id inside a bucket.
        buckets = max(512, -(-n_rows // 20_000))
        rows = rows.withColumn("_b", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(buckets)))
        fill = rows.groupBy("sid", "_b").agg(F.sum("size").alias("_fill"))
        ahead = Window.partitionBy("sid").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        fill = fill.select("sid", "_b", F.coalesce(F.sum("_fill").over(ahead), F.lit(0)).alias("_base"))
        inside = Window.partitionBy("sid", "_b").orderBy("_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        rows = rows.join(fill, ["sid", "_b"])
        self.rows = rows.withColumn("start", F.col("_base") + F.col("_in")).drop("_b", "_base", "_in")
        self.slots = self._slots(slots_per_shard)

    def _slots(self, per_shard: int) -> DataFrame:
        size, b = F.col("source_size"), F.lit(self.block)
        plan = self.sources.where("source_size > 0").withColumn("_words", F.round("target").cast("long"))
        plan = plan.withColumn("_full", F.floor(size / b)).withColumn("_tail", size % b)
        plan = plan.withColumn("_n", F.col("_full") + (F.col("_tail") > 0).cast("long"))
        plan = plan.withColumn("_rest", F.col("_words") % size)
        plan = plan.withColumn("_q", F.least(F.floor(F.col("_rest") / b), F.col("_full")))
        plan = plan.withColumn("_part", F.col("_rest") - F.col("_q") * b)
        plan = plan.withColumn(
            "_slots", F.floor(F.col("_words") / size) * F.col("_n") + F.col("_q") + (F.col("_part") > 0).cast("long")
        )
        ahead = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
        plan = plan.withColumn("_first", F.coalesce(F.sum("_slots").over(ahead), F.lit(0)))
        plan = plan.withColumn("_all", F.sum("_slots").over(Window.partitionBy()))

        # Slots of a source by digits of base 1,024, so that no row holds a long list.
        kib, mib = F.lit(1 << 10), F.lit(1 << 20)
        last = F.col("_slots") - 1
        s = plan.where("_slots > 0").withColumn("_hi", F.explode(F.sequence(F.lit(0), F.floor(last / mib))))
        top = F.least(kib - 1, F.floor((last - F.col("_hi") * mib) / kib))
        s = s.withColumn("_mid", F.explode(F.sequence(F.lit(0), top.cast("long"))))
        # A fixed number of partitions: the few rows here become 1,024 each, which adaptive
        # coalescing cannot foresee.
        words = self.sources.agg(F.sum("target")).first()[0] or 0
        s = s.repartition(max(8, min(100_000, int(words / self.block / 50_000))), "sid", "_hi", "_mid")
        base = F.col("_hi") * mib + F.col("_mid") * kib
        s = s.withColumn("_lo", F.explode(F.sequence(F.lit(0), F.least(kib - 1, last - base).cast("long"))))
        s = s.withColumn("_j", base + F.col("_lo"))

        s = s.withColumn("pass", F.floor(F.col("_j") / F.col("_n"))).withColumn("_r", F.col("_j") % F.col("_n"))
        mapped = shuffled(F.col("_r"), F.col("_full"), F.lit(self.seed), F.col("sid"), F.col("pass"))
        s = s.withColumn("block", F.when(F.col("_r") < F.col("_full"), mapped).otherwise(F.col("_full")))
        whole = F.when(F.col("block") < F.col("_full"), b.cast("long")).otherwise(F.col("_tail"))
        partial = (F.col("_part") > 0) & (F.col("_j") == last)
        s = s.withColumn("take", F.when(partial, F.col("_part")).otherwise(whole))
        s = s.withColumn("_x", shuffled(F.col("_first") + F.col("_j"), F.col("_all"), F.lit(self.seed)))
        return s.select(
            "sid",
            "block",
            "take",
            "pass",
            F.floor(F.col("_x") / per_shard).alias("shard"),
            (F.col("_x") % per_shard).alias("position"),
        )

    def pieces(self) -> DataFrame:
        """Rows cut at block limits: adds block, and the words [lo, hi) of the block that the piece fills."""
        b = self.block
        end = F.col("start") + F.col("size")
        out = self.rows.where("size > 0").withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((end - 1) / b)))
        )
        lo = F.greatest(F.col("start") - F.col("block") * b, F.lit(0))
        return out.withColumn("lo", lo).withColumn("hi", F.least(end - F.col("block") * b, F.lit(b)))

    def taken_pieces(self) -> DataFrame:
        """Pieces joined with the slots that use them: adds pass, shard, position, words [lo, hi) taken."""
        # Slots grow with the input, so they are never broadcast.
        both = self.pieces().join(self.slots.hint("merge"), ["sid", "block"])
        return both.withColumn("hi", F.least("hi", "take")).where("hi > lo").drop("take")

    def taken(self, id_col: str = "doc_id") -> DataFrame:
        """One row per input row: id, size, source_size, target, taken, and where the mix puts it.

        slots: the block slots that hold words of the row; first_shard: the least
        output shard among them; placement: a checksum of all their shards,
        positions and words.
        """
        where = F.xxhash64("shard", "position", "lo", "hi")
        used = self.taken_pieces().groupBy("sid", "start")
        used = used.agg(F.sum(F.col("hi") - F.col("lo")).alias("_t"), F.count("*").alias("slots"), F.min("shard").alias("first_shard"), F.bit_xor(where).alias("placement"))
        full = self.rows.where("size > 0").join(used.hint("merge"), ["sid", "start"], "left")
        none = self.rows.where("size = 0")
        return full.unionByName(none, allowMissingColumns=True).select(
            F.col("_id").alias(id_col),
            "size",
            "source_size",
            "target",
            F.coalesce("_t", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("slots", F.lit(0)).cast("long").alias("slots"),
            "first_shard",
            F.coalesce("placement", F.lit(0)).cast("long").alias("placement"),
        )


def shard_counts(mix: Mix) -> DataFrame:
    """Block slots of each source in each output shard."""
    return mix.slots.groupBy("shard", "sid").agg(F.count("*").alias("slots"))


def mixed_blocks(mix: Mix, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: shard, position, source and text of each packed block.

    Needs ids that differ between rows.
    """
    n = mix.rows.count()
    words = docs.select(docs[id_col].alias("_id"), F.regexp_extract_all(docs[text_col], F.lit(WORD), F.lit(0)).alias("_w"))
    cut_at = mix.pieces().select("_id", "sid", "source", "start", "block", "lo", "hi")
    parts = join_small(words, cut_at, ["_id"], "inner", n)
    first = F.col("block") * mix.block + F.col("lo") - F.col("start") + 1
    parts = parts.select("sid", "source", "block", "lo", F.slice("_w", first.cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("_w"))
    blocks = parts.groupBy("sid", "block").agg(
        F.first("source").alias("source"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("lo", "_w"))), lambda p: p["_w"])).alias("_w"),
    )
    out = mix.slots.hint("merge").join(blocks, ["sid", "block"])
    return out.select("shard", "position", "source", F.array_join(F.slice("_w", F.lit(1), F.col("take").cast("int")), " ").alias("text"))
