"""Exact deduplication by 128-bit content hash with byte comparison inside groups.

Texts are equal when they are identical after replacing each run of white space
``[\\x20\\x09-\\x0D]+`` by one space.  Only DataFrame functions are used.

1. Rows become (id, 128-bit digest).  A partial aggregation leaves one row per
   digest and task before the shuffle, so a digest held by a third of all rows
   costs one row per task.
2. Digests with one row need nothing more.  For the others, rows are found
   again by joining on the digest.  Groups of ``HOT`` rows or more are broadcast
   (there are at most rows / HOT of them, and HOT rises with the input so that
   this stays under the broadcast bound); the rest join by shuffle, where no
   key has more than HOT rows.
3. Within each group the smallest and the largest text are compared byte by
   byte.  Groups where they differ (digest collisions) are grouped again by the
   text itself.

Cases: null text counts as empty, so null and empty texts form one group.  Rows
with a null id take part; a null id loses to any other.  Rows that repeat an id
and a text share one verdict.  An empty table gives an empty result.  Columns
beyond id and text are carried by ``exact_dedup`` under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, cut, discard

#: Matches what the white-space rule changes: runs of two or more, and single
#: characters that are not the plain space.
_CHANGED = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """The text with each white-space run replaced by one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CHANGED, " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _with_group(keyed: DataFrame, groups: DataFrame, n_groups: int, n_rows: int, how: str) -> DataFrame:
    """Join rows to their groups on ``_h`` so that no shuffle key holds many rows."""
    if n_groups <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(groups), "_h", how)
    hot = max(1000, -(-n_rows // BROADCAST_ROWS))
    large = groups.where(F.col("_n") >= hot).withColumnsRenamed({"_keep": "_keep1", "_n": "_n1"})
    small = groups.where(F.col("_n") < hot)
    both = keyed.join(F.broadcast(large), "_h", "left")
    # Rows of large groups get a key of their own, so they spread over the shuffle.
    key = F.when(F.col("_keep1").isNull() & F.col("_n1").isNull(), F.col("_h")).otherwise(
        F.encode(F.concat_ws("-", F.lit("large"), F.col("_id").cast("string")), "UTF-8")
    )
    both = both.withColumn("_k", key).join(small.withColumnRenamed("_h", "_k"), "_k", "left")
    both = both.withColumn("_keep", F.coalesce("_keep", "_keep1")).withColumn("_n", F.coalesce("_n", "_n1"))
    both = both.drop("_k", "_keep1", "_n1")
    return both.where(F.col("_n").isNotNull()) if how == "inner" else both


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=_digest) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``digest`` maps the normalised text to the group hash; tests pass a weak one
    to force collisions.
    """
    texts = docs.select(docs[id_col].alias("_id"), normalised(docs[text_col]).alias("_t"))
    keyed = texts.withColumn("_h", digest(F.col("_t")))
    counted = keyed.groupBy("_h").agg(F.min("_id").alias("_keep"), F.count("*").alias("_n"))
    groups = cut(counted.where("_n > 1"), "exact-groups")
    n_groups, n_rows = groups.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()

    if n_groups:
        members = _with_group(keyed, groups, n_groups, n_rows, "inner")
        spread = members.groupBy("_h").agg(F.min("_t").alias("_a"), F.max("_t").alias("_b"))
        clash = cut(spread.where("_a <> _b").select("_h"), "exact-clash")
        n_clash = clash.count()
    else:
        n_clash = 0

    rows = keyed.select("_id", "_h", F.sha2(F.col("_t").cast("binary"), 256).alias("_sha"))
    if not n_clash:
        out = _with_group(rows, groups, n_groups, n_rows, "left")
    else:
        # Collisions are split by the text itself; the other groups stay as they are.
        side = clash.withColumn("_clash", F.lit(True))
        side = F.broadcast(side) if n_clash <= BROADCAST_ROWS else side
        split = keyed.join(side.drop("_clash"), "_h", "left_semi")
        exact = split.groupBy("_h", "_t").agg(F.min("_id").alias("_keep"), F.count("*").alias("_n"))
        exact = exact.select("_h", F.sha2(F.col("_t").cast("binary"), 256).alias("_sha"), "_keep", "_n")
        plain = rows.join(side.drop("_clash"), "_h", "left_anti")
        good = groups.join(side.drop("_clash"), "_h", "left_anti")
        out = _with_group(plain, good, n_groups, n_rows, "left").select("_id", "_sha", "_keep", "_n")
        again = rows.join(side.drop("_clash"), "_h", "left_semi").join(exact, ["_h", "_sha"])
        out = out.unionByName(again.select("_id", "_sha", "_keep", "_n"))
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return out.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
