"""Writers."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import file_system

#: The one fixed schema: what embedding shards hold.
EMBEDDING_SCHEMA = "uid string, idx long, embedding array<float>, orig string, source string"


def write_parquet(df: DataFrame, path: str, mode: str = "error", codec: str = "zstd") -> None:
    """Files appear all at once (commit protocol); an existing folder is not overwritten by default."""
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_embeddings(df: DataFrame, path: str, mode: str = "error") -> None:
    """Embedding shards in their fixed schema, with row groups of bounded size."""
    fields = [f.strip().split(" ", 1) for f in EMBEDDING_SCHEMA.split(", ")]
    df.select(*[F.col(n).cast(t) for n, t in fields]).write.mode(mode).option("compression", "zstd").option(
        "parquet.block.size", str(64 << 20)
    ).parquet(path)


def write_kept_removed(tagged: DataFrame, kept_path: str, removed_path: str | None = None, extra: tuple[str, ...] = ("kept", "best_id", "best_sim")) -> None:
    """Kept rows with their own columns, and removed rows with what they matched.  Empty outputs keep the schema."""
    own = [c for c in tagged.columns if c not in extra and not c.startswith("matched_test_")]
    write_parquet(tagged.where("kept").select(*own), kept_path)
    if removed_path:
        write_parquet(tagged.where(~F.coalesce("kept", F.lit(False))).drop("kept"), removed_path)


def write_jsonl(df: DataFrame, path: str, append: bool = True) -> None:
    df.write.mode("append" if append else "error").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").csv(path)


def write_json_array(df: DataFrame, path: str, limit: int = 100_000) -> None:
    """One pretty JSON array in a local file, for small results only."""
    rows = df.limit(limit + 1).toJSON().collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; write JSON lines instead")
    write_json_file([json.loads(r) for r in rows], path)


def write_json_file(value, path: str) -> None:
    """A manifest or summary, replaced at once."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
    os.replace(path + ".tmp", path)


def write_manifest(spark: SparkSession, value, path: str) -> None:
    """The same in any file system that Spark reads: written beside its place, then renamed."""
    fs, target = file_system(spark, path)
    _, part = file_system(spark, path + ".tmp")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2).encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{path} could not be put in place")


def union_of_parts(*parts: DataFrame) -> DataFrame:
    """Parts of unlike records as one table: columns by name, null where a part has none."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_labels(labelled: DataFrame, source: DataFrame, path: str, label: str = "kmeans_label") -> None:
    """Labelled rows in a folder of their own, with the label last; refuses results that lost or gained rows."""
    write_parquet(labelled.select(*[c for c in labelled.columns if c != label], label), path)
    wrote, had = labelled.sparkSession.read.parquet(path).count(), source.count()
    if wrote != had:
        raise ValueError(f"{wrote} labels for {had} rows in {path}")


def compact(parts: DataFrame, path: str, files: int | None = None) -> None:
    """Parts of a run as one output, in ``files`` files if asked."""
    write_parquet(parts.coalesce(files) if files else parts, path, codec="snappy")
