"""Readers.  All give DataFrames; positions come from the files, not from arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.similarity import parsed_vectors


def with_position(df: DataFrame) -> DataFrame:
    """Adds file_name and row_index of each row: the order of records is (file_name, row_index)."""
    return df.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))


def read_jsonl(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """JSON lines with an inferred schema; strict stops at a bad line, else bad lines are dropped."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.option("mode", mode).json(path)


def read_records(spark: SparkSession, path: str, strict: bool = False, position: bool = False) -> DataFrame:
    """(orig): each line of a JSON-lines file as its JSON text, blank lines left out.

    The records keep their own shapes; bad lines stop the query or are dropped.
    ``position`` adds ``pos``, which orders records as the files and their lines are.
    """
    lines = spark.read.text(path)
    more = []
    if position:
        # Inside one piece of a file, rows come in order; the pieces' first bytes order the rest.
        piece = [F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start")]
        lines = lines.select("value", F.struct(*piece, F.monotonically_increasing_id().alias("row")).alias("pos"))
        more = ["pos"]
    lines = lines.where(F.trim("value") != "")
    if strict:
        return lines.select(F.to_json(F.parse_json("value")).alias("orig"), *more)
    return lines.where(F.try_parse_json("value").isNotNull()).select(F.col("value").alias("orig"), *more)


def read_json_or_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A whole-file JSON array or object if the file is one, else JSON lines without bad ones."""
    whole = spark.read.text(path, wholetext=True)
    bad = whole.where(F.try_parse_json("value").isNull() | F.trim("value").rlike(r"^\{.*\}\s*\{")).limit(1).count()
    return read_jsonl(spark, path, strict=False) if bad else spark.read.option("multiLine", "true").json(path)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: line JSON for json and jsonl, else Parquet, each row as its record (orig)."""
    if path.endswith(("json", "jsonl")):
        return read_records(spark, path, strict=True)
    table = spark.read.parquet(path)
    return table.select(F.to_json(F.struct(*table.columns)).alias("orig"))


def read_parquet(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Parquet files of a file, folder or glob (not deeper); tolerant skips unreadable files."""
    reader = spark.read.option("ignoreCorruptFiles", str(tolerant).lower()).option("recursiveFileLookup", "false")
    if not path.endswith(".parquet") and "*" not in path:
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.parquet(path)


def read_embeddings(spark: SparkSession, path: str, tolerant: bool = True) -> DataFrame:
    """Embedding shards with provenance; rows without a readable vector are left out (see ``skipped_embeddings``)."""
    return parsed_vectors(with_position(read_parquet(spark, path, tolerant)))


def saved_keys(spark: SparkSession, path: str, key: str = "conversations") -> DataFrame:
    """(key): the distinct JSON of a field in already saved lines; a missing file gives none."""
    try:
        rows = read_records(spark, path)
        return rows.select(json_field(F.col("orig"), key).alias("key")).where("key is not null").distinct()
    except Exception as e:  # noqa: BLE001 - only a missing file is expected
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "key string")


def json_field(record: Column, key: str) -> Column:
    """A field's JSON in one spelling, as a key of records."""
    return F.to_json(F.try_variant_get(F.try_parse_json(record), f"$.{key}", "variant"))


def row_count(df: DataFrame) -> int:
    """Rows; for plain Parquet scans Spark reads no column for this."""
    return df.count()
