"""Row filters, limits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scores import score


def in_range(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive range; null and NaN are outside (Spark orders NaN above all numbers)."""
    out = value.isNotNull() & ~F.isnan(value)
    if low is not None:
        out &= value >= low
    if high is not None:
        out &= value <= high
    return F.coalesce(out, F.lit(False))


def with_score(df: DataFrame, column: str = "sglang_result", parse=score) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"no column {column}; there are {df.columns}")
    return df.withColumn("judge_score", parse(df[column]))


def filter_by_score(df: DataFrame, column: str = "sglang_result", low: float | None = 7.0, high: float | None = 10.0, parse=score) -> DataFrame:
    """Rows whose score is in range, with ``judge_score``."""
    scored = with_score(df, column, parse)
    return scored.where(in_range(scored["judge_score"], low, high))


def score_stats(df: DataFrame, column: str = "sglang_result", low: float | None = 7.0, high: float | None = 10.0, parse=score) -> DataFrame:
    """One row: total, parsed, kept."""
    s = with_score(df, column, parse)
    return s.agg(
        F.count("*").alias("total"), F.count("judge_score").alias("parsed"), F.count_if(in_range(s["judge_score"], low, high)).alias("kept")
    )


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in an order; all rows for n of 0 or less."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def per_file_sample(df: DataFrame, file: str, limit: int, key: Column, per_file: int | None = None) -> DataFrame:
    """A reproducible sample of about ``limit`` rows with the same quota for each file."""
    files = df.select(file).distinct().count()
    quota = max(1, min(per_file or limit, -(-limit // max(1, files))))
    by = Window.partitionBy(file).orderBy(F.xxhash64(key, F.lit(42)), key)
    return df.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= quota).drop("_r").limit(limit)
