"""Multi-turn runner over JSON lines: exact dedup, resume, one prompt from the whole history, append.

Failed calls are not saved, so the next run tries them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat
from ..operators import dedup, filters, model_calls
from ..sources import readers
from ..sources.scratch import cut


def open_records(spark: SparkSession, data_path: str, save_path: str, max_samples: int = 50, key: str = "conversations") -> DataFrame:
    """(pos, orig, key): the first of equal conversations that are not saved yet; 0 samples means all.

    Rows without the key are left out and do not count as samples.  The order is that of files and their lines.
    """
    rows = readers.read_records(spark, data_path, position=True)
    rows = rows.withColumn("key", readers.json_field(F.col("orig"), key)).where("key is not null")
    first = dedup.first_of_each(cut(rows, "records"), F.col("key"), "pos")
    saved = readers.saved_keys(spark, save_path, key)
    return filters.head(dedup.not_done(first, F.col("key"), saved, saved["key"]), max_samples, "pos")


def run(
    spark: SparkSession,
    data_path: str,
    save_path: str,
    client: model_calls.Client,
    base_prompt: str = "",
    max_samples: int = 50,
    threads: int = 25,
    retries: int = 0,
    pause: float = 0.0,
) -> int:
    """Appends {conversations, outputs, prompt_tokens, completion_tokens} lines; returns how many."""
    rows, orig = chat.with_record(open_records(spark, data_path, save_path, max_samples), "orig")
    rows = rows.withColumn("_prompt", chat.history_prompt(orig, base_prompt)).select("key", "_prompt")
    got = model_calls.call_model(rows, F.sha2("key", 256), model_calls.user_message(F.col("_prompt")), client, threads, retries, pause)
    good = got.where("reply.status = 'ok'").select(
        F.to_json(
            F.struct(
                F.parse_json("key").alias("conversations"),
                F.regexp_replace("reply.text", r"^\n+|\n+$", "").alias("outputs"),
                F.col("reply.prompt_tokens"),
                F.col("reply.completion_tokens"),
            )
        ).alias("value")
    )
    before = readers.saved_keys(spark, save_path).count()
    good.write.mode("append").text(save_path)
    return readers.saved_keys(spark, save_path).count() - before
