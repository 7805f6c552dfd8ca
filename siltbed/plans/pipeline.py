"""The whole run: embed, deduplicate, judge, filter, generate.

Each stage reads its upstream stage's folder and writes its own.  A folder's name
holds the stage's mark: a digest of the records (their numbers and contents), of
the stage's own settings, and of the marks of the stages before it.  So a stage
is reused, unless ``force``, only where its input and settings are the same, and
a change anywhere reruns all stages after it.  Skipped stages hand their upstream
on.  The manifest is written beside the folders.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field, fields, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat, prompts, text
from ..operators import dedup, filters, model_calls
from ..sources import writers
from ..sources.scratch import file_system
from ..streaming import resume

STAGES = ("embedding", "dedup", "judge", "filter", "inference")


#: The settings that each stage's result depends on.
DEPENDS = {
    "embedding": ("embedder", "model_name", "source", "all_turns"),
    "dedup": ("threshold",),
    "judge": ("judge_client", "judge_field", "prompt_key", "templates", "retries"),
    "filter": ("low", "high"),
    "inference": ("generate_client", "samples", "multi_turn", "max_turns", "retries"),
}
#: Fields of clients that are secret or do not change answers.
UNNAMED = ("api_key", "headers", "timeout")


@dataclass
class Settings:
    run_name: str
    work_dir: str
    judge_client: model_calls.Client
    generate_client: model_calls.Client
    embedder: model_calls.Embedder = field(default_factory=model_calls.HashEmbedder)
    model_name: str = "hash"
    source: str | None = None
    all_turns: bool = False
    threshold: float = 0.9
    judge_field: str = "prompt"
    prompt_key: str = "rate_answer"
    templates: dict[str, str] = field(default_factory=dict)
    low: float | None = 7.0
    high: float | None = 10.0
    samples: int = 1
    multi_turn: bool = False
    max_turns: int = 0
    threads: int = 8
    retries: int = 5
    pause: float = 5.0
    part_rows: int = 2000
    skip: tuple[str, ...] = ()
    force: bool = False
    dry_run: bool = False


def embed_stage(records: DataFrame, s: Settings) -> DataFrame:
    """(uid, idx, embedding, orig, source) of the records (idx, orig) that hold a text."""
    rows, orig = chat.with_record(records, "orig")
    own = F.try_variant_get(orig.variant, "$.source", "string")
    texts = rows.withColumns({"text": chat.embedding_text(orig, s.all_turns), "_own": own}).where(~text.blank(F.col("text")))
    vectors = model_calls.embed(texts.select("idx", "orig", "text", "_own"), "text", s.embedder)
    return vectors.select(
        text.record_uid(F.col("idx"), F.col("orig")).alias("uid"), "idx", "embedding", "orig", text.source_name(F.col("_own"), s.source).alias("source")
    )


def dedup_stage(shards: DataFrame, s: Settings) -> DataFrame:
    tagged = dedup.greedy_dedup(shards, s.threshold, "idx")
    return tagged.where("kept").drop("kept", "best_id", "best_sim")


def judge_stage(rows: DataFrame, s: Settings) -> DataFrame:
    read, parsed = chat.with_row_records(rows)
    texts = {f: chat.row_text(rows, f, parsed) for f in dict.fromkeys(("prompt", "response", s.judge_field))}
    read = read.withColumns({f"_{f}": c for f, c in texts.items()}).drop(*[c for r in parsed for c in r.columns])
    asked = prompts.with_prompt(read, F.col(f"_{s.judge_field}"), F.col("_prompt"), F.col("_response"), s.prompt_key, s.templates)
    options = {"threads": s.threads, "retries": s.retries, "pause": s.pause}
    judged = model_calls.judge(asked, F.col("uid"), s.judge_client, text=F.col(f"_{s.judge_field}"), **options)
    return judged.drop("prompt", *[f"_{f}" for f in texts])


def generate_stage(rows: DataFrame, s: Settings) -> DataFrame:
    read, orig = chat.with_record(rows, "orig")
    if s.multi_turn:
        read = read.withColumn("_asked", chat.model_messages(orig, s.max_turns))
    else:
        read = read.withColumn("_said", text.sanitize(chat.record_text(orig))).withColumn("_asked", model_calls.user_message(F.col("_said"))).drop("_said")
    options = {"threads": s.threads, "retries": s.retries, "pause": s.pause}
    got = model_calls.generate(read.drop(*orig.columns), F.col("uid"), F.col("_asked"), s.generate_client, s.samples, **options)
    return got.withColumn("llm_response", F.coalesce(F.to_json("samples"), F.lit("[]"))).drop("samples", "_asked")


def described(value) -> str:
    """A setting in words that are the same in each process; functions by their code and what they hold."""
    if is_dataclass(value) and not isinstance(value, type):
        inner = ", ".join(f"{f.name}={described(getattr(value, f.name))}" for f in fields(value) if f.name not in UNNAMED)
        return f"{type(value).__qualname__}({inner})"
    if callable(value) and (code := getattr(value, "__code__", None)):
        consts = [described(c) if hasattr(c, "co_code") else repr(c) for c in code.co_consts]
        held = [described(c.cell_contents) for c in value.__closure__ or ()]
        return f"{value.__qualname__}:{code.co_code.hex()}:{consts}:{code.co_names}:{held}:{value.__defaults__}"
    if hasattr(value, "co_code"):
        return f"{value.co_code.hex()}:{value.co_names}"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k!r}: {described(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, tuple | list):
        return "[" + ", ".join(map(described, value)) + "]"
    if value is None or isinstance(value, str | int | float | bool):
        return repr(value)
    return f"{type(value).__module__}.{type(value).__qualname__}:{sorted((k, described(v)) for k, v in vars(value).items())}"


def _mark(*parts: str) -> str:
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()[:16]


def run(records: DataFrame, s: Settings) -> tuple[DataFrame, dict]:
    """All stages over records (idx, orig); returns the last result and the manifest."""
    spark = records.sparkSession
    own = resume.fingerprint(records, "idx", "orig")
    mark = _mark(own)
    base = f"{s.work_dir.rstrip('/')}/{s.run_name}/{text.model_tag(s.model_name)}"
    manifest: dict = {"run_name": s.run_name, "run_dir": base, "input": own, "stages": {}, "created_at": time.strftime("%Y-%m-%dT%H:%M:%S")}
    work: dict[str, Callable[[DataFrame, Settings], DataFrame]] = {
        "embedding": embed_stage,
        "dedup": dedup_stage,
        "judge": judge_stage,
        "filter": lambda df, s: filters.filter_by_score(df, low=s.low, high=s.high),
    }
    rows = records
    for name in STAGES:
        if name in s.skip:
            manifest["stages"][name] = {"state": "skipped"}
            continue
        mark = _mark(mark, name, *(described(getattr(s, k)) for k in DEPENDS[name]))
        path = f"{base}/{name}-{mark}"
        if s.dry_run:
            manifest["stages"][name] = {"state": "planned", "path": path}
            continue
        if not s.force and _finished(spark, path):
            state = "reused"
        else:
            state = "written"
            _remove(spark, path)
            if name == "inference":
                parts = path + ".parts"
                if s.force:
                    _remove(spark, parts)
                writers.compact(resume.run_in_parts(rows, "uid", lambda df: generate_stage(df, s), parts, s.part_rows), path)
            else:
                writers.write_parquet(work[name](rows, s), path)
        before, rows = rows, spark.read.parquet(path)
        manifest["stages"][name] = {"state": state, "path": path, "rows": rows.count()}
        if name == "filter":
            total, parsed, kept = filters.score_stats(before, low=s.low, high=s.high).first()
            manifest["filter_stats"] = {"total": total, "parsed": parsed, "kept": kept}
    if not s.dry_run:
        writers.write_manifest(spark, manifest, f"{base}/manifest-{mark}.json")
    return rows, manifest


def _finished(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path + "/_SUCCESS")
    return fs.exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)
