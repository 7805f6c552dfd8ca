"""Prompt templates as a table, and prompts as Column expressions.

A template names its placeholders in braces.  ``{question}`` and ``{answer}``
take the last turns, ``{text}`` the main text; a template without any of them
gets the text appended.  Template files are read as JSON or as string constants
of a Python file, and never executed.
"""

from __future__ import annotations

import ast
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import sanitize, strip

#: Our own templates; ``default`` serves unknown keys.
TEMPLATES = {
    "default": "Read the text and assess it.\n\n{text}",
    "classify": 'Name the topic of the text. Answer as JSON: {"name": "..."}.\n\n{text}',
    "score_text": 'Give the text a score from 0 to 100. Answer as JSON: {"score": n}.\n\n{text}',
    "rate_answer": "Rate how well the answer serves the question, from 1 to 10. End with [[n]].\n\nQuestion: {question}\n\nAnswer: {answer}",
    "complexity": 'Score clarity and complexity from 1 to 10 as JSON: {"Clarity": {"Score": n}, "Cognitive_Complexity": {"Score": n}}.\n\n{question}',
    "append_only": "Say in one line what the following text is about.",
}


def load_templates(path: str) -> dict[str, str]:
    """Templates of a JSON object or of the public string constants in a Python file."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    if path.endswith(".json"):
        return {k: v for k, v in json.loads(source).items() if isinstance(v, str)}
    out = {}
    for node in ast.parse(source).body:
        if isinstance(node, ast.Assign) and isinstance(node.value, ast.Constant) and isinstance(node.value.value, str):
            out |= {t.id: node.value.value for t in node.targets if isinstance(t, ast.Name) and not t.id.startswith("_")}
    return out


def template_table(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """(prompt_key, template); a few rows, so joins broadcast it."""
    return spark.createDataFrame(sorted((TEMPLATES | (extra or {})).items()), "prompt_key string, template string")


def fill(template: Column, text: Column, question: Column, answer: Column, extra: str | None = None, safe: bool = False) -> Column:
    """The prompt.

    Question and answer are put in one after the other, so a question that
    holds ``{answer}`` is filled as well; ``safe`` prevents that.
    """
    main, q, a = sanitize(text), sanitize(question), sanitize(answer)
    if extra and extra.strip():
        main = F.when(main != "", F.concat(main, F.lit("\n\n" + extra.strip()))).otherwise(F.lit(extra.strip()))
    if safe:
        mark = "\x00a\x00"
        marked = F.replace(template, F.lit("{answer}"), F.lit(mark))
        both = F.replace(F.replace(marked, F.lit("{question}"), q), F.lit(mark), a)
    else:
        both = F.replace(F.replace(template, F.lit("{question}"), q), F.lit("{answer}"), a)
    pair = F.contains(template, F.lit("{question}")) | F.contains(template, F.lit("{answer}"))
    one = F.contains(template, F.lit("{text}"))
    return F.when(pair, both).when(one, F.replace(template, F.lit("{text}"), main)).otherwise(F.concat(template, F.lit("\n\n"), main))


def with_prompt(
    df: DataFrame, text: Column, question: Column, answer: Column, key: str = "default", templates: dict[str, str] | None = None, extra: str | None = None
) -> DataFrame:
    """Adds ``prompt``; a row's own ``prompt_key`` beats the given one, and unknown keys use ``default``."""
    own = F.when(strip(df["prompt_key"]) != "", df["prompt_key"]) if "prompt_key" in df.columns else F.lit(None).cast("string")
    table = template_table(df.sparkSession, templates)
    known = F.broadcast(table.withColumnsRenamed({"prompt_key": "_key", "template": "_template"}))
    base = (TEMPLATES | (templates or {}))["default"]
    keyed = df.withColumns({"_want": F.coalesce(own, F.lit(key)), "_text": text, "_q": question, "_a": answer})
    out = keyed.join(known, F.col("_want") == F.col("_key"), "left")
    prompt = fill(F.coalesce("_template", F.lit(base)), F.col("_text"), F.col("_q"), F.col("_a"), extra)
    return out.withColumn("prompt", prompt).drop("_want", "_text", "_q", "_a", "_key", "_template")
