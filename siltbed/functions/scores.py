"""Scores in free-form judge output.

``native_score`` is a chain of expressions that agrees with ``score`` on
well-formed output; ``score`` is an Arrow function for everything, including
Python-style and embedded JSON.
"""

from __future__ import annotations

import ast
import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Keys of a score in a JSON answer, in order of preference.
SCORE_KEYS = ("score", "rating", "overall_score", "value")
# Patterns of a score in text, in order of preference.
NUMBER = r"-?\d+(?:\.\d+)?"
TEXT_PATTERNS = (
    rf"\[\[\s*({NUMBER})\s*\]\]",
    rf"<score>\s*({NUMBER})\s*</score>",
    rf'"(?:score|rating)"\s*:\s*"?({NUMBER})"?',
    rf"rating\s*[:：]\s*({NUMBER})",
)
# Fixed value: how a failed call is stored.
FAILED_PREFIX = "failed_after_"


def number(text: Column) -> Column:
    """A plain decimal number, or null; unlike a bare cast it refuses suffixes such as 5d."""
    clean = strip(text)
    return F.when(clean.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), clean.try_cast("double"))


def native_score(text: Column, failures_count: bool = False) -> Column:
    """Score by JSON keys, then patterns, then the only number.

    Stored failures give null; with ``failures_count`` their number counts, as
    the only number in the text.
    """
    v = F.try_parse_json(text)
    keyed = F.coalesce(*[number(F.try_variant_get(v, f"$.{k}", "string")) for k in SCORE_KEYS])
    found = [F.regexp_extract(text, "(?iU)" + p, 1) for p in TEXT_PATTERNS]
    shown = F.coalesce(*[F.when(x != "", x.try_cast("double")) for x in found])
    every = F.regexp_extract_all(text, F.lit("(?U)(" + NUMBER + ")"), F.lit(1))
    only = F.when(F.size(every) == 1, every[0].try_cast("double"))
    out = F.coalesce(keyed, shown, only)
    return out if failures_count else F.when(~F.contains(text, F.lit(FAILED_PREFIX)), out)


def embedded_object(text: Column) -> Column:
    """The JSON object in a text, as a variant: the whole text, or from the first brace to the last, single quotes allowed."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    found = F.coalesce(F.try_parse_json(strip(text)), F.try_parse_json(inner), F.try_parse_json(F.replace(inner, F.lit("'"), F.lit('"'))))
    return F.when(F.startswith(F.schema_of_variant(found), F.lit("OBJECT")), found)


def _as_float(value: object) -> float | None:
    try:
        return float(value) if isinstance(value, int | float | str) else None
    except ValueError:
        return None


def _objects(text: str):
    """Values that parse in the text and in its shortest brace groups, single quotes allowed."""
    for part in [text, *re.findall(r"\{.*?\}", text, re.S)]:
        for form in (part, part.replace("'", '"')):
            try:
                yield json.loads(form)
                break
            except ValueError:
                continue


def score_of(text: str | None, failures_count: bool = False) -> float | None:
    """The full rule for one text."""
    clean = (text or "").strip()
    if not clean or (FAILED_PREFIX in clean and not failures_count):
        return None
    first = next((x for x in _objects(clean) if isinstance(x, dict)), {})
    for key in SCORE_KEYS:
        value = _as_float(first.get(key))
        if value is not None:
            return None if math.isnan(value) else value
    for pattern in TEXT_PATTERNS:
        if hit := re.search(pattern, clean, re.I):
            return float(hit[1])
    numbers = re.findall(NUMBER, clean)
    return float(numbers[0]) if len(numbers) == 1 else None


def score(text: Column, failures_count: bool = False) -> Column:
    """The full rule.  Only texts that expressions cannot decide, those with a brace or beyond ASCII, go through Python.

    The function counts as nondeterministic, so a filter on the score does not evaluate it again.
    """

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else score_of(x, failures_count)).astype("float64")

    hard = F.contains(text, F.lit("{")) | text.rlike(r"[^\x00-\x7F]|[\x1c-\x1f]")
    read = run.asNondeterministic()(F.when(hard, text))
    return F.when(hard, read).otherwise(native_score(text, failures_count))


def bracket_score(text: Column) -> Column:
    """The number in double square brackets, sign allowed."""
    got = F.regexp_extract(text, r"(?U)\[\[\s*([+-]?\d+(?:\.\d+)?)\s*\]\]", 1)
    return F.when(got != "", got.try_cast("double"))


def native_aspects(text: Column) -> Column:
    """struct(Clarity, Cognitive_Complexity) of a JSON answer, or null unless both are there."""
    clean = strip(F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    v = F.try_parse_json(clean)
    a, b = (F.try_variant_get(v, f"$.{k}.Score", "double") for k in ("Clarity", "Cognitive_Complexity"))
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("Clarity"), b.alias("Cognitive_Complexity")))


def aspects_of(text: str | None) -> dict[str, float] | None:
    """The same for JSON or a Python literal, also with JSON's words in it."""
    clean = (text or "").replace("```json", "").replace("```", "").strip()
    python = clean
    for word, own in ((": true", ": True"), (": false", ": False"), (": null", ": None")):
        python = python.replace(word, own)
    for parse, form in ((json.loads, clean), (ast.literal_eval, clean), (ast.literal_eval, python)):
        try:
            value = parse(form)
            break
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
    else:
        return None
    parts = [value.get(k) for k in ("Clarity", "Cognitive_Complexity")] if isinstance(value, dict) else [None]
    numbers = [_as_float(p.get("Score")) if isinstance(p, dict) else None for p in parts]
    return None if None in numbers else {"Clarity": numbers[0], "Cognitive_Complexity": numbers[1]}


def aspects(text: Column) -> Column:
    @F.pandas_udf("Clarity double, Cognitive_Complexity double")
    def run(s: pd.Series) -> pd.DataFrame:
        got = [aspects_of(x) or {} for x in s]
        return pd.DataFrame({k: [g.get(k) for g in got] for k in ("Clarity", "Cognitive_Complexity")}, dtype="float64")

    both = run(text)
    return F.when(both["Clarity"].isNotNull() & both["Cognitive_Complexity"].isNotNull(), both)
