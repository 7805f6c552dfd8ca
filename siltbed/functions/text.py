"""Text clean-up as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` sees it.
_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
MAX_CHARS = 4000
CUT_MARK = "...(truncated)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACE))


def blank(text: Column) -> Column:
    """True for null, empty and white-space texts."""
    return F.coalesce(strip(text) == "", F.lit(True))


def sanitize(text: Column, max_chars: int = MAX_CHARS) -> Column:
    """Stripped text, cut to ``max_chars`` with a mark; null becomes empty."""
    clean = F.coalesce(strip(text), F.lit(""))
    return F.when(F.length(clean) > max_chars, F.concat(F.substring(clean, 1, max_chars), F.lit(CUT_MARK))).otherwise(clean)


def head_chars(text: Column, max_tokens: int, chars_per_token: int = 4) -> Column:
    """The characters that a model of ``max_tokens`` can take, without a mark."""
    return F.substring(text, 1, max_tokens * chars_per_token)


def after_thinking(text: Column) -> Column:
    """What follows the last closing think tag."""
    return F.substring_index(text, "</think>", -1)


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in columns])


def source_name(own: Column, fallback: str | None = None) -> Column:
    """A record's source, stripped; null gives the fallback (and not the word None)."""
    return F.coalesce(F.when(strip(own) != "", strip(own)), F.lit(fallback), F.lit(""))


def record_uid(*parts: Column) -> Column:
    """A reproducible id of a record."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256)


def model_tag(name: str) -> str:
    """A model path as a file-name part."""
    tail = re.split(r"[/\\]", name.rstrip("/\\"))[-1]
    return re.sub(r"[^0-9A-Za-z._-]+", "_", tail).strip("._-") or "unknown_model"
