"""Stored model responses: lists of samples with failed slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scores import FAILED_PREFIX
from .text import strip

# States that are not failures.
GOOD_STATES = ("", "ok", "success")


def samples(stored: Column) -> Column:
    """The stored samples as strings: a JSON list, or one value; null for missing or blank."""
    v = F.try_parse_json(stored)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    one = F.array(F.coalesce(F.try_variant_get(v, "$", "string"), stored))
    return F.when(strip(stored) != "", F.coalesce(items, one))


def failed(item: Column) -> Column:
    """True for null and blank samples, stored failures, and objects whose status is not good."""
    status = F.lower(strip(F.try_variant_get(F.try_parse_json(item), "$.status", "string")))
    clean = strip(item)
    bad = (clean == "") | F.startswith(clean, F.lit(FAILED_PREFIX)) | ~F.coalesce(status.isin(*GOOD_STATES), F.lit(True))
    return F.coalesce(bad, F.lit(True))


def retry_slots(items: Column, n: int) -> Column:
    """Slots of the n wanted samples that are missing or failed.

    An empty list has none: a row without usable input is not tried for ever.
    A missing value (null) has all.
    """
    every = F.array(*[F.lit(i) for i in range(n)]) if n > 0 else F.array().cast("array<int>")
    bad = F.filter(every, lambda i: failed(F.try_element_at(items, i + 1)))
    return F.when(items.isNull(), every).when(F.size(items) == 0, F.array().cast("array<int>")).otherwise(bad)


def serialise(items: Column) -> Column:
    """The stored form; null becomes an empty list."""
    return F.coalesce(F.to_json(items), F.lit("[]"))
