"""Small column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway import schemas as S

INF = float("inf")


def to_double_or_nan(text: Column) -> Column:
    """Parse a string attribute; missing or unparsable becomes NaN."""
    return F.coalesce(text.try_cast("double"), F.lit(float("nan")))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != INF)


def finite_or_zero(x: Column) -> Column:
    return F.when(is_finite(x), x).otherwise(F.lit(0.0))


def zero_to_null(x: Column) -> Column:
    return F.when(x != 0, x)


def contains_any(text: Column, markers: Sequence[str]) -> Column:
    """Case-insensitive "contains one of the markers"."""
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(F.lower(text), F.lit(marker.lower()))
    return hit


def list_to_text(items: Column) -> Column:
    """Array of strings -> one text cell; inverse of :func:`text_to_list`.

    Elements are JSON-quoted, so ids that hold commas, quotes or brackets survive.
    """
    return F.to_json(items)


def text_to_list(text: Column) -> Column:
    """Read a list cell: a JSON array, or the bare form ``[a, b]``."""
    bare = F.regexp_replace(text, r"^\s*\[\s*|\s*\]\s*$", "")
    split = F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(
        F.split(bare, r"\s*,\s*")
    )
    parsed = F.from_json(text, "array<string>")
    # A bare list is no valid JSON: the parser then gives null or a null element.
    usable = parsed.isNotNull() & ~F.exists(parsed, lambda v: v.isNull())
    return F.when(usable, parsed).otherwise(split)


def emission(wanted: bool, time: str = "time") -> list[Column]:
    """The time at which a record is complete, if wanted."""
    return [F.col(time).alias(S.EMITTED_AT)] if wanted else []
