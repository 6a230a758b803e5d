"""Text, JSON and casting helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(column: Column | str) -> Column:
    """Text to double; anything that is no number becomes NULL (also under ANSI)."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("double")


def text(column: Column | str) -> Column:
    """Trimmed text; NULL becomes the empty string, as in a CSV field."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.trim(col.cast("string")), F.lit(""))


def text_json(fields: Iterable[str], first: Mapping[str, Column] | None = None) -> Column:
    """A JSON object whose values are all strings, ``first`` ahead of ``fields``."""
    head = [value.alias(name) for name, value in (first or {}).items()]
    return F.to_json(F.struct(*head, *[text(name).alias(name) for name in fields]))


def json_field(column: Column | str, name: str) -> Column:
    """One top-level field of a JSON text, read by name."""
    return F.get_json_object(column, f"$.{name}")
