"""Null semantics: unset is NULL, an explicit zero or empty value is a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_to_null(text: Column) -> Column:
    """Empty string to NULL, for the few identifiers where empty means unset."""
    return F.nullif(text, F.lit(""))


def list_or_empty(items: Column, element: T.DataType) -> Column:
    """A list that is never NULL: none reads as the empty list."""
    return F.coalesce(items, F.array().cast(T.ArrayType(element)))


def first_text(translations: Column) -> Column:
    """One text of a list of ``(text, language)``.

    The first without a language tag wins, else the first of all; NULL for an empty or
    missing list.
    """
    untagged = F.filter(
        translations, lambda t: t["language"].isNull() | (t["language"] == F.lit(""))
    )
    return F.coalesce(F.get(untagged, F.lit(0)), F.get(translations, F.lit(0)))["text"]
