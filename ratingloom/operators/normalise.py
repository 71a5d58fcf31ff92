"""Harmless defects of valid rows: control characters, blanks, negative counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.text import (
    default_na,
    integer_text,
    is_integer,
    is_negative,
    is_rating,
    sanitise,
)
from ratingloom.sources.schema_file import Layout


def clamp_negative(c: Column) -> Column:
    """Negative whole numbers become ``0``; any other text is kept as it is."""
    return F.when(is_negative(c), F.lit("0")).otherwise(c)


def clamp_rating(c: Column) -> Column:
    """Whole numbers below 1 become ``1``, above 5 ``5``; other text is kept."""
    low = is_negative(c) | (integer_text(c) == "0")
    return (
        F.when(is_rating(c) | ~is_integer(c), c).when(low, F.lit("1")).otherwise(F.lit("5"))
    )


def normalise(df: DataFrame, layout: Layout) -> DataFrame:
    """Defaults, clean text and clamped counts on the layout's columns.

    Reviews get their default before control characters go, products after: a
    product title of nothing but control characters is ``NA``, such a comment a blank.
    """
    changes: dict[str, Column] = {}
    product = layout.kind == "product"
    for f in layout.fields:
        c = F.col(f)
        if f in layout.optional and not product:
            c = default_na(c)
        if f in layout.sanitised:
            c = sanitise(c)
        if f in layout.optional and product:
            c = default_na(c)
        if f in ("votes", "rating_number"):
            c = clamp_negative(c)
        if f == "rating":
            c = clamp_rating(c)
        changes[f] = c
    return df.withColumns(changes)
