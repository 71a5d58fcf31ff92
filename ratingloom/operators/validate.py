"""Validation: every row gets the list of reasons why it is corrupt, or none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.text import (
    BLANK_RANGES,
    is_blank,
    is_integer,
    is_rating,
    is_true_false,
    sanitise,
)
from ratingloom.operators.once import computed_once
from ratingloom.sources.schema_file import Layout

REASONS = "corruption_reasons"

# First letter of each identifier, 16 letters or digits behind ``_``.
_ID_LETTERS = {"user_id": "u", "prod_id": "a", "parent_prod_id": "a"}


def arity_reason(n_cells: Column, size: int) -> Column:
    """Too few or too many cells, else NULL."""
    return F.when(n_cells < size, F.lit("missing attribute")).when(
        n_cells > size, F.lit("extra attribute")
    )


def missing_reason(layout: Layout) -> Column:
    """The first required column that is blank, else NULL."""
    tests = [
        F.when(is_blank(F.col(f)), F.lit(f"{f} missing attribute"))
        for f in layout.fields
        if f not in layout.optional
    ]
    return F.coalesce(*tests)


def malformed_reason(name: str) -> Column:
    shape = rf"\A[{BLANK_RANGES}]*{_ID_LETTERS[name]}_[A-Za-z0-9]{{16}}[{BLANK_RANGES}]*\z"
    good = F.coalesce(F.col(name).rlike(shape), F.lit(False))
    return F.when(~good, F.lit(f"{name} malformed"))


def integer_reason(name: str) -> Column:
    return F.when(~is_integer(F.col(name)), F.lit(f"{name} not integer"))


def purchased_reason() -> Column:
    c = F.col("purchased")
    # sanitising turns control characters to blanks, so it can only matter to odd text
    good = is_true_false(c) | is_true_false(sanitise(c))
    return F.when(~good, F.lit("purchased malformed"))


def rating_reason() -> Column:
    c = F.col("rating")
    return F.when(is_rating(c), F.lit(None)).when(
        is_integer(c), F.lit("rating out of range")
    ).otherwise(F.lit("rating not integer"))


def _content_reasons(layout: Layout) -> list[Column]:
    if layout.kind == "product":
        return [
            integer_reason("id"),
            malformed_reason("parent_prod_id"),
            integer_reason("rating_number"),
        ]
    found = [malformed_reason(f) for f in ("user_id", "prod_id", "parent_prod_id")]
    found += [integer_reason("votes"), purchased_reason()]
    return found + ([rating_reason()] if layout.has_rating else [])


def _stops(
    layout: Layout, n_cells: Column | None, extra_columns: Column | None
) -> list[Column]:
    """Reasons that end the check: unexpected columns, a wrong cell count, a blank value."""
    stops = []
    if extra_columns is not None:
        stops.append(F.when(extra_columns, F.lit("extra attribute")))
    if n_cells is not None:
        stops.append(arity_reason(n_cells, layout.size))
    return [*stops, missing_reason(layout)]


# Between reasons while they are one text; no reason holds it.
_BETWEEN = "\x1f"


# Tests on content that share a step with those that end the check.
_EARLY = 3


def _with_reasons(
    df: DataFrame,
    layout: Layout,
    n_cells: Column | None = None,
    extra_columns: Column | None = None,
    check_id: bool = False,
) -> DataFrame:
    """Add the ``ArrayType(StringType)`` of reasons, empty for a valid row.

    A wrong cell count, an unexpected column or a blank required value ends the
    check; everything else accumulates in column order.  ``check_id`` adds the test that
    an otherwise valid row's id is a whole number.  Every test runs once, in one of three
    steps, and all of it is generated code.
    """
    tests = _content_reasons(layout)
    stops = F.coalesce(*_stops(layout, n_cells, extra_columns))
    early = F.concat_ws(_BETWEEN, *tests[:_EARLY])
    df = computed_once(df.withColumns({"_stop": stops, "_early": early}))
    content = F.concat_ws(_BETWEEN, _unless_empty("_early"), *tests[_EARLY:])
    df = computed_once(df.withColumn("_content", content).drop("_early"))
    text = F.coalesce("_stop", _unless_empty("_content"), *([integer_reason("id")] if check_id else []))
    found = F.coalesce(F.split(text, _BETWEEN), F.array().cast("array<string>"))
    return computed_once(df.withColumn(REASONS, found).drop("_stop", "_content"))


def _unless_empty(name: str) -> Column:
    return F.when(F.col(name) != "", F.col(name))


def unexpected_columns(df: DataFrame, layout: Layout) -> Column | None:
    """Row test for columns outside the layout, for frames read by header name.

    A named stranger spoils every row; a nameless one (``_c<i>``, as the CSV reader
    calls it) only the rows where it holds a value.  NULL column list: no stranger.
    """
    strangers = [c for c in df.columns if c not in layout.fields]
    if not strangers:
        return None
    tests = [
        ~is_blank(F.col(f"`{c}`")) if c == "" or _nameless(c) else F.lit(True)
        for c in strangers
    ]
    return reduce(lambda a, b: a | b, tests)


def _nameless(name: str) -> bool:
    return name.startswith("_c") and name[2:].isdigit()


def validate(
    df: DataFrame,
    layout: Layout,
    n_cells: str | None = None,
    by_name: bool = False,
    check_id: bool = False,
) -> DataFrame:
    """Add the ``corruption_reasons`` column (narrow, no Python).

    ``check_id`` adds the test that an otherwise valid row's id is a whole number.
    """
    extra = unexpected_columns(df, layout) if by_name else None
    cells = F.col(n_cells) if n_cells else None
    return _with_reasons(df, layout, cells, extra, check_id)


def mark_invalid_header(df: DataFrame, header_ok: bool) -> DataFrame:
    """With a header that does not match, every row also has ``invalid header``."""
    if header_ok:
        return df
    return df.withColumn(REASONS, F.concat(F.col(REASONS), F.array(F.lit("invalid header"))))


def is_valid() -> Column:
    return F.size(F.col(REASONS)) == 0


def clean_rows(df: DataFrame) -> DataFrame:
    """Valid rows."""
    return df.filter(is_valid()).drop(REASONS)


def quarantined_rows(df: DataFrame) -> DataFrame:
    """Corrupt rows, reasons joined with ``"; "``."""
    return df.filter(~is_valid()).withColumn(REASONS, F.array_join(REASONS, "; "))


def summary_figures() -> dict[str, Column]:
    """Aggregates of a summary: ``input_rows, clean_rows, corrupted_rows``."""
    return {
        "input_rows": F.count("*"),
        "clean_rows": F.count_if(is_valid()),
        "corrupted_rows": F.count_if(~is_valid()),
    }


def cleaning_summary(df: DataFrame) -> DataFrame:
    """One row: ``input_rows, clean_rows, corrupted_rows``."""
    return df.agg(*[c.alias(k) for k, c in summary_figures().items()])


def reason_counts(df: DataFrame) -> DataFrame:
    """Rows per single reason: ``reason, rows``."""
    return (
        df.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rows"))
    )
