"""Numeric features from text cells, and the small maths around predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.functions.text import RATINGS, float_value

RATING_MIN, RATING_MAX = 1, 5


def strip_number(c: Column) -> Column:
    """Keep digits, dots and minus signs; anything but a plain decimal is 0.0."""
    kept = F.regexp_replace(c, r"[^0-9.\-]", "")
    plain = F.coalesce(kept.rlike(r"\A-?[0-9]+(?:\.[0-9]+)?\z"), F.lit(False))
    return F.when(plain, kept.try_cast("double")).otherwise(F.lit(0.0))


def coerce_number(c: Column) -> Column:
    """Keep digits, dots, minus signs and backslashes; what does not parse is 0.0.  Plain
    numbers, dollar signs in front of them or not, need no replacing."""
    plain = r"\A-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"
    bare, kept = F.ltrim(c, F.lit("$")), F.regexp_replace(c, r"[^0-9.\-\\]", "")
    return F.coalesce(
        F.when(bare.rlike(plain), bare).when(kept.rlike(plain), kept).try_cast("double"),
        F.lit(0.0),
    )


def parse_number(c: Column) -> Column:
    """Read the whole number first (``1.58E+12``), strip stray characters only then."""
    value = F.nanvl(float_value(c), F.lit(None).cast("double"))
    return F.coalesce(value, strip_number(c))


def encode_true(c: Column) -> Column:
    """1.0 for TRUE in any case, else 0.0."""
    return F.when(F.upper(c) == "TRUE", F.lit(1.0)).otherwise(F.lit(0.0))


def parse_rating(c: Column) -> Column:
    """Rating 1..5 as a double (``4.0`` counts), else NULL; plain ones need no pattern."""
    kept = F.regexp_replace(c, r"[^0-9.]", "")
    text = F.when(c.isin(*RATINGS), c).when(kept.rlike(r"\A[1-5](?:\.0+)?\z"), kept)
    return text.try_cast("double")


def clip(c: Column, low: float = RATING_MIN, high: float = RATING_MAX) -> Column:
    """Bound a numeric column."""
    kind = "double" if isinstance(low, float) else None
    lo, hi = F.lit(low), F.lit(high)
    if kind:
        lo, hi = lo.cast(kind), hi.cast(kind)
    return F.least(F.greatest(c, lo), hi)


def clip_rating(c: Column) -> Column:
    """Predicted rating bound to 1.0..5.0."""
    return clip(c, float(RATING_MIN), float(RATING_MAX))


def whole_rating(c: Column) -> Column:
    """Nearest whole rating, halves to the even side, bound to 1..5."""
    return clip(F.rint(c).cast("int"))
