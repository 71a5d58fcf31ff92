"""Numeric features: category codes, scaling, the labelled feature frame."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ratingloom.checkpoints import stage
from ratingloom.functions.numbers import (
    coerce_number,
    encode_true,
    parse_number,
    parse_rating,
    strip_number,
)
from ratingloom.operators.lookup import fits_broadcast, unique_lookup
from ratingloom.operators.position import POS, number_rows, order_position, row_position

# Feature columns ahead of the embeddings, in model order.
BASE = ("votes", "purchased", "time")
PRODUCT_NUMBERS = ("prod_price", "prod_rating_number")
PRODUCT_CATEGORIES = ("prod_main_category", "prod_store")
TEXT_COLUMNS = ("comment", "title", "prod_title", "prod_features")
LABEL = "label"
UNSEEN = -1.0

_EMBEDDING = re.compile(r"_emb_(\d+)$")


def is_embedding_column(name: str) -> bool:
    return _EMBEDDING.search(name) is not None


def embedding_columns(columns: Sequence[str], texts: Sequence[str] = TEXT_COLUMNS) -> list[str]:
    """``<text>_emb_<i>`` columns, text by text, sorted by ``i`` as a number."""
    found: list[str] = []
    for text in texts:
        own = [c for c in columns if re.fullmatch(rf"{re.escape(text)}_emb_\d+", c)]
        found += sorted(own, key=lambda c: int(_EMBEDDING.search(c)[1]))
    return found


def feature_columns(columns: Sequence[str], texts: Sequence[str] = TEXT_COLUMNS) -> list[str]:
    """The one feature order, for training and scoring alike."""
    present = [c for c in (*PRODUCT_NUMBERS, *PRODUCT_CATEGORIES) if c in columns]
    return [*BASE, *present, *embedding_columns(columns, texts)]


def require_embeddings(columns: Sequence[str], texts: Sequence[str] = TEXT_COLUMNS) -> None:
    """All text columns must have embedding columns."""
    missing = [t for t in texts if not embedding_columns(columns, [t])]
    if missing:
        raise ValueError(f"Missing required embedding columns for: {missing}")


def require_ratings(df: DataFrame, rating: str = LABEL) -> None:
    """There must be rows, and each must hold a valid rating."""
    n, bad = df.agg(F.count("*"), F.count_if(F.col(rating).isNull())).first()
    if n == 0:
        raise ValueError("Empty data set")
    if bad:
        raise ValueError(f"Found {bad} rows with a missing or invalid rating")


def na_to_null(df: DataFrame) -> DataFrame:
    """The placeholder ``NA`` in the merged text columns means no value."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    used = [c for c in (*BASE, *PRODUCT_NUMBERS, *PRODUCT_CATEGORIES, "rating") if c in text]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("NA")) for c in used})


def category_codes(df: DataFrame, column: str, code: str | None = None) -> DataFrame:
    """Dictionary ``column, code``: index among the sorted distinct values, NULL as
    the empty string.

    The distinct values are written once.  Measured small, they are numbered by one
    window; otherwise by a range-partitioned sort.
    """
    value = F.coalesce(F.col(column), F.lit("")).alias(column)
    values = stage(df.select(value).distinct(), f"values-{column}")
    code = code or f"{column}_code"
    if fits_broadcast(values):
        number = F.row_number().over(Window.orderBy(column)) - 1
        return values.select(column, number.cast("double").alias(code))
    coded = stage(number_rows(order_position(values, [column]), "_no"), f"codes-{column}")
    return coded.select(column, F.col("_no").cast("double").alias(code))


def fit_categories(
    df: DataFrame, columns: Sequence[str] = PRODUCT_CATEGORIES
) -> dict[str, DataFrame]:
    """A dictionary frame ``<column>, <column>_code`` per column present."""
    df = na_to_null(df)
    return {c: category_codes(df, c) for c in columns if c in df.columns}


def apply_categories(df: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Replace each column by its code, -1 for values the dictionary lacks."""
    for column, codes in dictionaries.items():
        side = codes.select(F.col(column).alias("_value"), F.col(codes.columns[1]).alias("_code"))
        filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("")))
        df = (
            unique_lookup(filled, side, column, "_value")
            .withColumn(column, F.coalesce("_code", F.lit(UNSEEN)))
            .drop("_value", "_code")
        )
    return df


def numeric_core(df: DataFrame, parse_first: bool = True) -> dict[str, Column]:
    """Expressions for the numeric columns present.

    ``parse_first`` reads ``1.58E+12`` as one number; without it votes and time only
    keep their digits, dots and minus signs.
    """
    number = parse_number if parse_first else strip_number
    exprs: dict[str, Column] = {
        "votes": number(F.col("votes")),
        "purchased": encode_true(F.col("purchased")),
        "time": number(F.col("time")),
    }
    for c in PRODUCT_NUMBERS:
        if c in df.columns:
            exprs[c] = coerce_number(F.col(c))
    return exprs


def feature_frame(
    merged: DataFrame,
    dictionaries: dict[str, DataFrame],
    texts: Sequence[str] = TEXT_COLUMNS,
    parse_first: bool = True,
    keep: Sequence[str] = (),
    as_float: bool = False,
) -> DataFrame:
    """Numeric features in model order from merged rows, plus ``label`` when rated.

    ``NA`` counts as NULL, NULLs become 0.0.  ``keep`` names further columns to carry (an id, a position);
    ``as_float`` narrows the features to 32 bits.
    """
    merged = na_to_null(merged)
    order = feature_columns(merged.columns, texts)
    exprs = numeric_core(merged, parse_first)
    for c in embedding_columns(merged.columns, texts):
        exprs[c] = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    used = {c: d for c, d in dictionaries.items() if c in order}
    coded = apply_categories(merged, used)
    label = [parse_rating(F.col("rating")).alias(LABEL)] if "rating" in merged.columns else []
    kind = "float" if as_float else "double"
    return coded.select(
        *keep,
        *[exprs.get(c, F.col(c)).cast(kind).alias(c) for c in order],
        *label,
    )


def with_row_ids(df: DataFrame, order: Sequence[str | Column], name: str = "id") -> DataFrame:
    """Rows that come without an id are numbered 0, 1, 2, ... in file order (``pos``), or
    in ``order`` where they have no position either."""
    if name in df.columns:
        return df
    return number_rows(df, name) if POS in df.columns else row_position(df, order, name)


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table ``feature, mean, sd`` with the population SD, 0 replaced by 1."""
    one = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"m{i}").alias("mean"),
                F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("sd"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select(F.inline(entries))


def standardise(
    df: DataFrame, columns: Sequence[str], scaler: Sequence[tuple[float, float]]
) -> DataFrame:
    """``(value - mean) / sd`` with fitted statistics, one pair per column."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, (m, s) in zip(columns, scaler)}
    )


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]]:
    """Fitted ``(mean, sd)`` per column; as many numbers as there are features."""
    found = {r["feature"]: (r["mean"], r["sd"]) for r in feature_stats(df, columns).collect()}
    return [found[c] for c in columns]
