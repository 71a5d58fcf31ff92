"""Merging runs: clean reviews and products to the numeric-plus-category table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.artefacts import load_or, publish, published
from ratingloom.checkpoints import stage
from ratingloom.operators.embed import (
    COMPRESSED_DIM,
    ENCODER_DIM,
    Compressor,
    distinct_texts,
    encode_text,
    expand_embedding,
    fit_compressor,
    fit_encoder,
)
from ratingloom.operators.lookup import BROADCAST_BYTES, unique_lookup
from ratingloom.operators.products import first_seen, lookup_products, merged_inputs, merged_projection

# Text columns in the order their embeddings are written.
WRITTEN_TEXTS = ("title", "comment", "prod_title", "prod_features")
# Texts that many rows share: encoded once for each distinct one.
REPEATED_TEXTS = ("prod_title", "prod_features")
# Bytes of a text, generously, and of one number of its vector where vectors are broadcast.
_TEXT_BYTES, _NUMBER_BYTES = 256, 16


def repeated_texts(df: DataFrame, columns: Sequence[str], dim: int = COMPRESSED_DIM) -> set[str]:
    """Columns whose rows look up the vector of their text: those of products, and others
    that hold so few distinct texts that the vectors of all are small enough to broadcast.

    One pass counts them approximately; on the count depends only which way is taken."""
    others = [c for c in columns if c not in REPEATED_TEXTS]
    repeated = set(columns) - set(others)
    if others:
        found = df.agg(*[F.approx_count_distinct(c).alias(c) for c in others]).first()
        limit = BROADCAST_BYTES // (_TEXT_BYTES + _NUMBER_BYTES * dim)
        repeated |= {c for c in others if found[c] <= limit // 2}
    return repeated


class TextModels:
    """Encoder and compressor per text column, saved side by side."""

    def __init__(self, models: dict[str, tuple[PipelineModel, Compressor]]):
        self.models = models

    def save(self, path: str) -> None:
        publish(path, self._write)

    def _write(self, path: str) -> None:
        for column, (encoder, compressor) in self.models.items():
            encoder.write().overwrite().save(f"{path}/{column}/encoder")
            compressor.write(f"{path}/{column}/compressor")

    @staticmethod
    def load(path: str, columns: Sequence[str] = WRITTEN_TEXTS) -> TextModels:
        folder = published(path)
        return TextModels(
            {
                c: (
                    PipelineModel.load(f"{folder}/{c}/encoder"),
                    Compressor.read(f"{folder}/{c}/compressor"),
                )
                for c in columns
            }
        )

    def apply(self, df: DataFrame, keep_text: bool = False) -> DataFrame:
        """Add ``<column>_emb_<i>`` columns; the texts go unless kept.

        A text that many rows share is encoded and rounded once, and its numbers looked up.
        """
        dim = max((c.dim for _, c in self.models.values()), default=0)
        repeated = repeated_texts(df, list(self.models), dim)
        for column, (encoder, compressor) in self.models.items():
            vector = f"{column}_vec"
            if column in repeated:
                texts = distinct_texts(df, column).drop("weight")
                short = compressor.apply(encode_text(texts, encoder, column), vector)
                short = short.select(F.col(column).alias("_text"), vector)
                short = stage(expand_embedding(short, vector, column, compressor.dim), f"short-{column}")
                df = df.withColumn(column, F.coalesce(column, F.lit("")))
                df = unique_lookup(df, short, column, "_text").drop("_text")
            else:
                df = compressor.apply(encode_text(df, encoder, column), vector)
                df = expand_embedding(df, vector, column, compressor.dim)
        return df if keep_text else df.drop(*self.models)


def fit_text_models(
    df: DataFrame,
    columns: Sequence[str] = WRITTEN_TEXTS,
    k: int = COMPRESSED_DIM,
    dim: int = ENCODER_DIM,
    method: str = "pca",
) -> TextModels:
    """Fit on the text columns present, as the rows of the merged table count: a text that
    many rows share weighs as much as they do, but is encoded once."""
    models = {}
    columns = [c for c in columns if c in df.columns]
    shared = repeated_texts(df, columns)
    for column in columns:
        repeated = column in shared
        texts = stage(distinct_texts(df, column), f"texts-{column}") if repeated else df.select(column)
        weight = "weight" if repeated else None
        encoder = fit_encoder(texts, column, dim=dim, weight=weight)
        vector = f"{column}_vec"
        encoded = encode_text(texts, encoder, column).select(vector, *([weight] if weight else []))
        vectors = stage(encoded, f"vec-{column}")
        models[column] = (encoder, fit_compressor(vectors, vector, k, method, weight=weight))
    return TextModels(models)


def merge_products(reviews: DataFrame, products: DataFrame, miss: str = "na") -> DataFrame:
    """Clean reviews with the ``prod_*`` columns of their product.

    ``products`` are clean products with their ``pos``; the first of a key counts.
    """
    return lookup_products(reviews, first_seen(products), miss)


def merge_numbers(reviews: DataFrame, products: DataFrame, miss: str = "na") -> DataFrame:
    """``merged_projection`` of ``merge_products``.  What it drops is left out ahead of the
    lookup, whose exchanges and cuts would else carry the texts of all reviews."""
    return merged_projection(merge_products(*merged_inputs(reviews, products), miss))


def merge_with_embeddings(
    reviews: DataFrame,
    products: DataFrame,
    models: TextModels | None = None,
    saved: str | None = None,
) -> tuple[DataFrame, TextModels]:
    """Merged table with embedding columns, and the models behind them.

    A prediction run passes the ``models`` of the training run, or where they are
    ``saved``.  Without either, or where what was saved is absent or broken (a warning says
    so), they are fitted on these rows.
    """
    merged = stage(merge_products(reviews, products), "merged")
    if models is None and saved is not None:
        models = load_or(lambda: TextModels.load(saved), lambda: fit_text_models(merged))
    models = models or fit_text_models(merged)
    return merged_projection(models.apply(merged)), models
