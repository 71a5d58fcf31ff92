"""Embedding, fitting and scoring queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.joining import merged_numbers, products, reviews
from queries.numbers import _SCALARS, scalar_features
from queries.registry import query
from queries.views import SQL, table, view
from ratingloom.checkpoints import scratch_path, stage
from ratingloom.functions.numbers import encode_true
from ratingloom.operators.embed import (
    Compressor,
    column_means,
    encode_text,
    encode_with_model,
    expand_embedding,
    fit_compressor,
    fit_encoder,
)
from ratingloom.operators.position import order_position
from ratingloom.operators.regress import (
    epoch_table,
    evaluate,
    fit_regressor,
    load_regressor,
    save_regressor,
    score_ratings,
)
from ratingloom.operators.split import train_val_split
from ratingloom.plans.merging import merge_with_embeddings
from ratingloom.plans.scoring import score_reviews
from ratingloom.plans.training import train_ratings

DIM = 64  # width of the given embeddings


@query(
    "embedding_center",
    """select cast(pos as int) as pos, round(avg(v), 5) as mean from (
  select unnest(range(64)) as pos, unnest(embedding)::double as v from embeddings) e group by pos""",
)
def embedding_center(spark, sf_dir):
    means = column_means(table(spark, sf_dir, "embeddings"), "embedding")
    return means.select("pos", F.round("mean", 5).alias("mean"))


@query(
    "embedding_expand",
    "select vec_id, "
    + ", ".join(
        f"round_even(embedding[{i + 1}]::double, 6) as vec_emb_{i}" for i in range(DIM)
    )
    + " from embeddings",
)
def embedding_expand(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return expand_embedding(rows, "embedding", "vec", DIM)


def _compressed(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    path = scratch_path(spark, "compressor")
    fit_compressor(rows, "embedding", method=method).save(path)
    model = Compressor.load(path)
    return expand_embedding(model.apply(rows), "embedding", "vec", model.dim)


@query("pca_compress")
def pca_compress(spark, sf_dir):
    return _compressed(spark, sf_dir, "pca")


@query("random_project")
def random_project(spark, sf_dir):
    return _compressed(spark, sf_dir, "random")


@query("text_embed")
def text_embed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoder = fit_encoder(docs, "text")
    vectors = encode_text(docs, encoder, "text")
    rows = stage(vectors.select("doc_id", "text_vec"), "text-vectors")
    model = fit_compressor(rows, "text_vec")
    return expand_embedding(model.apply(rows), "text_vec", "text", model.dim)


@query("merge_with_text")
def merge_with_text(spark, sf_dir):
    done, _ = merge_with_embeddings(reviews(spark, sf_dir), products(spark, sf_dir))
    return done


# --- regressors -----------------------------------------------------------------------

def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of all merged reviews, made and written once: a range sort reads its rows
    for its bounds too."""
    features = stage(scalar_features(spark, sf_dir), "features")
    return order_position(features, ["id", *_SCALARS, "label"])


def _sides(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows.  The side is written with the numbers that are fitted:
    a fit passes over them many times and hashes no row again."""
    done = stage(train_val_split(frame).select(*_SCALARS, "label", "is_train"), "sides")
    return (
        done.filter("is_train").drop("is_train"),
        done.filter(~F.col("is_train")).drop("is_train"),
    )


def _fitted(spark: SparkSession, sf_dir: str, algo: str, **params) -> DataFrame:
    train, val = _sides(_ordered(spark, sf_dir))
    model = fit_regressor(train, val, _SCALARS, algo=algo, **params)
    return evaluate(val, model)


@query("fit_linear")
def fit_linear(spark, sf_dir):
    return _fitted(spark, sf_dir, "linear")


@query("fit_gbt")
def fit_gbt(spark, sf_dir):
    return _fitted(spark, sf_dir, "gbt")


@query("fit_forest")
def fit_forest(spark, sf_dir):
    return _fitted(spark, sf_dir, "forest")


@query("fit_mlp")
def fit_mlp_query(spark, sf_dir):
    return _fitted(spark, sf_dir, "mlp")


@query("epoch_stats")
def epoch_stats(spark, sf_dir):
    train, val = _sides(_ordered(spark, sf_dir))
    model = fit_regressor(train, val, _SCALARS, algo="mlp")
    return epoch_table(spark, model)


@query("score_reviews")
def score_saved(spark, sf_dir):
    """Train on the merged reviews, save, load, score them all."""
    rows = _ordered(spark, sf_dir)
    train, val = _sides(rows)
    path = scratch_path(spark, "regressor")
    save_regressor(fit_regressor(train, val, _SCALARS, algo="mlp"), path)
    return score_ratings(rows, load_regressor(path))


@query("train_and_score")
def train_and_score(spark, sf_dir):
    """Merged reviews through training and scoring, dictionaries included."""
    rows = stage(merged_numbers(spark, sf_dir), "merged")
    run = train_ratings(rows, algo="linear", texts=(), order=rows.columns)
    return score_reviews(rows, run.model)


# --- models whose results SQL can tell ----------------------------------------------------

_PLANTED = "0.5 + 0.01 * votes + 1.25 * purchased"


@query(
    "planted_linear",
    f"""select id, round(greatest(1.0, least(5.0, 0.5 + 0.01 * votes + 1.25 * purchased)), 4) as rating
from (select id, cast(votes as double) as votes,
  case when upper(trim(purchased)) = 'TRUE' then 1.0 else 0.0 end as purchased
  from ({SQL["reviews"]}) r) p""",
)
def planted_linear(spark, sf_dir):
    """A label that is a formula: fitted on the training rows, saved, loaded, scored, bound."""
    rows = view(spark, sf_dir, "reviews").select(
        "id",
        F.col("votes").cast("double").alias("votes"),
        encode_true(F.col("purchased")).cast("double").alias("purchased"),
    )
    rows = rows.withColumn("label", F.expr(_PLANTED))
    path = scratch_path(spark, "planted")
    save_regressor(fit_regressor(rows, rows, ["votes", "purchased"], algo="linear"), path)
    scored = score_ratings(rows, load_regressor(path))
    return scored.select("id", F.round("rating", 4).alias("rating"))


@query(
    "own_encoder",
    """select doc_id, cast(length(coalesce(text, '')) as double) as n_chars,
  cast(length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')) as double) as n_e
from documents""",
)
def own_encoder(spark, sf_dir):
    """A user's own sentence model beside the text column."""

    def load():
        return lambda texts: np.array([[len(t), t.count("e")] for t in texts], dtype=float)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = encode_with_model(docs, "text", load).select("doc_id", vector_to_array("text_vec").alias("v"))
    return vectors.select("doc_id", F.col("v")[0].alias("n_chars"), F.col("v")[1].alias("n_e"))


@query(
    "full_width_distance",
    """with m as (select pos, avg(v) as mean from (
  select unnest(range(64)) as pos, unnest(embedding)::double as v from embeddings) e group by pos)
select vec_id, round(sum((v - mean) * (v - mean)), 3) as distance from (
  select vec_id, unnest(range(64)) as pos, unnest(embedding)::double as v from embeddings) e
join m using (pos) group by vec_id""",
)
def full_width_distance(spark, sf_dir):
    """All components together keep each row's squared distance from the mean."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    path = scratch_path(spark, "compressor")
    fit_compressor(rows, "embedding", DIM).save(path)
    short = Compressor.load(path).apply(rows)
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    return short.select("vec_id", F.round(squares, 3).alias("distance"))
