"""Scoring run: merged rows and a model to predictions and their analysis."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage_observed
from ratingloom.operators.features import require_embeddings, with_row_ids
from ratingloom.operators.regress import score_ratings, whole_ratings
from ratingloom.operators.reports import prediction_distribution, prediction_stats, throughput
from ratingloom.plans.training import RatingModel
from ratingloom.sinks.tables import report_rows, write_predictions, write_report


def score_reviews(
    merged: DataFrame, model: RatingModel, order: Sequence[str] | None = None
) -> DataFrame:
    """``id, rating`` for every merged row, ratings in 1.0..5.0.

    Rows without an ``id`` column are numbered in file order, by ``pos``; without that
    either by ``order`` (all columns by default).
    """
    if model.texts:
        require_embeddings(merged.columns, model.texts)
    rows = with_row_ids(merged, order or merged.columns)
    scored = score_ratings(model.features(rows, keep=("id",)), model.regressor)
    return scored.withColumn("id", F.col("id").try_cast("bigint"))


def prediction_report(scored: DataFrame) -> DataFrame:
    """Analysis of whole-number predictions as report rows."""
    whole = whole_ratings(scored)
    return report_rows(prediction_stats(whole), "prediction_analysis").unionByName(
        report_rows(prediction_distribution(whole), "prediction_analysis", "rating")
    )


def run_scoring(
    merged: DataFrame,
    model: RatingModel,
    out_path: str,
    report_path: str | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Score, write both prediction tables, replace the report's scoring sections."""
    began = time.perf_counter()
    scored, figures = stage_observed(score_reviews(merged, model), "scored", records=F.count("*"))
    seconds = time.perf_counter() - began
    write_predictions(scored, out_path, fmt)
    if report_path:
        spark = merged.sparkSession
        rates = report_rows(throughput(spark, figures["records"], seconds), "inference")
        write_report(prediction_report(scored).unionByName(rates), report_path)
    return scored
