"""Training run: merged rows to a saved model, with metrics and a report."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.artefacts import publish, published
from ratingloom.checkpoints import stage
from ratingloom.operators.features import (
    LABEL,
    TEXT_COLUMNS,
    feature_columns,
    feature_frame,
    fit_categories,
    require_embeddings,
    require_ratings,
)
from ratingloom.operators.mlp import MlpModel, TrainConfig
from ratingloom.operators.position import POS, order_position
from ratingloom.operators.regress import (
    Regressor,
    epoch_table,
    evaluate,
    fit_regressor,
    load_regressor,
    save_regressor,
)
from ratingloom.operators.reports import rating_distribution, rating_stats
from ratingloom.operators.split import train_val_split
from ratingloom.sinks.tables import report_rows, write_report


@dataclass(frozen=True)
class RatingModel:
    """A regressor with the category dictionaries its features were coded by."""

    regressor: Regressor
    dictionaries: dict[str, DataFrame]
    texts: tuple[str, ...] = TEXT_COLUMNS

    def features(self, merged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature frame of merged rows, in the order the model was trained on."""
        frame = feature_frame(merged, self.dictionaries, self.texts, keep=keep)
        missing = [f for f in self.regressor.features if f not in frame.columns]
        if missing:
            raise ValueError(f"Features missing for this model: {missing}")
        return frame

    def save(self, path: str) -> None:
        publish(path, self._write)

    def _write(self, path: str) -> None:
        save_regressor(self.regressor, f"{path}/regressor")
        spark = SparkSession.active()
        texts = spark.createDataFrame([(list(self.texts),)], "texts array<string>")
        texts.write.mode("overwrite").parquet(f"{path}/texts")
        for column, codes in self.dictionaries.items():
            codes.write.mode("overwrite").parquet(f"{path}/categories/{column}")

    @staticmethod
    def load(path: str) -> RatingModel:
        spark, path = SparkSession.active(), published(path)
        texts = spark.read.parquet(f"{path}/texts").first()["texts"]
        regressor = load_regressor(f"{path}/regressor")
        known = [c for c in regressor.features if c in ("prod_main_category", "prod_store")]
        dictionaries = {c: spark.read.parquet(f"{path}/categories/{c}") for c in known}
        return RatingModel(regressor, dictionaries, tuple(texts))


@dataclass(frozen=True)
class TrainingRun:
    model: RatingModel
    train: DataFrame
    val: DataFrame
    report: DataFrame


def label_report(features: DataFrame) -> DataFrame:
    """Rating distribution and statistics as report rows."""
    return report_rows(
        rating_distribution(features, LABEL), "rating_distribution", "rating"
    ).unionByName(report_rows(rating_stats(features, LABEL), "rating_statistics"))


def train_ratings(
    merged: DataFrame,
    algo: str = "mlp",
    config: TrainConfig | None = None,
    texts: Sequence[str] = TEXT_COLUMNS,
    order: Sequence[str] | None = None,
    report_path: str | None = None,
    **params,
) -> TrainingRun:
    """Fit on 80 percent of the merged rows, validate on the rest.

    ``merged`` carries ``id`` and either ``pos`` or the columns of a total ``order``.
    With ``report_path`` the label figures are written before the fit starts, the
    rest after it.
    """
    spark = merged.sparkSession
    began = time.perf_counter()
    if "rating" not in merged.columns:
        raise ValueError("Input has no 'rating' column, which training requires")
    if texts:
        require_embeddings(merged.columns, texts)
    if POS not in merged.columns:
        merged = order_position(merged, order or merged.columns)
    dictionaries = fit_categories(merged)
    features = stage(
        feature_frame(merged, dictionaries, texts, keep=("id", POS)), "features"
    )
    require_ratings(features)
    labels = label_report(features)
    if report_path:
        write_report(labels, report_path, fresh=True)
    preprocessing = time.perf_counter() - began

    began = time.perf_counter()
    split = train_val_split(features, seed=(config or TrainConfig()).seed)
    train = split.filter("is_train").drop("is_train")
    val = split.filter(~F.col("is_train")).drop("is_train")
    names = feature_columns(merged.columns, texts)
    regressor = fit_regressor(train, val, names, LABEL, algo, config, **params)
    training = time.perf_counter() - began

    times = spark.createDataFrame(
        [(preprocessing, training, preprocessing + training)],
        "preprocessing_s double, training_s double, offline_s double",
    )
    report = labels.unionByName(report_rows(times, "times")).unionByName(
        report_rows(evaluate(val, regressor), "validation")
    )
    if isinstance(regressor, MlpModel):
        report = report.unionByName(
            report_rows(epoch_table(spark, regressor), "epochs", "epoch")
        )
    if report_path:
        write_report(report, report_path, fresh=True)
    return TrainingRun(RatingModel(regressor, dictionaries, tuple(texts)), train, val, report)
