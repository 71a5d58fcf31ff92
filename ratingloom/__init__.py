"""Cleaning of product reviews and scoring of ratings, as Spark jobs."""

from ratingloom.functions.cells import csv_cells
from ratingloom.operators.embed import (
    Compressor,
    encode_with_model,
    fit_compressor,
    fit_encoder,
    load_or_fit,
)
from ratingloom.operators.features import (
    feature_columns,
    feature_frame,
    fit_categories,
    fit_scaler,
    standardise,
)
from ratingloom.operators.ids import reassign_duplicate_ids
from ratingloom.operators.mlp import TrainConfig
from ratingloom.operators.normalise import normalise
from ratingloom.operators.position import file_position, number_rows, order_position
from ratingloom.operators.products import first_seen, lookup_products, merged_projection
from ratingloom.operators.regress import fit_regressor, load_regressor, save_regressor
from ratingloom.operators.repair import repair_reviews
from ratingloom.operators.split import train_val_split
from ratingloom.operators.validate import validate
from ratingloom.plans.cleaning import clean_file, clean_frame, strict_rows
from ratingloom.plans.merging import (
    TextModels,
    fit_text_models,
    merge_products,
    merge_with_embeddings,
)
from ratingloom.plans.scoring import prediction_report, run_scoring, score_reviews
from ratingloom.plans.training import RatingModel, label_report, train_ratings
from ratingloom.sources.csv_tables import scan_clean, scan_merged, scan_strict
from ratingloom.sources.raw_text import frame_records, line_records, scan_lines
from ratingloom.sources.schema_file import PREDICT, PRODUCT, TRAIN, read_fields, read_layout

__all__ = [name for name in dir() if not name.startswith("_")]
