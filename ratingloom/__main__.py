"""Jobs for ``spark-submit``: ``python -m ratingloom <job> ...``.

  clean  KIND RAW OUT            raw text -> OUT, OUT_corrupted   (KIND: train, predict, product)
  merge  REVIEWS PRODUCTS OUT    clean tables -> merged table; --models M saves the text
                                 models of a training run, --reuse applies saved ones
  train  MERGED MODEL            merged table -> model; --report R
  score  MERGED MODEL OUT        merged table -> OUT/predictions_float, OUT/predictions_int;
                                 --report R

Tables between jobs are Parquet, or CSV with ``--csv``: ``clean`` then writes it, ``merge`` reads
and writes it, ``train`` and ``score`` read it.  Either way rows keep their file order.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ratingloom.operators.mlp import TrainConfig
from ratingloom.plans.cleaning import clean_file
from ratingloom.plans.merging import merge_with_embeddings
from ratingloom.plans.scoring import run_scoring
from ratingloom.plans.training import RatingModel, train_ratings
from ratingloom.sinks.tables import write_cleaning, write_merged
from ratingloom.sources.csv_tables import scan_clean, scan_merged
from ratingloom.sources.schema_file import PREDICT, PRODUCT, TRAIN, read_layout

_LAYOUTS = {layout.kind: layout for layout in (TRAIN, PREDICT, PRODUCT)}


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = _LAYOUTS[args.kind]
    if args.schema:
        layout = read_layout(spark, args.schema, layout)
    run = clean_file(spark, args.raw, layout, check_header=args.check_header)
    write_cleaning(run, args.out, "csv" if args.csv else "parquet", not args.no_quarantine)
    print(run.summary.first().asDict())


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews, products = (
        scan_clean(spark, path, pos=True) if args.csv else spark.read.parquet(path)
        for path in (args.reviews, args.products)
    )
    merged, fitted = merge_with_embeddings(reviews, products, saved=args.models if args.reuse else None)
    if args.models and not args.reuse:
        fitted.save(args.models)
    write_merged(merged, args.out, "csv" if args.csv else "parquet")


def _merged(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return scan_merged(spark, args.merged, pos=True) if args.csv else spark.read.parquet(args.merged)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    config = TrainConfig(
        epochs=args.epochs,
        batch_size=args.batch_size,
        lr=args.lr,
        weight_decay=args.weight_decay,
        early_stopping_patience=args.patience,
    )
    run = train_ratings(_merged(spark, args), args.algo, config, report_path=args.report)
    run.model.save(args.model)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    model = RatingModel.load(args.model)
    run_scoring(_merged(spark, args), model, args.out, args.report)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        prog="ratingloom", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    jobs = parser.add_subparsers(required=True)

    def job(fn, *names: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(fn.__name__)
        sub.set_defaults(job=fn)
        for name in names:
            sub.add_argument(name)
        return sub

    sub = job(clean)
    sub.add_argument("kind", choices=sorted(_LAYOUTS))
    for name in ("raw", "out"):
        sub.add_argument(name)
    sub.add_argument("--schema")
    sub.add_argument("--csv", action="store_true")
    sub.add_argument("--no-quarantine", action="store_true")
    sub.add_argument("--check-header", action="store_true")
    sub = job(merge, "reviews", "products", "out")
    sub.add_argument("--models")
    sub.add_argument("--reuse", action="store_true")
    sub.add_argument("--csv", action="store_true")
    sub = job(train, "merged", "model")
    sub.add_argument("--csv", action="store_true")
    sub.add_argument("--report")
    sub.add_argument("--algo", default="mlp")
    sub.add_argument("--epochs", type=int, default=50)
    sub.add_argument("--batch-size", type=int, default=256)
    sub.add_argument("--lr", type=float, default=1e-3)
    sub.add_argument("--weight-decay", type=float, default=1e-6)
    sub.add_argument("--patience", type=int, default=10)
    sub = job(score, "merged", "model", "out")
    sub.add_argument("--csv", action="store_true")
    sub.add_argument("--report")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.job(spark or SparkSession.builder.appName("ratingloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
