"""Shapes of physical plans that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from queries.joining import products, reviews
from queries.views import view
from ratingloom.functions.cells import csv_cells
from ratingloom.operators import lookup
from ratingloom.operators.normalise import normalise
from ratingloom.operators.position import number_rows
from ratingloom.operators.products import first_seen, lookup_products, merged_projection
from ratingloom.operators.repair import repair_reviews
from ratingloom.operators.split import train_val_split
from ratingloom.operators.validate import clean_rows
from ratingloom.plans.cleaning import check_rows
from ratingloom.sources.raw_text import frame_records, scan_lines
from ratingloom.sources.schema_file import TRAIN


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans"))
    view(spark, small, "records").select("record").write.text(f"{path}/raw")
    rows = view(spark, small, "dirty").select(*TRAIN.fields)
    rows.withColumn("pos", F.monotonically_increasing_id()).write.parquet(f"{path}/dirty")
    products(spark, small).write.parquet(f"{path}/products")
    return path


def test_cleaning_is_one_narrow_jvm_stage(spark, staged):
    cells = spark.read.text(f"{staged}/raw").select(csv_cells(F.col("value")).alias("cells"))
    done = normalise(clean_rows(check_rows(repair_reviews(cells, TRAIN), TRAIN)), TRAIN)
    text = plan(done)
    assert "Exchange" not in text and "Python" not in text
    assert len(text) < 400_000  # a filter pushed through the repair rules would explode


def test_framing_shuffles_only_continuation_lines(spark, staged):
    lines = scan_lines(spark, f"{staged}/raw")
    text = plan(frame_records(lines, header=False))
    assert "Python" not in text
    assert "hashpartitioning" not in text and "SinglePartition" not in text
    assert "BroadcastHashJoin" in text


def test_numbering_has_no_single_task_over_rows(spark, staged):
    rows = spark.read.parquet(f"{staged}/dirty").select("pos")
    text = plan(number_rows(rows, "n"))
    # the one unpartitioned window adds up groups of runs, not rows
    for block in text.split("Exchange SinglePartition")[1:]:
        assert "_group" in block.splitlines()[1]
    assert text.count("Exchange SinglePartition") <= 1


def test_split_moves_no_rows(spark, staged):
    rows = spark.read.parquet(f"{staged}/dirty")
    assert "Exchange" not in plan(train_val_split(rows))


def test_lookup_prunes_and_broadcasts_small_products(spark, staged):
    left = spark.read.parquet(f"{staged}/dirty")
    right = first_seen(spark.read.parquet(f"{staged}/products"))
    text = plan(merged_projection(lookup_products(left, right)))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    reads = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert any("votes" in r for r in reads)
    assert not any("comment" in r or "features" in r for r in reads)


def test_lookup_beyond_the_bound_shuffles(spark, staged):
    left = spark.read.parquet(f"{staged}/dirty")
    right = first_seen(spark.read.parquet(f"{staged}/products"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup_products(left, right, limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2 and "_salt" in text


def test_measured_bytes_bounds_the_frame(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert 100_000 < lookup.measured_bytes(df) < 300_000
    assert lookup.fits_broadcast(df) and not lookup.fits_broadcast(df, 1000)
    assert lookup.measured_bytes(df.limit(0)) == 0


def test_reviews_view_covers_every_line(spark, small):
    assert reviews(spark, small).count() == spark.read.parquet(f"{small}/lineitem.parquet").count()
