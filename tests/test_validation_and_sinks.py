"""Validation by header name, schema files, sinks and streams."""

import re
import sys

import pytest
from pyspark.sql import functions as F

from queries.views import view
from ratingloom.functions.text import BLANK_RANGES, BLANKS
from ratingloom.operators.normalise import clamp_rating, normalise
from ratingloom.operators.validate import (
    REASONS,
    clean_rows,
    mark_invalid_header,
    quarantined_rows,
    validate,
)
from ratingloom.plans.cleaning import check_rows, clean_frame
from ratingloom.sinks.tables import write_cleaning
from ratingloom.sources.csv_tables import scan_clean, scan_merged
from ratingloom.sources.raw_text import header_matches
from ratingloom.sources.schema_file import PREDICT, PRODUCT, TRAIN, read_fields, read_layout
from ratingloom.streaming.cleaning import check_record_stream, write_checked_stream

GOOD = ("1", "u_" + "A" * 16, "a_" + "B" * 16, "a_" + "C" * 16, "T", "C", "1", "1", "TRUE", "5")


def row(**changes):
    return tuple(changes.get(f, v) for f, v in zip(TRAIN.fields, GOOD))


def reasons(spark, rows, layout=TRAIN, **options):
    schema = ", ".join(f"{f} string" for f in layout.fields)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"pos bigint, {schema}")
    return [r[REASONS] for r in validate(df, layout, **options).orderBy("pos").collect()]


def test_reasons(spark):
    cases = {
        (): [],
        (("title", " "), ("votes", "x")): ["title missing attribute"],
        (("user_id", None),): ["user_id missing attribute"],
        (("comment", None),): [],
        (("user_id", "u_1"), ("prod_id", "a_" + "B" * 17), ("parent_prod_id", "A_" + "C" * 16)): [
            "user_id malformed", "prod_id malformed", "parent_prod_id malformed"],
        (("user_id", " u_" + "9" * 16 + "\t"),): [],
        (("votes", "1.0"), ("purchased", "1"), ("rating", "6")): [
            "votes not integer", "purchased malformed", "rating out of range"],
        (("votes", "-3"), ("purchased", " true\x01"), ("rating", " +0_5 ")): [],
        (("rating", "-1"),): ["rating out of range"],
        (("rating", "99999999999999999999"),): ["rating out of range"],
        (("rating", "5.0"),): ["rating not integer"],
    }
    found = reasons(spark, [row(**dict(c)) for c in cases])
    assert found == list(cases.values())
    assert reasons(spark, [row(id="x")], check_id=True) == [["id not integer"]]
    assert reasons(spark, [row(id="x", votes="y")], check_id=True) == [["votes not integer"]]


def test_unexpected_columns(spark):
    schema = ", ".join(f"{f} string" for f in TRAIN.fields)
    df = spark.createDataFrame([GOOD], schema)
    assert validate(df.withColumn("other", F.lit("")), TRAIN, by_name=True).first()[REASONS] == [
        "extra attribute"]
    nameless = df.withColumn("_c10", F.lit(" ")), df.withColumn("_c10", F.lit("v"))
    assert [validate(d, TRAIN, by_name=True).first()[REASONS] for d in nameless] == [
        [], ["extra attribute"]]
    assert validate(df.select(*reversed(TRAIN.fields)), TRAIN, by_name=True).first()[REASONS] == []
    marked = mark_invalid_header(validate(df, TRAIN), header_ok=False)
    assert marked.first()[REASONS] == ["invalid header"]
    assert mark_invalid_header(df, True) is df


def test_header_check(spark, tmp_path):
    (tmp_path / "good.csv").write_text(" " + ",".join(TRAIN.fields) + "\nx")
    (tmp_path / "bad.csv").write_text("a,b\nx")
    assert header_matches(spark, str(tmp_path / "good.csv"), TRAIN)
    assert not header_matches(spark, str(tmp_path / "bad.csv"), TRAIN)


def test_every_row_is_clean_or_quarantined(spark, small):
    dirty = view(spark, small, "dirty").select(*TRAIN.fields)
    for layout in (TRAIN, PREDICT):
        checked = check_rows(dirty.select(*layout.fields), layout)
        assert clean_rows(checked).count() + quarantined_rows(checked).count() == dirty.count()


def test_clamped_ratings(spark):
    values = {"0": "1", "-3": "1", "6": "5", "007": "5", " 4 ": " 4 ", "x": "x"}
    df = spark.createDataFrame([(v, e) for v, e in values.items()], "v string, e string")
    assert df.filter(clamp_rating(F.col("v")) != F.col("e")).count() == 0


def test_schema_files(spark, tmp_path):
    path = tmp_path / "schema.cfg"
    path.write_text("\ttrain data format:\n\n" + "\n".join(f"\t{f}: about: {f}" for f in PRODUCT.fields)
                    + "\nno colon\n9x: bad\n")
    assert read_fields(spark, str(path)) == list(PRODUCT.fields)
    assert read_layout(spark, str(path), PRODUCT) == PRODUCT
    with pytest.raises(ValueError, match="lacks"):
        read_layout(spark, str(path), TRAIN)
    (tmp_path / "empty.cfg").write_text("nothing here\n")
    with pytest.raises(ValueError, match="No fields"):
        read_fields(spark, str(tmp_path / "empty.cfg"))
    with pytest.raises(FileNotFoundError):
        read_fields(spark, str(tmp_path / "none.cfg"))


def test_csv_output_reads_back(spark, tmp_path):
    odd = row(comment=' "quoted", and\nbroken ', title="a,b")
    schema = ", ".join(f"{f} string" for f in TRAIN.fields)
    df = spark.createDataFrame([(0, *odd), (1, *row(id="2", votes="x"))], f"pos bigint, {schema}")
    run = clean_frame(df, TRAIN)
    for fmt in ("csv", "parquet"):
        write_cleaning(run, str(tmp_path / fmt), fmt)
    clean = scan_clean(spark, str(tmp_path / "csv"))
    assert clean.columns == list(TRAIN.fields)
    assert clean.first()["comment"] == ' "quoted", and broken ' and clean.first()["title"] == "a,b"
    bad = scan_clean(spark, str(tmp_path / "csv_corrupted"))
    assert bad.first()[REASONS] == "votes not integer"
    assert "pos" in spark.read.parquet(str(tmp_path / "parquet")).columns


def test_merged_scan_nulls(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,a,b,c\n 1 ,NA,,""\n2, x ,"p,q","u""v"\n')
    rows = [tuple(r) for r in scan_merged(spark, str(tmp_path / "m.csv")).collect()]
    assert rows == [("1", None, None, ""), ("2", "x", "p,q", 'u"v')]


def test_stream_equals_batch(spark, small, tmp_path):
    records = view(spark, small, "records").select(F.col("record").alias("value"))
    records.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", 2)
        .parquet(str(tmp_path / "in"))
    )
    checked = check_record_stream(stream, TRAIN)
    write_checked_stream(checked, TRAIN, str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    batch = check_record_stream(spark.read.parquet(str(tmp_path / "in")), TRAIN)
    for name, expected in (("clean", normalise(clean_rows(batch), TRAIN)),
                           ("corrupted", quarantined_rows(batch))):
        found = spark.read.parquet(str(tmp_path / "out" / name)).drop("batch")
        assert found.count() == expected.count() > 0
        assert found.exceptAll(expected).count() == 0


def test_other_column_order(spark):
    """Rules go by column name: a schema file may list the columns in another order."""
    layout = TRAIN.with_fields(("rating", *TRAIN.fields[:-1]))
    good = ("5", *GOOD[:-1])
    assert reasons(spark, [good, ("6", *GOOD[:-1])], layout) == [[], ["rating out of range"]]


def test_product_stream_equals_batch(spark, small, tmp_path):
    rows = [f"{i},a_{'x' * 16},Books,1.0,T,f,s,{'5' if i % 3 else 'no'}" for i in range(30)] + ["1,short"]
    spark.createDataFrame([(r,) for r in rows], "value string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    checked = check_record_stream(stream, PRODUCT)
    write_checked_stream(checked, PRODUCT, str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    clean = spark.read.parquet(str(tmp_path / "out/clean"))
    corrupt = spark.read.parquet(str(tmp_path / "out/corrupted"))
    assert (clean.count(), corrupt.count()) == (20, 11)


def test_tests_of_a_row_run_once(spark):
    """Neither a filter on the reasons nor what joins them computes the tests anew."""
    cells = row(user_id="u", parent_prod_id="a", purchased="1", rating="7")
    checked = check_rows(spark.createDataFrame([cells], list(TRAIN.fields)), TRAIN)
    bad = quarantined_rows(checked)
    assert bad.first()["corruption_reasons"] == (
        "user_id malformed; parent_prod_id malformed; purchased malformed; rating out of range"
    )
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("purchased malformed") == plan.count("user_id malformed") == 1


def test_blank_ranges_are_the_blanks():
    """The class that patterns use holds the blanks and nothing else."""
    inside = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", BLANK_RANGES) + "]")
    assert [chr(c) for c in range(sys.maxunicode + 1) if inside.fullmatch(chr(c))] == sorted(BLANKS)
