"""Cleaning runs: raw files or frames in, clean and quarantined rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage_observed
from ratingloom.functions.cells import csv_cells
from ratingloom.functions.text import default_na
from ratingloom.operators.ids import reassign_duplicate_ids
from ratingloom.operators.normalise import normalise
from ratingloom.operators.position import POS
from ratingloom.operators.repair import cells_to_columns, pad_cells, repair_reviews
from ratingloom.operators.validate import (
    clean_rows,
    cleaning_summary,
    mark_invalid_header,
    quarantined_rows,
    reason_counts,
    summary_figures,
    validate,
)
from ratingloom.sources.csv_tables import BROKEN, scan_strict
from ratingloom.sources.raw_text import (
    frame_records,
    header_matches,
    line_records,
    scan_lines,
)
from ratingloom.sources.schema_file import Layout


@dataclass(frozen=True)
class CleaningRun:
    """Frames of one cleaning run.  ``checked`` holds every input row with its list
    of reasons; the others derive from it.  ``figures`` are the summary, if the run that
    wrote the rows took it."""

    layout: Layout
    checked: DataFrame
    figures: dict | None = None

    @property
    def clean(self) -> DataFrame:
        """Valid rows, normalised, in schema order (plus ``pos``)."""
        rows = normalise(clean_rows(self.checked), self.layout)
        if self.layout.kind == "train":
            rows = reassign_duplicate_ids(rows)
        return rows.select(POS, *self.layout.fields)

    @property
    def quarantine(self) -> DataFrame:
        """Corrupt rows with their joined reasons; product rows also keep the cells
        beyond the schema."""
        return quarantined_rows(self.checked)

    @property
    def summary(self) -> DataFrame:
        if self.figures is None:
            return cleaning_summary(self.checked)
        figures = [F.lit(v).cast("bigint").alias(k) for k, v in self.figures.items()]
        return self.checked.sparkSession.range(1).select(*figures)

    @property
    def reasons(self) -> DataFrame:
        return reason_counts(self.checked)


def check_rows(df: DataFrame, layout: Layout, n_cells: str | None = None) -> DataFrame:
    """Text columns -> the same rows with ``corruption_reasons`` (narrow)."""
    if layout.kind != "product":
        df = df.withColumn("comment", default_na(F.col("comment")))
    return validate(df, layout, n_cells=n_cells, check_id=layout.kind == "train")


def check_records(
    records: DataFrame, layout: Layout, compat: bool = False, record: str = "record"
) -> DataFrame:
    """``record`` text -> cells, repaired and checked columns (narrow); other columns stay."""
    others = [c for c in records.columns if c != record]
    cells = records.select(*others, csv_cells(F.col(record)).alias("cells"))
    if layout.kind != "product":
        return check_rows(repair_reviews(cells, layout, compat=compat), layout)
    extra = F.size("cells") - layout.size
    padded = (
        cells.withColumn("n_cells", F.greatest(F.size("cells"), F.lit(layout.size)))
        .withColumn(
            "extra_cells",
            F.when(extra > 0, F.slice("cells", F.lit(layout.size + 1), F.greatest(extra, F.lit(1)))),
        )
        .withColumn("cells", pad_cells(F.col("cells"), layout.size))
    )
    return check_rows(cells_to_columns(padded, layout), layout, "n_cells").drop("n_cells")


def read_records(
    spark: SparkSession, path: str, layout: Layout, header: bool = True
) -> DataFrame:
    """Raw file(s) -> ``pos, record``."""
    lines = scan_lines(spark, path)
    return frame_records(lines, header) if layout.quoted_records else line_records(lines, header)


def _run(checked: DataFrame, layout: Layout) -> CleaningRun:
    """The checked rows, written once to the shared folder and counted on the way, because
    id repair and both outputs read them."""
    return CleaningRun(layout, *stage_observed(checked, "checked", **summary_figures()))


def clean_file(
    spark: SparkSession,
    path: str,
    layout: Layout,
    header: bool = True,
    compat: bool = False,
    check_header: bool = False,
) -> CleaningRun:
    """Clean raw file(s).  With ``check_header`` a file whose header does not name exactly
    the layout's columns makes every row ``invalid header``."""
    checked = check_records(read_records(spark, path, layout, header), layout, compat)
    if header and check_header:
        checked = mark_invalid_header(checked, header_matches(spark, path, layout))
    return _run(checked, layout)


def clean_frame(df: DataFrame, layout: Layout) -> CleaningRun:
    """Clean a frame of the layout's text columns and a distinct ``pos``."""
    return _run(check_rows(df.select(POS, *layout.fields), layout), layout)


def strict_rows(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """Rows of a well-formed CSV that are valid as they stand: no repair, no clean-up,
    only a blank comment becomes ``NA``."""
    scanned = scan_strict(spark, path, layout)
    whole = scanned.filter(F.col(BROKEN).isNull()).drop(BROKEN)
    return strict_filter(whole.na.fill(""), layout)


def strict_filter(df: DataFrame, layout: Layout) -> DataFrame:
    """The valid rows of a frame, unrepaired; a blank optional comment is ``NA``."""
    rows = clean_rows(validate(df, layout))
    return rows.withColumn("comment", default_na(F.col("comment"))) if (
        "comment" in layout.fields
    ) else rows
