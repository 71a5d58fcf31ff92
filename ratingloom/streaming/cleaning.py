"""Cleaning of review and product streams.

Repair, validation and normalising are row-wise expressions, so the batch functions
run on a streaming frame unchanged and need no state.  Records must arrive whole,
one per row: framing, id repair and fitting need the complete table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ratingloom.operators.normalise import normalise
from ratingloom.operators.validate import clean_rows, quarantined_rows
from ratingloom.plans.cleaning import check_records
from ratingloom.sources.schema_file import Layout


def check_record_stream(records: DataFrame, layout: Layout, record: str = "value") -> DataFrame:
    """Streaming ``record`` text of reviews or products -> checked columns; others stay."""
    return check_records(records, layout, record=record)


def write_checked_stream(
    checked: DataFrame, layout: Layout, path: str, progress: str
) -> StreamingQuery:
    """Append clean rows to ``<path>/clean`` and corrupt ones to ``<path>/corrupted``.

    Each batch goes to its own subfolder by batch number, replaced if it is retried.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # read, repaired and checked once for both outputs
        for rows, name in (
            (normalise(clean_rows(batch), layout), "clean"),
            (quarantined_rows(batch), "corrupted"),
        ):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        batch.unpersist()

    return (
        checked.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
