"""Row positions without a single-task sort.

Much of the cleaning speaks of *file order*: the first row of a key wins, later
copies of an id are renumbered in order.  A position is one sortable LongType
column, ``pos``.  It comes from the scan (no shuffle) or from a range-partitioned
sort, and has gaps; ``number_rows`` turns it into 0, 1, 2, ... by numbering small
runs of positions in parallel and adding each run's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import bounded_broadcast

POS = "pos"
_ROW_BITS = 36  # rows per file or partition: 6.9e10, files or partitions: 1.3e8
_RUN_BITS = 16  # consecutive positions numbered by one task at a time
_GROUP_BITS = 10  # runs whose offsets one task adds up


def file_position(scan: DataFrame, pos: str = POS) -> DataFrame:
    """Position of each row of a Parquet scan: file name order, then row in file.

    Narrow: the reader supplies file path and row index.  The table of files has one
    row per file and reads no data columns.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    if len(scan.inputFiles()) <= 1:
        return scan.select("*", row.alias(pos))
    number = F.row_number().over(Window.orderBy("_file")).cast("bigint")
    files = scan.select(path.alias("_file")).distinct()
    ordinals = stage(files.withColumn("_file_no", number), "files")
    return (
        scan.select("*", path.alias("_file"), row.alias("_row"))
        .join(bounded_broadcast(ordinals), "_file")
        .withColumn(pos, F.shiftleft("_file_no", _ROW_BITS) + F.col("_row"))
        .drop("_file", "_file_no", "_row")
    )


def order_position(df: DataFrame, order: Sequence[str | Column], pos: str = POS) -> DataFrame:
    """Position of each row under ``order``, which must be a total order.

    Range-partitioned sort, written once: that pins the sampled bounds, so that
    every later use, and every retried task, sees the same positions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    partition, offset = F.shiftright(row, 33), row.bitwiseAND(F.lit((1 << 33) - 1))
    return stage(
        ranged.select("*", (F.shiftleft(partition, _ROW_BITS) + offset).alias(pos)),
        "ordered",
    )


def _run_offsets(runs: DataFrame, size: str, offset: str) -> DataFrame:
    """Rows ahead of each run.  ``runs`` holds one row per run; two levels keep
    the only unpartitioned window at one row per 1,024 runs."""
    ahead = (Window.unboundedPreceding, -1)
    grouped = runs.withColumn("_group", F.shiftright("_run", _GROUP_BITS))
    inner = Window.partitionBy("_group").orderBy("_run").rowsBetween(*ahead)
    outer = Window.orderBy("_group").rowsBetween(*ahead)
    groups = (
        grouped.groupBy("_group")
        .agg(F.sum(size).alias("_n"))
        .select("_group", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_base"))
    )
    return (
        grouped.withColumn("_within", F.coalesce(F.sum(size).over(inner), F.lit(0)))
        .join(groups, "_group")
        .select("_run", (F.col("_base") + F.col("_within")).alias(offset))
    )


def number_rows(df: DataFrame, name: str, pos: str = POS) -> DataFrame:
    """Dense row number 0, 1, 2, ... in ``pos`` order; positions must be distinct.

    One shuffle on the run; a run holds at most 65,536 rows, so no key and no
    source can fill a task.  The offsets join on the same key: no further shuffle.
    """
    run = F.shiftright(F.col(pos), _RUN_BITS)
    keyed = df.withColumn("_run", run)
    sizes = df.select(run.alias("_run")).groupBy("_run").agg(F.count("*").alias("_n"))
    within = Window.partitionBy("_run").orderBy(pos)
    return (
        keyed.join(_run_offsets(sizes, "_n", "_offset"), "_run")
        .withColumn(name, F.col("_offset") + F.row_number().over(within) - 1)
        .drop("_run", "_offset")
    )


def row_position(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Dense row number under a total order."""
    return number_rows(order_position(df, order), name).drop(POS)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in order (a sample by design, taken per task first)."""
    return df.orderBy(*order).limit(n)
