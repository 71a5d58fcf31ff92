"""Left lookups against a table with one row per key.

The table is sent to every executor only when a measurement of this very frame
proves it small.  Beyond that the join shuffles, and keys that hold more than a
task's fair share of the left rows are spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.checkpoints import stage

BROADCAST_BYTES = 64 << 20
# Fixed bytes per row and per cell charged on top of text and array contents.
_ROW_BYTES, _CELL_BYTES = 32, 16


def _cell_bytes(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + _CELL_BYTES
    if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        text = F.to_json(F.struct(c))
        return F.coalesce(F.octet_length(text), F.lit(0)) * 2 + _CELL_BYTES
    return F.lit(_CELL_BYTES)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the frame's size in memory, measured on its rows."""
    row = F.lit(_ROW_BYTES)
    for field in df.schema.fields:
        row = row + _cell_bytes(field.name, field.dataType)
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a measurement proves the frame small enough to broadcast."""
    return measured_bytes(df) <= limit


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def _hot_keys(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """Keys above a fair share of the rows and the number of tasks each deserves.

    At most ``tasks`` keys can exceed 1/``tasks`` of the rows, so this frame is
    bounded by the session's partition count whatever the data holds.  Two passes
    over the key column alone, the second pre-aggregated; written once.
    """
    total = F.lit(rows.count())
    counts = rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
    return stage(
        counts.filter(F.col("_n") * tasks > total).select(
            "_hot", F.ceil(F.col("_n") * tasks / total).cast("int").alias("_salts")
        ),
        "hot-keys",
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join with a one-row-per-key ``right``; hot left keys use many tasks.

    The salt is the left row's own partition number: it is the same whenever a
    lost task runs again, and it spreads even identical rows.  ``counted`` is a
    cheaper frame with the same keys as ``left``, if there is one.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(_hot_keys(left if counted is None else counted, left_key, tasks))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = (
        left.withColumn("_part", F.spark_partition_id())
        .join(hot, F.col(left_key).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_salt", F.pmod(F.xxhash64("_part"), salts).cast("int"))
        .drop("_hot", "_salts", "_part")
    )
    copies = (
        right.join(hot, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_hot", "_salts")
    )
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_copy"))
    return spread.join(copies, on, how).drop("_salt", "_copy")


def unique_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    small: bool | None = None,
    counted: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Join ``left`` to a one-row-per-key ``right``; column names must not clash.

    Broadcasts if ``right`` measures at most ``limit`` bytes (``small`` says so when
    it is known already), else shuffles with hot keys spread.  ``distinct`` says that the
    left rows' keys are distinct too, so that there is none to look for.
    """
    small = fits_broadcast(right, limit) if small is None else small
    if small or distinct:
        return left.join(F.broadcast(right) if small else right, F.col(left_key) == F.col(right_key), how)
    return salted_join(left, right, left_key, right_key, how, counted)
