"""Durable cuts in a plan: intermediate results written once, read many times.

They live in the shared folder the cluster names in ``spark.checkpoint.dir``, so
they outlive any executor.  Only where that setting is absent *and* the session
runs in local mode does a temporary folder stand in for it.  Parquet keeps later
reads pruned to the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate results, as the session names it."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder there"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratingloom-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh, never reused path for an intermediate table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once, now, and return a scan of what was written; ``compact`` spends some
    more time on whole rows of text for fewer bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", "zstd") if compact else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``stage``, with aggregates that are taken while the rows are written."""
    observation = Observation(name)
    staged = stage(df.observe(observation, *[c.alias(k) for k, c in figures.items()]), name)
    return staged, observation.get
