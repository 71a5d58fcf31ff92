"""Saved models: whole versions, published at once.

A version is written to a folder of its own first.  A row of the artefact's manifest, with
the number of its files and a checksum of their contents, is appended last, by a single
Parquet file that appears when its job commits.  A run that dies before leaves the manifest,
and with it the version before, as they were; readers only see versions that the manifest
names and whose files are what it says.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
_MANIFEST = "number bigint, version string, files bigint, checksum bigint"


class ArtefactMissing(FileNotFoundError):
    """Nothing was ever published at a path."""


class ArtefactBroken(ValueError):
    """Files of a published version are lost or changed."""


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        raise ArtefactMissing(f"No model at {path}") from error


def _contents(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Number of files of a version and a checksum of their names and contents."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException:
        return 0, 0
    name = F.element_at(F.split("path", f"/{folder.rsplit('/', 1)[-1]}/"), -1)
    row = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(name, "content")).alias("sum")).first()
    return row["n"], row["sum"] or 0


def publish(path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` save a version to a new folder, then make it the one that is loaded."""
    spark = SparkSession.active()
    try:
        last = _manifest(spark, path).agg(F.max("number")).first()[0] or 0
    except ArtefactMissing:
        last = 0
    version = uuid.uuid4().hex
    write(f"{path}/{version}")
    entry = [(last + 1, version, *_contents(spark, f"{path}/{version}"))]
    spark.createDataFrame(entry, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def published(path: str) -> str:
    """Folder of the version published last, if its files are whole."""
    spark = SparkSession.active()
    row = _manifest(spark, path).orderBy(F.desc("number"), "version").first()
    if row is None:
        raise ArtefactMissing(f"No model at {path}")
    folder = f"{path}/{row['version']}"
    try:
        found = _contents(spark, folder)
    except (PySparkException, Py4JJavaError) as error:
        raise ArtefactBroken(f"Model at {path} cannot be read: {row['version']}") from error
    if found != (row["files"], row["checksum"]):
        raise ArtefactBroken(f"Model at {path} is not what was published: {row['version']}")
    return folder


def load_or(load: Callable[[], T], fit: Callable[[], T], on_missing: str = "fit") -> T:
    """What ``load`` gives; where nothing is saved, or it is broken, a warning and what
    ``fit`` gives (``on_missing="error"``: the error).  Other errors stay errors."""
    try:
        return load()
    except (ArtefactMissing, ArtefactBroken) as error:
        if on_missing == "error":
            raise
        warnings.warn(f"{error}; fitting anew", stacklevel=2)
        return fit()
