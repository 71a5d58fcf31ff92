"""Column lists: the three fixed layouts, and the ``name: description`` files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ratingloom.functions.text import strip


@dataclass(frozen=True)
class Layout:
    """Ordered raw columns and the rules that depend on the kind of file."""

    kind: str
    fields: tuple[str, ...]
    optional: frozenset[str]  # may be blank, default to NA
    sanitised: tuple[str, ...]  # control characters become spaces
    quoted_records: bool  # records may span lines

    @property
    def has_rating(self) -> bool:
        return "rating" in self.fields

    @property
    def size(self) -> int:
        return len(self.fields)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])

    def with_fields(self, fields: list[str] | tuple[str, ...]) -> Layout:
        """The same rules over the column list of a schema file."""
        missing = set(self.fields) - set(fields)
        if missing:
            raise ValueError(f"schema lacks required columns: {sorted(missing)}")
        return Layout(self.kind, tuple(fields), self.optional, self.sanitised, self.quoted_records)


# Raw column order of the three kinds of file.
_REVIEW = (
    "id", "user_id", "prod_id", "parent_prod_id", "title",
    "comment", "time", "votes", "purchased",
)
_PRODUCT = (
    "id", "parent_prod_id", "main_category", "price",
    "title", "features", "store", "rating_number",
)

TRAIN = Layout("train", (*_REVIEW, "rating"), frozenset({"comment"}), ("title", "comment"), True)
PREDICT = Layout("predict", _REVIEW, frozenset({"comment"}), ("title", "comment"), True)
PRODUCT = Layout(
    "product",
    _PRODUCT,
    frozenset({"title", "price", "main_category", "store"}),
    ("title", "features", "store"),
    False,
)


def require_path(spark: SparkSession, path: str, what: str) -> None:
    """Raise ``FileNotFoundError`` with a readable message if ``path`` is missing."""
    try:
        spark.read.format("text").load(path).schema  # resolves the path, reads nothing
    except AnalysisException as error:
        raise FileNotFoundError(f"{what} not found: {path}") from error


def read_fields(spark: SparkSession, path: str) -> list[str]:
    """Column names of a ``name: description`` file, in file order."""
    require_path(spark, path, "Schema file")
    line = F.col("value")
    name = strip(F.split(line, ":", 2)[0])
    rows = (
        # one small file, read whole in order: a schema, not data
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.split("value", r"\r\n|\r|\n")).alias("value"))
        .filter(F.contains(line, F.lit(":")))
        .select(name.alias("name"))
        .filter(F.col("name").rlike(r"\A[A-Za-z_][A-Za-z0-9_]*\z"))
        .collect()
    )
    if not rows:
        raise ValueError(f"No fields found in schema file: {path}")
    return [r["name"] for r in rows]


def read_layout(spark: SparkSession, path: str, base: Layout) -> Layout:
    """``base`` with the column order of a schema file."""
    return base.with_fields(read_fields(spark, path))
