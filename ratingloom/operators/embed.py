"""Text columns to short numeric columns: encode, compress, expand."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    PCA,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StandardScaler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.artefacts import load_or, publish, published

ENCODER_DIM = 384
COMPRESSED_DIM = 32
BATCH = 256
# Groups that tasks' sums are merged in before the driver adds them up.
_MERGERS = 16


# --- encode -------------------------------------------------------------------


def _words_pipeline(column: str, out: str, dim: int) -> Pipeline:
    return Pipeline(
        stages=[
            RegexTokenizer(
                inputCol=column, outputCol="_words", pattern=r"[\p{L}\p{N}]+", gaps=False
            ),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol=out),
        ]
    )


def distinct_texts(df: DataFrame, column: str, weight: str = "weight") -> DataFrame:
    """Each text of a column once, NULL as empty, with the number of rows that hold it."""
    return df.groupBy(F.coalesce(column, F.lit("")).alias(column)).agg(F.count("*").alias(weight))


def fit_encoder(
    df: DataFrame,
    column: str,
    out: str | None = None,
    dim: int = ENCODER_DIM,
    weight: str | None = None,
) -> PipelineModel:
    """Default encoder: hashed words, weighted by rarity, unit length.  JVM only;
    fitting is one pre-aggregated pass over the text column.

    With ``weight`` a row counts as that many rows: ``distinct_texts`` gives the encoder
    that all rows would give, and reads each text once.
    """
    out = out or f"{column}_vec"
    texts = df.select(F.coalesce(column, F.lit("")).alias(column), *([weight] if weight else []))
    if weight is None:
        return _words_pipeline(column, out, dim).fit(texts)
    words, _, _, unit = _words_pipeline(column, out, dim).getStages()
    seen = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim, binary=True)
    held = seen.transform(words.transform(texts))
    counted = Summarizer.metrics("sum").summary(F.col("_tf"), F.col(weight).cast("double"))
    found = held.select(counted.alias("s"), F.sum(weight).alias("rows")).first()
    rarity = np.log((found["rows"] + 1.0) / (found["s"]["sum"].toArray() + 1.0))
    scale = ElementwiseProduct(scalingVec=Vectors.dense(rarity), inputCol="_tf", outputCol="_idf")
    return PipelineModel([words, seen.copy({seen.binary: False}), scale, unit])


def encode_text(df: DataFrame, encoder: PipelineModel, column: str) -> DataFrame:
    """Add the encoder's vector column; NULL text counts as empty."""
    filled = df.withColumn(column, F.coalesce(column, F.lit("")))
    return encoder.transform(filled).drop("_words", "_tf", "_idf")


def encode_with_model(
    df: DataFrame,
    column: str,
    load: Callable[[], Callable[[list[str]], np.ndarray]],
    out: str | None = None,
    batch: int = BATCH,
) -> DataFrame:
    """Add a vector column from a user's own sentence model.

    ``load`` runs once per task and returns ``texts -> matrix``; whole Arrow batches
    stream through it, ``batch`` texts per call.
    """
    out = out or f"{column}_vec"

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            held = texts.tolist()
            rows: list[np.ndarray] = []
            for i in range(0, len(held), batch):
                rows.extend(np.asarray(model(held[i : i + batch]), dtype=float))
            yield pd.Series(rows, dtype=object)

    # the text column alone visits Python
    return df.withColumn(out, array_to_vector(encode(F.coalesce(F.col(column), F.lit("")))))


# --- compress -----------------------------------------------------------------


def column_means(df: DataFrame, column: str) -> DataFrame:
    """``pos, mean`` of an array column, element by element."""
    return (
        df.select(F.posexplode(column))
        .groupBy("pos")
        .agg(F.avg(F.col("col").cast("double")).alias("mean"))
    )


def as_vector(df: DataFrame, column: str) -> DataFrame:
    """Array columns become vectors, vectors stay."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.withColumn(column, array_to_vector(F.col(column).cast("array<double>")))
    return df


def random_directions(d: int, k: int, seed: int = 0) -> np.ndarray:
    """Seeded Gaussian directions, d x k, scaled by 1/sqrt(k)."""
    return np.random.RandomState(seed).randn(d, k) / np.sqrt(k)


@dataclass(frozen=True)
class Compressor:
    """Centre, then project on ``k`` directions.

    Principal directions are a Spark ML pipeline and stay in the JVM.  Random ones
    follow from dimension, count and seed, and are applied to Arrow batches.
    """

    column: str
    dim: int
    centre: PipelineModel
    seed: int | None = None  # set for random directions

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Replace the vector column by the compressed ``ArrayType(DoubleType)``."""
        out = out or self.column
        done = self.centre.transform(as_vector(df, self.column)).drop(self.column, "_centred", "_signed")
        short = vector_to_array("_short") if self.seed is None else self._project()
        return done.withColumn(out, short).drop("_short")

    def _project(self) -> Column:
        dim, seed = self.dim, self.seed

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            directions = None  # drawn once per task
            for rows in batches:
                if rows.empty:
                    yield rows
                    continue
                matrix = np.stack(rows.to_numpy())
                if directions is None:
                    directions = random_directions(matrix.shape[1], dim, seed)
                yield pd.Series(list(matrix @ directions))

        return project(vector_to_array("_short"))

    def save(self, path: str) -> None:
        publish(path, self.write)

    @staticmethod
    def load(path: str) -> Compressor:
        return Compressor.read(published(path))

    def write(self, path: str) -> None:
        """Save as a part of something that is published whole."""
        spark = SparkSession.active()
        self.centre.write().overwrite().save(f"{path}/stages")
        spark.createDataFrame(
            [(self.column, self.dim, self.seed)], "column string, dim int, seed int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")

    @staticmethod
    def read(path: str) -> Compressor:
        spark = SparkSession.active()
        shape = spark.read.parquet(f"{path}/shape").first()  # one row
        return Compressor(
            shape["column"], shape["dim"], PipelineModel.load(f"{path}/stages"), shape["seed"]
        )


def weighted_moments(df: DataFrame, column: str, weight: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Total weight, mean and covariance of weighted vectors.

    Every task adds up its rows to one matrix; the matrices are added in groups on the
    executors, so the driver sees a few, whatever the rows.
    """

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if batch.empty:
                continue
            x, w = np.stack(batch["x"].to_numpy()), batch["w"].to_numpy(float)
            x = np.hstack((np.ones((len(x), 1)), x))  # the first row and column hold the sums
            part = (x * w[:, None]).T @ x
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"m": [total.tobytes()]})

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"m": [sum(np.frombuffer(m) for m in parts["m"]).tobytes()]})

    rows = as_vector(df.select(column, weight), column)
    rows = rows.select(vector_to_array(column).alias("x"), F.col(weight).cast("double").alias("w"))
    parts = rows.mapInPandas(summed, "m binary").withColumn("g", F.spark_partition_id() % _MERGERS)
    found = parts.groupBy("g").applyInPandas(lambda p: merged(p), "m binary").collect()
    if not found:
        return 0.0, np.zeros(0), np.zeros((0, 0))
    total = sum(np.frombuffer(r["m"]) for r in found)
    total = total.reshape(int(np.sqrt(len(total))), -1)
    n, mean = total[0, 0], total[0, 1:] / total[0, 0]
    return n, mean, (total[1:, 1:] - n * np.outer(mean, mean)) / max(n - 1, 1)


def _matching_frame(df: DataFrame, column: str, weight: str) -> tuple[DataFrame, int]:
    """Two rows per dimension with the mean and the covariance of the weighted rows, and the
    number of rows those stand for: what is fitted on either is the same."""
    n, mean, covariance = weighted_moments(df, column, weight)
    if not n:
        return df.select(column), 0
    spread, axes = np.linalg.eigh(covariance)
    step = axes * np.sqrt(np.maximum(spread, 0) * (2 * len(mean) - 1) / 2)
    rows = [(Vectors.dense(mean + sign * s),) for s in step.T for sign in (1, -1)]
    return df.sparkSession.createDataFrame(rows, [column]), int(n)


def fit_compressor(
    df: DataFrame,
    column: str,
    k: int = COMPRESSED_DIM,
    method: str = "pca",
    seed: int = 0,
    weight: str | None = None,
) -> Compressor:
    """Mean and first ``k`` principal directions of a vector or array column.

    ``k`` is clamped to the dimension and to the number of rows.  The d x d
    covariance is summed in a tree on the executors; only it reaches the driver.
    Directions have their largest loading positive.  ``method='random'`` takes a
    seeded Gaussian projection instead.  Fitting reads ``df`` a few times: stage it
    if it is costly.  With ``weight`` a row counts as that many rows.
    """
    if weight is not None:
        matched, rows = _matching_frame(df, column, weight)
        return fit_compressor(matched, column, min(k, rows), method, seed)
    vectors = as_vector(df.select(column), column)
    summary = vectors.select(
        Summarizer.metrics("mean", "count").summary(F.col(column)).alias("s")
    ).first()["s"]
    k = max(1, min(k, len(summary["mean"]), int(summary["count"])))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=column)
    if method == "random":
        centre = Pipeline(stages=[scaler.setOutputCol("_short")]).fit(vectors)
        return Compressor(column, k, centre, seed)
    centred = scaler.setOutputCol("_centred").fit(vectors)
    # the covariance takes the mean out by itself: fitted on the vectors as they are,
    # sparse ones stay sparse; applied to centred ones
    model = PCA(k=k, inputCol=column, outputCol="_signed").fit(vectors).setInputCol("_centred")
    directions = model.pc.toArray()
    lead = directions[np.abs(directions).argmax(axis=0), np.arange(k)]
    signs = ElementwiseProduct(
        scalingVec=Vectors.dense(np.where(lead < 0, -1.0, 1.0)),
        inputCol="_signed",
        outputCol="_short",
    )
    return Compressor(column, k, PipelineModel([centred, model, signs]))


def load_or_fit(
    path: str, df: DataFrame, column: str, k: int = COMPRESSED_DIM, on_missing: str = "fit"
) -> Compressor:
    """Saved compressor; where it is absent or broken, a warning and a fit on ``df``, or the error."""
    return load_or(lambda: Compressor.load(path), lambda: fit_compressor(df, column, k), on_missing)


def _six_decimals(x: Column) -> Column:
    """``bround(x, 6)``, which works on decimal text, wherever a number in doubles can tell:
    clear of a tie the nearest whole number of millionths is the same, and so is its quotient."""
    millionths = x * F.lit(1e6)
    whole = F.rint(millionths)
    clear = (F.abs(millionths) < 1e9) & (F.abs(millionths - whole) < 0.499)
    return F.when(clear, whole / F.lit(1e6) + F.lit(0.0)).otherwise(F.bround(x, 6))


def expand_embedding(df: DataFrame, column: str, name: str, dim: int) -> DataFrame:
    """Array column -> scalars ``<name>_emb_<i>``, rounded to six decimals."""
    short = F.transform(F.col(column).cast("array<double>"), _six_decimals)
    parts = [F.col(column)[i].alias(f"{name}_emb_{i}") for i in range(dim)]
    rounded = df.withColumn(column, short)
    return rounded.select(*[c for c in df.columns if c != column], *parts)
