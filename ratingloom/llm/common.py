"""Small helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, balanced: bool = False
) -> DataFrame:
    """Texts with 0/1 labels to learn from: at most ``most`` rows, or of either class if balanced.

    The rows are those first by hash of their id among the labelled rows that are not
    held out, so the sample spreads over the corpus and is the same on every run.  An id
    counts once for each label, however many rows of either table carry it; of its texts
    the one with the lowest hash is taken.  So the bound holds for the rows returned, which
    makes them safe to broadcast and, once reduced to features, to gather.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).distinct()
    parts = [known.filter(F.col("y") == y) for y in (0, 1)] if balanced else [known]
    first = [part.orderBy(F.xxhash64("_id"), "_id", "y").limit(most) for part in parts]
    ids = first[0].unionByName(first[1]) if balanced else first[0]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    one = rows.groupBy("_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_least"))
    return one.select("_least.text", "y")


def first_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows with distinct keys: those whose keys hash lowest.

    Only distinct hashes are ranked, so copies of a key use up one place; the rows
    themselves move once the bound is known, and of equal keys one row does.
    """
    low = rows.select(F.xxhash64(key).alias("_h")).distinct().orderBy("_h").limit(most)
    bound = low.agg(F.max("_h")).first()[0]
    few = rows.withColumn("_h", F.xxhash64(key)).filter(F.col("_h") <= F.lit(bound))
    return few.dropDuplicates(["_h"]).drop("_h")


def slices(texts: Sequence[str], chars: int) -> Iterator[slice]:
    """Consecutive runs of texts of about ``chars`` code points; one long text may exceed it."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield slice(start, i)
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield slice(start, len(texts))


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a line feed after each, and where each text starts."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return codes, np.cumsum(lengths) - lengths


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] numbers for each i, one after another."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(first - (ends - count), count)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


# A random 64-bit value for the low half of every code point, from a fixed seed.
_VALUE = np.random.default_rng(20240917).integers(0, 1 << 64, 1 << 16, dtype=np.uint64)


def word_hashes(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every run of ``inside`` code points.

    The hash sums a mixed value of each code point and its place, so words that differ
    in any way share one by chance alone.
    """
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    size = end - start
    at = np.flatnonzero(inside)
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    value = _VALUE[codes[at] & 0xFFFF] + (codes[at] >> 16).astype(np.uint64)
    value += place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return start, end, mixed(np.add.reduceat(mixed(value), first))


class Adam:
    """First-order optimiser over a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step_no = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.step_no += 1
        a, b = 1 - 0.9**self.step_no, 1 - 0.999**self.step_no
        for k, g in grads.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.params[k] -= self.rate * (self.mean[k] / a) / (np.sqrt(self.square[k] / b) + 1e-8)
