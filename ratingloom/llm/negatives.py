"""Hard negatives by threshold joins on inner products, with lowered thresholds.

Anchors search all rows for those above a threshold, exactly.  Rows are indexed by
dimension, in blocks: the dimensions are ordered by their energy, and a row is left out
of the lists of all its last dimensions whose norm alone cannot lift any anchor to its
threshold.  Anchors add up partial scores along the lists; a pair is given up as soon as
its partial score and the norms of what remains cannot reach the threshold, and the pairs
left are scored whole.

A high threshold leaves few pairs.  It is lowered, for those anchors alone whose windows
are not full, until all are full or nothing can be left: the first rows of a window are
exact as soon as enough of them lie above the threshold.  First every anchor finds its
positives, and then the negatives that score within a window below each positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import bounded_broadcast, unique_lookup

# Rows of an index block and anchors of a query block.
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 2048
# Thresholds of the search for positives, as cosines with the largest row there is; the
# last one holds for every pair.
POSITIVE_LEVELS = (0.8, 0.55, 0.35, 0.15, -1.0)
# How much of a window below its positive is searched, round by round.
WINDOW_LEVELS = (0.15, 0.5, 1.0)
# Anchors that go through a block's lists at once, and dimensions between two prunings.
_AT_ONCE, _STRIDE = 128, 16
# Share of pairs below which they are scored one by one.
_FEW = 0.05
_LARGEST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    """Up to ``positives`` rows of an anchor's label, and for each up to ``negatives`` rows
    of other labels with low/100 <= negative score / positive score <= high/100."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def _number_kind(bound: float) -> type:
    """What holds all partial sums up to ``bound`` exactly."""
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def _norms_left(vectors: np.ndarray) -> np.ndarray:
    """Norms of what lies at and behind each dimension, a little too large, and 0 behind the last."""
    squares = np.cumsum((vectors**2)[:, ::-1], axis=1)[:, ::-1]
    return np.pad(np.sqrt(squares) * (1 + 1e-9), ((0, 0), (0, 1)))


def above(queries: np.ndarray, least: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of all pairs of whole-number vectors that score ``least[query]`` or more."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(queries) or not len(rows):
        return none
    wide_q, wide_x = queries.astype(float), rows.astype(float)
    order = np.argsort(-(wide_x**2).sum(axis=0), kind="stable")
    left_q, left_x = _norms_left(wide_q[:, order]), _norms_left(wide_x[:, order])
    kind = _number_kind(float(left_q[:, 0].max() * left_x[:, 0].max()))
    if kind is object:
        scores = queries.astype(object) @ rows.astype(object).T
        at = np.nonzero(scores >= least.astype(object)[:, None])
        return *at, np.clip(scores[at], -_LARGEST, _LARGEST).astype(np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(left_q[:, 0] > 0, least / left_q[:, 0], np.where(least > 0, np.inf, -np.inf)).min()
    # a row stays out of the lists from where the rest of it cannot reach any threshold
    size = len(order)
    listed = (left_x[:, :size] >= ratio).sum(axis=1) if ratio > 0 else np.full(len(rows), size)
    by_length = np.argsort(-listed, kind="stable")[: int((listed > 0).sum())]
    listed, left_x = listed[by_length], left_x[by_length]
    q, x = queries[:, order].astype(kind), rows[by_length][:, order].astype(kind)
    lists = np.where(np.arange(size) < listed[:, None], x, 0)
    found = [none]
    for a in range(0, len(q), _AT_ONCE):
        some, norms, bar = q[a : a + _AT_ONCE], left_q[a : a + _AT_ONCE], least[a : a + _AT_ONCE, None]
        score, few = np.zeros((len(some), len(x)), kind), False
        for d in range(0, size, _STRIDE):
            e = min(d + _STRIDE, size)
            n = int(np.searchsorted(-listed, -d))  # rows in these lists
            score[:, :n] += some[:, d:e] @ lists[:n, d:e].T
            rest = np.minimum(listed, e)  # from where a row has not been added up
            alive = score + norms[:, rest] * left_x[np.arange(len(x)), rest] >= bar
            few = alive.sum() <= _FEW * alive.size
            if few:
                break
        if not few:  # whole scores of all pairs cost less than pairs one by one
            score += some @ (x - lists).T
            alive = score >= bar
        i, j = np.nonzero(alive)
        whole = np.einsum("nd,nd->n", some[i].astype(float), x[j].astype(float)) if few else score[i, j]
        reach = whole >= bar[i, 0]
        found.append((i[reach] + a, by_length[j[reach]], whole[reach].astype(np.int64)))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def first_of(group: np.ndarray, score: np.ndarray, tie: np.ndarray, most: int) -> np.ndarray:
    """Places of each group's first ``most`` entries: higher scores first, then lower ties."""
    order = np.lexsort((tie, -score, group))
    sorted_groups = group[order]
    begins = np.flatnonzero(np.append(True, sorted_groups[1:] != sorted_groups[:-1])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < most]


# --- packed blocks ---------------------------------------------------------------------

_PACKED = "n bigint, ids binary, labels binary, data binary, wide bigint"


def _pack(ids: np.ndarray, labels: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> dict:
    sizes = np.diff(ends)
    wide = int(sizes.max(initial=0))
    data = np.zeros((len(ids), wide), np.int64)
    data[np.arange(wide) < sizes[:, None]] = flat
    small = data.astype(np.int16)
    data = small if (small == data).all() else data
    return {"n": len(ids), "ids": ids.tobytes(), "labels": labels.tobytes(), "data": data.tobytes(), "wide": wide}


def _unpack(block: dict, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, wide = block[f"{name}n"], block[f"{name}wide"]
    data = block[f"{name}data"]
    kind = np.int16 if len(data) == 2 * n * wide else np.int64
    return (
        np.frombuffer(block[f"{name}ids"], np.int64),
        np.frombuffer(block[f"{name}labels"], np.int64),
        np.frombuffer(data, kind).reshape(n, wide).astype(np.int64),
    )


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vectors = batch.column("_vector")
    return (
        batch.column("_id").fill_null(_LARGEST).to_numpy(zero_copy_only=False),
        batch.column("_label").to_numpy(zero_copy_only=False),
        vectors.flatten().to_numpy(zero_copy_only=False),
        vectors.offsets.to_numpy(),
    )


def _row_blocks(rows: DataFrame) -> DataFrame:
    """Rows as blocks of at most BLOCK_ROWS, as they lie."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                yield pa.RecordBatch.from_pylist([_pack(*_columns(batch.slice(at, BLOCK_ROWS)))])

    return stage(rows.mapInArrow(packed, _PACKED), "vector-blocks")


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (a, b))


def _search(blocks: DataFrame, asking: DataFrame, check, out: str) -> DataFrame:
    """``check(queries, block)`` for every block of rows and block of queries.

    ``asking`` has _a (a distinct number), _id, _label, _vector, _bars.  Queries are packed
    by the bounded block; each block of rows meets each of these once, by an equi-join.
    """
    groups = max(1, -(-asking.count() // BLOCK_ANCHORS))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("_a").combine_chunks()
        batch = table.to_batches()[0]
        row = _pack(*_columns(batch))
        row["keys"] = batch.column("_a").to_numpy().tobytes()
        row["bars"] = batch.column("_bars").to_pylist()
        return pa.Table.from_pylist([{f"q_{k}": v for k, v in row.items()} | {"q_block": batch.column("_block")[0].as_py()}])

    names = ["n bigint", "ids binary", "labels binary", "data binary", "wide bigint", "keys binary", "bars array<array<bigint>>"]
    dealt = asking.withColumn("_block", F.pmod(F.xxhash64("_a"), F.lit(groups)))
    queries = dealt.groupBy("_block").applyInArrow(packed, ", ".join(f"q_{c}" for c in names) + ", q_block bigint")
    queries = stage(queries, "query-blocks")
    met = blocks.withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(
        bounded_broadcast(queries), F.col("_q") == F.col("q_block")
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pair = batch.slice(k, 1).to_pylist()[0]
                ids, labels, q = _unpack(pair, "q_")
                keys = np.frombuffer(pair["q_keys"], np.int64)
                bars = [np.array(b, np.int64) for b in pair["q_bars"]]
                found = check((keys, ids, labels, q, bars), _unpack(pair, ""))
                if found is not None and len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], out.replace(",", "").split()[::2])

    return met.mapInArrow(searched, out)


# --- the two searches ------------------------------------------------------------------


def _positives(blocks: DataFrame, anchors: DataFrame, largest: float, rule: Mining, levels) -> DataFrame:
    """_a, _k (from 1), _positive, _score: the first other rows of each anchor's label."""
    most = rule.positives + 1  # the anchor may be among them

    def check(queries, block):
        keys, ids, labels, q, bars = queries
        row_ids, row_labels, x = block
        q, x = _same_width(q, x)
        bar = np.array([b[0] for b in bars], np.int64)
        parts = []
        for label in np.unique(labels):
            mine, own = np.flatnonzero(labels == label), np.flatnonzero(row_labels == label)
            i, j, score = above(q[mine], bar[mine], x[own])
            i, j = mine[i], own[j]
            best = first_of(i, score, row_ids[j], most)
            parts.append((i[best], j[best], score[best]))
        i, j, score = (np.concatenate(p) for p in zip(*parts, strict=True))
        itself = (row_ids[j] == ids[i]) & (x[j] == q[i]).all(axis=1)
        return keys[i], row_ids[j], score, itself

    ranks = Window.partitionBy("_a").orderBy(F.desc("_score"), "_row", F.desc("_itself"))
    others = Window.partitionBy("_a").orderBy("_rank")
    left, done = anchors, []
    for level in levels:
        bar = F.floor(F.lit(level) * F.col("_norm") * F.lit(largest) - 1)
        asking = left.withColumn("_bars", F.array(bar))
        found = _search(blocks, asking, check, "_a bigint, _row bigint, _score bigint, _itself boolean")
        first = found.withColumn("_rank", F.row_number().over(ranks)).filter(F.col("_rank") <= most)
        # of rows equal to the anchor one is the anchor
        marked = first.withColumn("_self", F.col("_itself") & (F.sum(F.col("_itself").cast("int")).over(others.rowsBetween(Window.unboundedPreceding, 0)) == 1))
        kept = marked.filter(~F.col("_self")).withColumn("_k", F.row_number().over(others))
        kept = kept.filter(F.col("_k") <= rule.positives).withColumn("_of", F.count("*").over(Window.partitionBy("_a")))
        if level == levels[-1]:
            kept = stage(kept, "positives")
        else:
            kept = stage(kept.filter(F.col("_of") == rule.positives), "positives")
        done.append(kept.select("_a", "_k", F.col("_row").alias("_positive"), "_score"))
        if level != levels[-1]:
            full = kept.select(F.col("_a").alias("_full")).distinct()
            left = stage(left.join(bounded_broadcast(full), F.col("_a") == F.col("_full"), "left_anti"), "anchors-left")
            if left.isEmpty():
                break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stage(out, "all-positives")


def _negatives(blocks: DataFrame, anchors: DataFrame, positives: DataFrame, rule: Mining, levels) -> DataFrame:
    """_a, _k, _rank, _negative, _negative_score within the window below each positive."""
    # whole scores s with low * p <= 100 s <= high * p
    top = F.floor(F.expr(f"{rule.high} * cast(_score as decimal(38, 0)) / 100")).cast("bigint")
    low = F.ceil(F.expr(f"{rule.low} * cast(_score as decimal(38, 0)) / 100")).cast("bigint")
    windows = positives.select("_a", "_k", top.alias("_top"), low.alias("_low")).filter("_low <= _top")
    windows = stage(windows, "windows")

    def check(queries, block):
        keys, _, labels, q, bars = queries
        row_ids, row_labels, x = block
        q, x = _same_width(q, x)
        i, j, score = above(q, np.array([b[1::3].min() for b in bars]), x)
        other = labels[i] != row_labels[j]
        i, j, score = i[other], j[other], score[other]
        parts = []
        for slot in range(max(len(b) for b in bars) // 3):
            # every anchor's window number ``slot``: its number, lower bar and top
            has = np.array([len(b) > 3 * slot for b in bars])
            number, bar, high = (np.array([b[3 * slot + c] if h else 0 for b, h in zip(bars, has, strict=True)]) for c in range(3))
            fits = np.flatnonzero(has[i] & (score >= bar[i]) & (score <= high[i]))
            best = fits[first_of(i[fits], score[fits], row_ids[j[fits]], rule.negatives)]
            parts.append((keys[i[best]], number[i[best]].astype(np.int32), row_ids[j[best]], score[best]))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    ranks = Window.partitionBy("_a", "_k").orderBy(F.desc("_score"), "_row")
    left, done = windows, []
    for level in levels:
        bar = F.col("_top") - F.floor((F.col("_top") - F.col("_low")) * F.lit(level)).cast("bigint")
        bar = F.col("_low") if level >= 1 else F.greatest(bar, F.col("_low"))
        slots = left.groupBy(F.col("_a").alias("_w")).agg(
            F.flatten(F.array_sort(F.collect_list(F.array(F.col("_k").cast("bigint"), bar, F.col("_top"))))).alias("_bars")
        )  # as many as an anchor has positives
        asking = anchors.join(bounded_broadcast(slots), F.col("_a") == F.col("_w")).drop("_w")
        found = _search(blocks, asking, check, "_a bigint, _k int, _row bigint, _score bigint")
        first = found.withColumn("_rank", F.row_number().over(ranks)).filter(F.col("_rank") <= rule.negatives)
        first = first.withColumn("_of", F.count("*").over(Window.partitionBy("_a", "_k")))
        last = level == levels[-1]
        kept = stage(first if last else first.filter(F.col("_of") == rule.negatives), "negatives")
        done.append(kept.drop("_of"))
        if not last:
            full = kept.select(F.col("_a").alias("_f"), F.col("_k").alias("_g")).distinct()
            same = (F.col("_a") == F.col("_f")) & (F.col("_k") == F.col("_g"))
            left = stage(left.join(bounded_broadcast(full), same, "left_anti"), "windows-left")
            if left.isEmpty():
                break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("_a", "_k", "_rank", F.col("_row").alias("_negative"), F.col("_score").alias("_negative_score"))


def mine_negatives(
    rows: DataFrame,
    is_anchor: Column,
    rule: Mining = Mining(),  # noqa: B008
    positive_levels: tuple[float, ...] = POSITIVE_LEVELS,
    window_levels: tuple[float, ...] = WINDOW_LEVELS,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``rows`` have vec_id, label and ``vector`` (whole numbers).  Higher scores come first,
    ties by smaller vec_id, a null vec_id last.  A positive without a negative in its window
    has no rows.

    Rows with a null label, vector or component take no part.  Shorter vectors count as
    filled up with zeros.  Rows that repeat a vec_id are rows of their own; an anchor is left
    out of its own positives once.  Scores beyond 64 bits are cut to them.  An empty table or
    one without anchors gives no rows; other columns are not looked at.
    """
    vector = F.col("vector").cast("array<bigint>")
    used = rows.filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    ).select(F.col("vec_id").alias("_id"), F.col("label").cast("bigint").alias("_label"), vector.alias("_vector"), is_anchor.alias("_asks"))
    blocks = _row_blocks(used.drop("_asks"))
    square = F.aggregate("_vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest = used.agg(F.max(F.sqrt(square))).first()[0] or 0.0
    anchors = used.filter("_asks").drop("_asks").withColumn("_norm", F.sqrt(square)).withColumn("_a", F.monotonically_increasing_id())
    anchors = stage(anchors, "anchors")
    positives = _positives(blocks, anchors, largest, rule, positive_levels)
    negatives = _negatives(blocks, anchors, positives, rule, window_levels)
    ids = anchors.select(F.col("_a").alias("_n"), "_id")
    of = positives.select(F.struct("_a", "_k").alias("_of"), "_positive", "_score")
    found = negatives.withColumn("_on", F.struct("_a", "_k"))
    joined = unique_lookup(unique_lookup(found, of, "_on", "_of", "inner"), ids, "_a", "_n", "inner")

    def known(c: str) -> Column:
        return F.when(F.col(c) != _LARGEST, F.col(c))

    return joined.select(
        F.col("_id").alias("anchor_id"),
        known("_positive").alias("positive_id"),
        F.col("_k").alias("positive_rank"),
        F.col("_rank").alias("rank"),
        known("_negative").alias("negative_id"),
        F.col("_score").alias("positive_score"),
        F.col("_negative_score").alias("negative_score"),
    )
