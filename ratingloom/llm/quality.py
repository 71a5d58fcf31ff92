"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  A line's score sees its own features and those of the lines
before and after it; transition weights tie neighbours.  Forward-backward gives each
line's marginal, and a document's quality is the mean of the marginals weighted by line
length.  Labels exist for documents only, so in training all lines of a document carry
its label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import Adam, code_points, held_out, labelled_sample, slices, word_hashes

# Training takes at most so many documents, of at most so many lines each.
SAMPLE_ROWS = 4000
SAMPLE_LINES = 400
# Texts of more lines are walked through in blocks of their own.
LONG_LINES = 1000
_CHUNK_CHARS = 500_000

_SYMBOLS = "#$%&*|!^~@<>{}[]\\`=+_"
_MARKS = ".,;:'\"-()?/"
_LOWER, _UPPER, _DIGIT, _BLANK, _SYMBOL, _MARK, _OTHER, _FEED = range(8)


def _class_table() -> np.ndarray:
    table = np.full(129, _OTHER, np.uint8)
    table[ord("a") : ord("z") + 1] = _LOWER
    table[ord("A") : ord("Z") + 1] = _UPPER
    table[ord("0") : ord("9") + 1] = _DIGIT
    for chars, kind in ((" \t\r\v\f", _BLANK), (_SYMBOLS, _SYMBOL), (_MARKS, _MARK), ("\n", _FEED)):
        for c in chars:
            table[ord(c)] = kind
    return table


_CLASS = _class_table()
# Seven counts of less than 2^21 each share two sums of 64 bits and one more.
_FIELD = 21
_PACKED = np.zeros((3, 8), np.int64)
for _k in range(7):
    _PACKED[_k // 3, _k] = 1 << _FIELD * (_k % 3)


def class_counts(kind: np.ndarray, starts: np.ndarray, longest: int) -> np.ndarray:
    """How many code points of each of the seven classes lie in each line."""
    counts = np.empty((len(starts), 7), np.float64)
    if longest >> _FIELD:  # too many for a field, so each class has a sum of its own
        for k in range(7):
            counts[:, k] = np.add.reduceat(kind == k, starts, dtype=np.int64)
        return counts
    for p in range(3):
        packed = np.add.reduceat(_PACKED[p][kind], starts)
        for j in range(min(3, 7 - 3 * p)):
            counts[:, 3 * p + j] = (packed >> _FIELD * j) & ((1 << _FIELD) - 1)
    return counts


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line, its length in code points, and each text's number of lines."""
    codes, begins = code_points(texts)
    kind = _CLASS[np.minimum(codes, 128)]
    starts = np.concatenate(([0], np.flatnonzero(kind == _FEED)[:-1] + 1))
    lengths = np.diff(np.append(starts, len(codes))) - 1
    per_text = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    counts = class_counts(kind, starts, int(lengths.max()))
    inside = (kind != _BLANK) & (kind != _FEED)
    first, end, hashes = word_hashes(codes, inside)
    line = np.searchsorted(starts, first, side="right") - 1
    n_lines = len(starts)
    words = np.bincount(line, minlength=n_lines)
    noisy = np.bincount(line, weights=kind[end - 1] == _SYMBOL, minlength=n_lines)
    same = np.zeros(len(first))
    if len(first):
        same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    repeated = np.bincount(line, weights=same, minlength=n_lines)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes)))
    at = np.searchsorted(first, np.append(starts, len(codes)))
    text_of = np.repeat(np.arange(len(texts)), per_text).astype(np.uint64)
    key = (sums[at[1:]] - sums[at[:-1]]) * np.uint64(2) + text_of * np.uint64(0x9E3779B97F4A7C15)
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    size, n_words = np.maximum(lengths, 1), np.maximum(words, 1)
    last = codes[np.maximum(starts + lengths - 1, 0)]
    columns = [counts[:, k] / size for k in range(7)]
    columns += [np.log1p(lengths), np.log1p(words), (size - counts[:, _BLANK]) / n_words / 10]
    columns += [noisy / n_words, repeated / n_words, (times[back] > 1) & (lengths > 0)]
    columns += [np.isin(last, [ord(c) for c in ".!?:;\""]) & (lengths > 0), lengths == 0]
    return np.stack(columns, axis=1).astype(np.float32), lengths, per_text


def with_neighbours(x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features, those of its neighbours (zeros at the edges), edges and a bias."""
    ends = np.cumsum(per_text)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[ends - per_text], after[ends - 1] = 0, 0
    extra = np.zeros((len(x), 3), x.dtype)
    extra[ends - per_text, 0], extra[ends - 1, 1], extra[:, 2] = 1, 1, 1
    return np.hstack((x, before, after, extra))


def forward_backward(
    scores: np.ndarray, per_text: np.ndarray, step: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the two states for every line, and the expected transitions.

    ``scores`` is what the state "good" scores over "bad".  All texts advance together,
    the longest first, so the loop is over line numbers.  Transitions are summed over
    texts after weighting each text by one over its number of lines.
    """
    order = np.argsort(-per_text, kind="stable")
    first, size = (np.cumsum(per_text) - per_text)[order], per_text[order]
    good = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    emit = np.stack((1 - good, good), axis=1)
    move = np.exp(step)
    alpha, scale = np.empty_like(emit), np.empty(len(emit))
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    now = None
    for t in range(longest):
        at = first[: active[t]] + t
        now = (np.exp(start) if t == 0 else now[: active[t]] @ move) * emit[at]
        total = now.sum(1, keepdims=True)
        now = now / total
        alpha[at], scale[at] = now, total[:, 0]
    beta, pairs = np.ones_like(emit), np.zeros((2, 2))
    later = None
    for t in range(longest - 1, -1, -1):
        at = first[: active[t]] + t
        now = np.ones((active[t], 2))
        if later is not None:
            k = active[t + 1]
            ahead = emit[at[:k] + 1] * later / scale[at[:k] + 1][:, None]
            weighted = alpha[at[:k]] / size[:k, None]
            pairs += (weighted.T @ ahead) * move
            now[:k] = ahead @ move.T
        beta[at] = later = now
    both = alpha * beta
    return both / both.sum(1, keepdims=True), pairs


def along_chain(emit: np.ndarray, move: np.ndarray, first: np.ndarray) -> np.ndarray:
    """States of a chain, each adding up to one: ``first``, then (state before @ move) * emit.

    Products of transitions are associative: blocks of lines, as many as a block is long, are
    multiplied out side by side, their products passed on from block to block, and then all
    blocks walked through side by side.  So n lines take some multiples of sqrt(n) steps.
    """
    n = len(emit)
    size = max(1, int(np.ceil(np.sqrt(n - 1))))
    blocks = -(-(n - 1) // size)
    lines = np.ones((blocks * size, 2))
    lines[: n - 1] = emit[1:]
    lines = lines.reshape(blocks, size, 2)
    whole = np.tile(np.eye(2), (blocks, 1, 1))
    for s in range(size):
        whole = (whole @ move) * lines[:, s, None, :]
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    begin = np.empty((blocks, 2))
    now = first / first.sum()
    states = np.empty((1 + blocks * size, 2))
    states[0] = now
    for b in range(blocks):
        begin[b] = now
        now = now @ whole[b]
        now = now / now.sum()
    walked = states[1:].reshape(blocks, size, 2)
    now = begin
    for s in range(size):
        now = (now @ move) * lines[:, s]
        now = now / now.sum(axis=1, keepdims=True)
        walked[:, s] = now
    return states[:n]


def long_marginals(scores: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals as ``forward_backward`` gives them, of one text of very many lines."""
    good = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    emit, move = np.stack((1 - good, good), axis=1), np.exp(step)
    forward = along_chain(emit, move, np.exp(start) * emit[0])
    backward = along_chain(emit[::-1], move.T, emit[-1])[::-1]
    behind = np.ones_like(emit)
    behind[:-1] = backward[1:] @ move.T
    both = forward * behind
    return both / both.sum(axis=1, keepdims=True)


@dataclass
class LineField:
    """Weights of the chain and the scaling of its features."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    step: np.ndarray
    start: np.ndarray

    def marginals(self, x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        scores = with_neighbours((x - self.mean) / self.spread, per_text) @ self.weights
        good = np.empty(len(scores))
        long = per_text > LONG_LINES
        within = np.repeat(long, per_text)
        if not long.all():
            good[~within] = forward_backward(scores[~within], per_text[~long], self.step, self.start)[0][:, 1]
        begins = np.cumsum(per_text) - per_text
        for a, n in zip(begins[long], per_text[long], strict=True):
            good[a : a + n] = long_marginals(scores[a : a + n], self.step, self.start)[:, 1]
        return good

    def score(self, texts: list[str]) -> np.ndarray:
        """Quality of each text: line marginals weighted by line length plus one."""
        out = np.empty(len(texts))
        for part in slices(texts, _CHUNK_CHARS):
            x, lengths, per_text = line_features(texts[part])
            good, weight = self.marginals(x, per_text), lengths + 1.0
            at = np.cumsum(per_text) - per_text
            out[part] = np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)
        return np.clip(out, 0, 1)


def train_field(
    x: np.ndarray, per_text: np.ndarray, y: np.ndarray, rounds: int = 150, decay: float = 1e-3
) -> LineField:
    """Fit by gradient ascent on the conditional log-likelihood, documents weighted alike."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    f = with_neighbours((x - mean) / spread, per_text)
    p = {"w": np.zeros(f.shape[1]), "step": np.zeros((2, 2)), "start": np.zeros(2)}
    adam = Adam(p, 0.05)
    of_line, share = np.repeat(y, per_text), np.repeat(1 / per_text, per_text)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = ((per_text - 1) / per_text)[y == k].sum()
    at, n = np.cumsum(per_text) - per_text, len(y)
    for _ in range(rounds):
        marginal, pairs = forward_backward(f @ p["w"], per_text, p["step"], p["start"])
        gap = (of_line - marginal[:, 1]) * share
        edge = np.stack((1 - y, y), axis=1) - marginal[at]
        adam.step(
            {
                "w": -(f.T @ gap) / n + decay * p["w"],
                "step": -(seen - pairs) / n + decay * p["step"],
                "start": -edge.mean(0) + decay * p["start"],
            }
        )
    return LineField(mean, spread, p["w"], p["step"], p["start"])


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS
) -> LineField:
    """Train on a bounded sample of labelled rows; features are taken on the executors.

    Without any labelled row every document is good, with one class only that class is.
    """

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            short = batch[batch["text"].str.count("\n") < SAMPLE_LINES]
            for part in slices(list(short["text"]), _CHUNK_CHARS):
                rows = short.iloc[part]
                x, _, per_text = line_features(list(rows["text"]))
                cuts = np.split(x, np.cumsum(per_text)[:-1])
                yield pd.DataFrame({"y": rows["y"].to_numpy(), "x": [c.tobytes() for c in cuts]})

    sample = labelled_sample(docs, labels, label, most)
    rows = sample.mapInPandas(featured, "y int, x binary").orderBy("x", "y").toPandas()
    width = line_features([""])[0].shape[1]
    if rows.empty:
        bias = np.zeros(3 * width + 3)
        bias[-1] = 3
        return LineField(np.zeros(width), np.ones(width), bias, np.zeros((2, 2)), np.zeros(2))
    lines = [np.frombuffer(b, np.float32).reshape(-1, width) for b in rows["x"]]
    per_text = np.array([len(a) for a in lines])
    return train_field(np.vstack(lines).astype(float), per_text, rows["y"].to_numpy())


def score_quality(docs: DataFrame, model: LineField, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, in one narrow pass.

    A null text counts as empty; an empty text is one empty line and is scored like any
    other.  Repeated rows are scored alike, an empty table gives no rows, and columns
    beside doc_id and text are not looked at.
    """
    schema = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": model.score(list(batch["text"])),
                }
            )

    rows = docs.select(
        "doc_id", held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    )
    out = rows.mapInPandas(scored, f"doc_id {schema}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: LineField, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.score(list(batch)))

    return docs.filter(score(F.coalesce("text", F.lit(""))) >= threshold)
