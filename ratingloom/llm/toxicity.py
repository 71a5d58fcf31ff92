"""Toxicity from a bidirectional gated recurrent network over overlapping word windows.

A word enters as a learned vector of its own (hashed) beside the mean of learned vectors
of its character trigrams, so unseen spellings share what their parts have taught.  Both
directions run over windows of words that overlap; attention pools the states of a
window, a logistic unit scores it, and a text scores as its most toxic window.  Training
is plain numpy: labels belong to whole texts, so after a first round over windows spread
over each text it is represented by the windows that score highest of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import (
    Adam,
    code_points,
    held_out,
    labelled_sample,
    mixed,
    slices,
    spread,
    word_hashes,
)

# Training takes at most so many documents of each label, of at most so many code points.
SAMPLE_PER_CLASS = 1600
SAMPLE_CHARS = 9_000
# A window starts at every fourth word, so a passage of up to WINDOW - STRIDE + 1 = 29 words
# lies whole in one, wherever it stands.
WINDOW, STRIDE = 32, 4
# The first round of training takes one window in so many, the later ones rank all.
FIRST_APART = 6
_BUCKETS, _WORD_DIM, _CHAR_DIM, _HIDDEN, _ATTEND = 1 << 13, 8, 16, 8, 8
_CHUNK_CHARS = 1_000_000
_BLOCK = 2048


@dataclass
class Words:
    """Texts as runs of word numbers into a list of distinct words."""

    number: np.ndarray
    per_text: np.ndarray
    bucket: np.ndarray
    trigrams: np.ndarray
    trigrams_of: np.ndarray


_INSIDE = np.zeros(0x180, bool)
for _c in range(0x180):
    _INSIDE[_c] = chr(_c).isalnum()


def read_words(texts: list[str]) -> Words:
    """Lower-cased runs of letters and digits; beyond U+017F every code point is inside a word."""
    codes, begins = code_points([t.lower() for t in texts])
    inside = np.where(codes < 0x180, _INSIDE[np.minimum(codes, 0x17F)], True)
    start, end, hashes = word_hashes(codes, inside)
    per_text = np.diff(np.append(np.searchsorted(start, begins), len(start)))
    distinct, one, number = np.unique(hashes, return_index=True, return_inverse=True)
    first, size = start[one], (end - start)[one]
    # the trigrams of a word of n letters between a sign for its start and one for its end
    at = spread(first, size)
    place = at - np.repeat(first, size)
    before = np.where(place == 0, 1, codes[np.maximum(at - 1, 0)]).astype(np.uint64)
    after = np.where(place == np.repeat(size, size) - 1, 2, codes[at + 1]).astype(np.uint64)
    middle = codes[at].astype(np.uint64)
    gram = mixed(before << np.uint64(42) | middle << np.uint64(21) | after)
    return Words(
        number,
        per_text,
        (distinct % np.uint64(_BUCKETS)).astype(np.int64),
        (gram % np.uint64(_BUCKETS)).astype(np.int64),
        size,
    )


def window_places(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each window begins, where its text stops, and windows of each text.

    A text of up to WINDOW words, or none, has one window; the last one reaches the end.
    """
    n = words.per_text
    count = np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1
    begin = np.repeat(np.cumsum(n) - n, count) + STRIDE * spread(np.zeros(len(n), int), count)
    return begin, np.repeat(np.cumsum(n), count), count


def window_words(words: Words, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers by window and place, and which places are filled."""
    at = begin[:, None] + np.arange(WINDOW)
    filled = at < stop[:, None]
    if not len(words.number):
        return np.zeros(at.shape, np.int64), filled
    return np.where(filled, words.number[np.minimum(at, len(words.number) - 1)], 0), filled


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers by window and place, which places are filled, and windows of each text."""
    begin, stop, count = window_places(words)
    return *window_words(words, begin, stop), count


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


def only(words: Words, used: np.ndarray) -> Words:
    """The distinct words numbered ``used`` alone, in that order, without any text."""
    first, size = np.cumsum(words.trigrams_of) - words.trigrams_of, words.trigrams_of[used]
    grams = words.trigrams[spread(first[used], size)]
    return Words(words.number[:0], words.per_text[:0], words.bucket[used], grams, size)


class Detector:
    """The network's weights, its passes forward and back."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = _WORD_DIM + _CHAR_DIM, _HIDDEN
        shape = {
            "word": (_BUCKETS, _WORD_DIM), "char": (_BUCKETS, _CHAR_DIM),
            "in0": (d, 3 * h), "in1": (d, 3 * h), "bias0": (3 * h,), "bias1": (3 * h,),
            "gate0": (h, 2 * h), "gate1": (h, 2 * h), "cand0": (h, h), "cand1": (h, h),
            "look": (2 * h, _ATTEND), "query": (_ATTEND,), "out": (2 * h,), "shift": (1,),
        }
        self.p = {k: (r.standard_normal(s) * 0.3).astype(np.float32) for k, s in shape.items()}
        for k in ("bias0", "bias1", "shift"):
            self.p[k][:] = 0
        self.offset = 0.0

    def vectors(self, words: Words) -> np.ndarray:
        """One input vector for each distinct word."""
        if not len(words.bucket):
            return np.zeros((1, _WORD_DIM + _CHAR_DIM), np.float32)
        first = np.cumsum(words.trigrams_of) - words.trigrams_of
        chars = np.add.reduceat(self.p["char"][words.trigrams], first, axis=0)
        chars /= np.sqrt(words.trigrams_of)[:, None].astype(np.float32)
        return np.hstack((self.p["word"][words.bucket], chars))

    def score_windows(self, projected: list, numbers: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Logits of windows as ``run`` gives them, without what a pass back needs: every
        gate has arrays of its own, so that each step works on contiguous numbers."""
        p, h, n, half = self.p, _HIDDEN, len(numbers), np.float32(0.5)
        at, on = np.ascontiguousarray(numbers.T), np.ascontiguousarray(filled.T)
        full = on.all(axis=1)
        states = np.empty((2, WINDOW, n, h), np.float32)
        for way in (0, 1):
            # a sigmoid is half of one more than the tanh of the half
            both = np.split(p[f"gate{way}"] * half, 2, axis=1)
            reset_u, update_u = (np.ascontiguousarray(u) for u in both)
            parts = np.split(projected[way] * np.repeat(np.float32([0.5, 0.5, 1]), h), 3, axis=1)
            reset_x, update_x, cand_x = (np.ascontiguousarray(x) for x in parts)
            state = np.zeros((n, h), np.float32)
            for t in range(WINDOW) if way == 0 else range(WINDOW - 1, -1, -1):
                reset, update = state @ reset_u, state @ update_u
                for gate, x in ((reset, reset_x), (update, update_x)):
                    gate += x.take(at[t], axis=0)
                    np.tanh(gate, out=gate)
                    gate += 1
                    gate *= half
                reset *= state
                cand = reset @ p[f"cand{way}"]
                cand += cand_x.take(at[t], axis=0)
                np.tanh(cand, out=cand)
                new = np.subtract(state, cand, out=states[way, t])
                new *= update
                new += cand
                if way == 1 and not full[t]:
                    new *= on[t][:, None]
                state = new
        forward, backward = states.reshape(2, -1, h)
        looked = np.tanh(forward @ p["look"][:h] + backward @ p["look"][h:])
        weight = np.where(on, (looked @ p["query"]).reshape(WINDOW, n), np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        worth = (forward @ p["out"][:h] + backward @ p["out"][h:]).reshape(WINDOW, n)
        return (weight * worth).sum(0) / weight.sum(0) + p["shift"]

    def run(self, projected: list, numbers: np.ndarray, filled: np.ndarray, keep: bool = False):
        """Logits of windows; with ``keep`` also what the pass back needs."""
        p, h, n = self.p, _HIDDEN, len(numbers)
        states = np.zeros((WINDOW, n, 2 * h), np.float32)
        trace: list[list] = [[], []]
        for way in (0, 1):
            gate_u, cand_u = p[f"gate{way}"], p[f"cand{way}"]
            state = np.zeros((n, h), np.float32)
            for t in range(WINDOW) if way == 0 else range(WINDOW - 1, -1, -1):
                x, on = projected[way][numbers[:, t]], filled[:, t, None]
                gates = _sigmoid(x[:, : 2 * h] + state @ gate_u)
                reset, update = gates[:, :h], gates[:, h:]
                cand = np.tanh(x[:, 2 * h :] + (reset * state) @ cand_u)
                new = cand + update * (state - cand)
                if way == 1:  # empty places come first here and must leave no trace
                    new *= on
                if keep:
                    trace[way].append((t, state, reset, update, cand))
                state = new
                states[t, :, way * h : (way + 1) * h] = state
        looked = np.tanh(states @ p["look"])
        weight = np.where(filled.T, looked @ p["query"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ p["out"] + p["shift"]
        return (logit, (states, looked, weight, pooled, trace)) if keep else logit

    def project(self, words: Words) -> tuple[np.ndarray, list[np.ndarray]]:
        v = self.vectors(words)
        return v, [v @ self.p[f"in{w}"] + self.p[f"bias{w}"] for w in (0, 1)]

    def back(self, words, vectors, numbers, filled, kept, slope) -> dict[str, np.ndarray]:
        """Gradients of the parameters given the loss's slope on each window's logit."""
        p, h = self.p, _HIDDEN
        states, looked, weight, pooled, trace = kept
        g = {"out": pooled.T @ slope, "shift": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * p["out"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(0))
        g["query"] = np.einsum("tn,tna->a", d_energy, looked)
        d_look = d_energy[:, :, None] * p["query"] * (1 - looked**2)
        g["look"] = np.einsum("tnh,tna->ha", states, d_look)
        d_states = weight[:, :, None] * d_pooled + d_look @ p["look"].T
        d_vectors = np.zeros_like(vectors)
        for way in (0, 1):
            gate_u, cand_u = p[f"gate{way}"], p[f"cand{way}"]
            g_gate, g_cand = np.zeros_like(gate_u), np.zeros_like(cand_u)
            d_in = np.zeros((len(vectors), 3 * h), np.float32)
            carry = np.zeros((len(numbers), h), np.float32)
            for t, state, reset, update, cand in reversed(trace[way]):
                on = filled[:, t, None]
                live = carry + d_states[t, :, way * h : (way + 1) * h]
                if way == 1:
                    live = live * on
                d_cand = live * (1 - update) * (1 - cand**2)
                d_update = live * (state - cand) * update * (1 - update)
                d_held = d_cand @ cand_u.T
                d_reset = d_held * state * reset * (1 - reset)
                g_cand += (reset * state).T @ d_cand
                d_gates = np.hstack((d_reset, d_update))
                g_gate += state.T @ d_gates
                carry = live * update + d_held * reset + d_gates @ gate_u.T
                np.add.at(d_in, numbers[:, t], np.hstack((d_gates, d_cand)))
            g[f"gate{way}"], g[f"cand{way}"] = g_gate, g_cand
            g[f"in{way}"], g[f"bias{way}"] = vectors.T @ d_in, d_in.sum(0)
            d_vectors += d_in @ p[f"in{way}"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        size = words.trigrams_of
        share = d_vectors[:, _WORD_DIM:] / np.sqrt(size)[:, None].astype(np.float32)
        np.add.at(g["word"], words.bucket, d_vectors[:, :_WORD_DIM])
        np.add.at(g["char"], words.trigrams, np.repeat(share, size, axis=0))
        return g

    def logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows and the number of windows of each text."""
        begin, stop, count = window_places(words)
        projected = self.project(words)[1]
        parts = [
            self.score_windows(projected, *window_words(words, begin[i : i + _BLOCK], stop[i : i + _BLOCK]))
            for i in range(0, len(begin), _BLOCK)
        ]
        return np.concatenate(parts), count

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability that a text is toxic: that of its most toxic window."""
        out = np.empty(len(texts))
        for part in slices(texts, _CHUNK_CHARS):
            logit, count = self.logits(read_words(texts[part]))
            top = np.maximum.reduceat(logit, np.cumsum(count) - count)
            out[part] = _sigmoid(top.astype(float) + self.offset)
        return out


def train_detector(
    texts: list[str], y: np.ndarray, share: float, rounds: int = 6, seed: int = 7
) -> Detector:
    """Fit on texts with labels; ``share`` is the share of toxic texts to expect in use."""
    model, words = Detector(seed), read_words(texts)
    begin, stop, count = window_places(words)
    first, of_text = np.cumsum(count) - count, np.repeat(np.arange(len(count)), count)
    adam, r = Adam(model.p, 0.01), np.random.default_rng(seed)
    for k in range(rounds):
        adam.rate = 0.01 if k < rounds - 2 else 0.003
        if k < 1:
            offset = r.integers(np.minimum(count, FIRST_APART))
            within = np.arange(len(begin)) - np.repeat(first + offset, count)
            chosen = r.permutation(np.flatnonzero(within % FIRST_APART == 0))
        else:
            logit = model.logits(words)[0]
            ranked = np.lexsort((-logit, of_text))
            rank = np.arange(len(ranked)) - np.repeat(first, count)
            # a toxic text teaches by its top window, a clean one by its top four
            chosen = ranked[rank < np.where(np.repeat(y, count) == 1, 1, 4)]
            chosen = r.permutation(chosen)
        for at in range(0, len(chosen), 256):
            batch = chosen[at : at + 256]
            numbers, on = window_words(words, begin[batch], stop[batch])
            used, some = np.unique(numbers, return_inverse=True)
            part, some = only(words, used), some.reshape(-1, WINDOW)
            vectors, projected = model.project(part)
            logit, kept = model.run(projected, some, on, keep=True)
            slope = ((_sigmoid(logit) - y[of_text[batch]]) / len(batch)).astype(np.float32)
            adam.step(model.back(part, vectors, some, on, kept, slope))
    here = min(max(float(np.mean(y)), 1e-3), 1 - 1e-3)
    there = min(max(share, 1e-3), 1 - 1e-3)
    model.offset = np.log(there / (1 - there)) - np.log(here / (1 - here))
    return model


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS
) -> Detector:
    """Train on a bounded, balanced sample of labelled rows of bounded length.

    The share of toxic rows among all labelled rows corrects for the balancing.  Without
    labels of both kinds every text gets that share (0 where there are no labels).
    """
    sample = labelled_sample(docs, labels, label, per_class, balanced=True)
    rows = sample.filter(F.length("text") <= SAMPLE_CHARS).orderBy(F.xxhash64("text"), "y")
    known = labels.filter(F.col(label).isNotNull() & ~held_out())
    share = known.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    pairs = rows.toPandas()
    y = pairs["y"].to_numpy()
    if len(set(y)) < 2:
        model = Detector()
        model.p["out"][:] = 0
        model.offset = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return model
    return train_detector(list(pairs["text"]), y, share)


def score_toxicity(docs: DataFrame, model: Detector, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, in one narrow pass.

    A null text counts as empty and scores as one empty window.  Every window of a text
    of any length is scored; windows start STRIDE words apart, so every passage of up to
    WINDOW - STRIDE + 1 words lies whole in one.  Repeated rows are scored alike, an empty table gives no
    rows, and columns beside doc_id and text are not looked at.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

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
    out = rows.mapInPandas(scored, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
