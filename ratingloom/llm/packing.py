"""Packing of tokenised documents into sequences by minimum bin slack.

For one sequence after another, a subset-sum over the lengths still available, held as a
bit set, finds the fullest combination that fits beside the longest remaining piece;
that combination is taken as often as the supply allows.  Only how many pieces have each
length matters, so the choice needs one histogram of at most ``capacity`` rows.  Pieces
are then numbered within their length, without gathering them, and each looks up the
sequence its number falls to.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import bounded_broadcast

CAPACITY = 1024
END_ID = 2
# Pieces of text that a worker remembers the ids of, before it starts afresh.
_REMEMBERED = 200_000
_SPECIAL, _SPECIAL_ID = "<|endoftext|>", 50256

# The vocabulary's own splitting rule where letters are Latin up to U+024F and nothing else
# beyond ASCII occurs; other texts go through the complete rule.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+", re.ASCII
)
_FOREIGN = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ɏ]")


class Encoder(dict):
    """Text to little-endian 32-bit ids; remembers the ids of the pieces texts split into."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        ranks = {}
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            for line in lines:
                piece, rank = line.split()
                ranks[base64.b64decode(piece)] = int(rank)
        self.whole = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.whole._encode_single_piece(piece), "<u4").tobytes()
        if len(self) >= _REMEMBERED:
            self.clear()
        self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if _SPECIAL in text:
            mark = np.array([_SPECIAL_ID], "<u4").tobytes()
            return mark.join(self.ids(part) for part in text.split(_SPECIAL))
        if _FOREIGN.search(text):
            return np.array(self.whole.encode_ordinary(text), "<u4").tobytes()
        return b"".join(map(self.__getitem__, _SPLIT.findall(text)))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of a vocabulary, loaded once per process."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first of several may be short."""
    first = size if size <= capacity else size % capacity or capacity
    starts = [0, *range(first, size, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], size], strict=True)]


@dataclass
class Share:
    """Pieces of one length, by number: from ``first`` on, ``times`` go to each of some sequences."""

    first: int
    times: int
    sequence: int
    offset: int


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """Lengths, with multiplicities, whose sum is the largest up to ``room``.

    ``reach`` has bit s set if some choice of the lengths so far sums to s.  Lengths come
    longest first, so walking back uses short pieces only where longer ones cannot do.
    """
    reach, mask, seen = 1, (1 << room + 1) - 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        seen.append((length, reach))
        left, step = min(int(counts[length]), room // length), 1
        while left:
            step = min(step, left)
            reach |= reach << step * length & mask
            left, step = left - step, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(seen):
        while not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan_sequences(histogram: dict[int, int], capacity: int) -> dict[int, list[Share]]:
    """Which sequences the pieces of each length go to, and where in them."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used = np.zeros(capacity + 1, np.int64)
    shares: dict[int, list[Share]] = {}
    sequence = 0
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        chosen = fullest(counts, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        again = min(int(counts[length]) // times for length, times in chosen.items())
        offset = 0
        for length, times in sorted(chosen.items(), reverse=True):
            shares.setdefault(length, []).append(
                Share(int(used[length]), times, sequence, offset)
            )
            used[length] += again * times
            counts[length] -= again * times
            offset += length * times
        sequence += again
    return shares


def tokenised(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k",
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document, numbered within their length and the task that made them."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part = encoder(vocabulary).ids, TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(own), part, int(made[length]))
                    rows.append((*row, own) if with_ids else row)
                    made[length] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_number"]
            out = pd.DataFrame(rows, columns=names + ["ids"] * with_ids)
            yield out if kind == "string" else out.astype({"doc_id": batch["doc_id"].dtype})
        encoder(vocabulary).clear()  # workers live on, what they remember need not

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
    schema += "_part int, _number bigint" + (", ids binary" if with_ids else "")
    return rows.mapInPandas(split, schema)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k",
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence and its place there; ``with_ids`` adds the ids themselves.

    A null text counts as empty: its document is the end id alone.  Texts of any length
    are cut whole; equal rows are packed as rows of their own, an empty table gives no
    pieces, and columns beside doc_id and text are not looked at.  Pieces are written
    once, so that their numbers stay what they are when tasks run again.
    """
    pieces = stage(tokenised(docs, capacity, vocabulary, end_id, with_ids), "pieces")
    by_task = pieces.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select(
        F.col("_part").alias("_p"),
        F.col("length").alias("_l"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    tables = {
        length: tuple(
            np.array([getattr(s, name) for s in shares], np.int64)
            for name in ("first", "times", "sequence", "offset")
        )
        for length, shares in plan_sequences(histogram, capacity).items()
    }
    given = docs.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        lengths, numbers = length.to_numpy(), number.to_numpy()
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for one in np.unique(lengths):
            at = np.flatnonzero(lengths == one)
            first, times, begin, place = given.value[int(one)]
            share = np.searchsorted(first, numbers[at], side="right") - 1
            turn = numbers[at] - first[share]
            sequence[at] = begin[share] + turn // times[share]
            offset[at] = place[share] + turn % times[share] * one
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    on = (F.col("_part") == F.col("_p")) & (F.col("length") == F.col("_l"))
    numbered = pieces.join(bounded_broadcast(before), on, "left")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    at = placed("length", F.col("_before") + F.col("_number"))
    return numbered.select(*names, at.alias("_at")).select(*names, "_at.sequence_id", "_at.offset")
