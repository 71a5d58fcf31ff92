"""Lines of a split, an Arrow batch at a time, to the records they make up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def runs_of_splits(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where ``_split`` changes."""
    split = batch.column("_split").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(split)) + 1).tolist(), len(split)]
    yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def grouped_lines(lines: pa.Array, begins: np.ndarray, used: np.ndarray) -> tuple[list[str], pa.Array, list[str]]:
    """(lines in front of the first record that begins, all records but the last one, lines
    of the last one).  Lines that are not ``used`` drop out."""
    first = np.flatnonzero(begins)
    until = int(first[0]) if len(first) else len(begins)
    leading = lines.slice(0, until).filter(pa.array(used[:until])).to_pylist()
    if not len(first):
        return leading, pa.array([], pa.string()), []
    rest = lines.slice(until).filter(pa.array(used[until:]))
    cuts = (np.cumsum(used[until:]) - 1)[first - until]
    whole = rest.slice(0, int(cuts[-1]))
    if len(whole) > len(first) - 1:  # some have several lines
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), whole), "\n")
    return leading, whole, rest.slice(int(cuts[-1])).to_pylist()
