"""Exact deduplication over a cuckoo-filter index of live digests.

A cuckoo filter holds a short fingerprint of each live digest in one of two buckets; it
answers most lookups alone, and unlike a Bloom filter it can forget a digest.  What it
says "maybe" to is verified against the full digest kept beside the fingerprint in the
bucket.  When an insertion finds no room the table is built anew at twice the size from
the stored keys.

Each task first folds its own rows through such an index, so a text that a third of all
rows repeat leaves every task once.  Digests are then dealt out by hash, and each bucket
of digests folds what arrives through an index of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import unique_lookup


class CuckooIndex:
    """Digests (bytes, well mixed) with a value each, under a cuckoo filter."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 64):
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints: list[list[int]] = [[] for _ in range(buckets)]
        self.stored: list[list[tuple[bytes, object]]] = [[] for _ in range(buckets)]
        self.size = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint and both buckets; either bucket and the fingerprint give the other."""
        mark = int.from_bytes(digest[:2], "little") + 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, first ^ (mark * 0x5BD1E995 & self.mask)

    def _slot(self, digest: bytes) -> tuple[int, int] | None:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            if mark in self.prints[bucket]:
                for slot, (known, _) in enumerate(self.stored[bucket]):
                    if known == digest:
                        return bucket, slot
        return None

    def get(self, digest: bytes):
        at = self._slot(digest)
        return None if at is None else self.stored[at[0]][at[1]][1]

    def put(self, digest: bytes, value) -> None:
        """Insert a digest, or set the value of one that is there."""
        at = self._slot(digest)
        if at is not None:
            self.stored[at[0]][at[1]] = (digest, value)
        else:
            self._insert(digest, value)

    def _insert(self, digest: bytes, value) -> None:
        mark, bucket, second = self._places(digest)
        if len(self.prints[bucket]) >= self.SLOTS and len(self.prints[second]) < self.SLOTS:
            bucket = second
        entry = (digest, value)
        for kick in range(self.KICKS):
            if len(self.prints[bucket]) < self.SLOTS:
                self.prints[bucket].append(mark)
                self.stored[bucket].append(entry)
                self.size += 1
                return
            slot = kick % self.SLOTS
            mark, self.prints[bucket][slot] = self.prints[bucket][slot], mark
            entry, self.stored[bucket][slot] = self.stored[bucket][slot], entry
            bucket ^= mark * 0x5BD1E995 & self.mask
        self._grow(entry)

    def _grow(self, left_over: tuple[bytes, object]) -> None:
        held = [entry for bucket in self.stored for entry in bucket] + [left_over]
        self._empty(2 * (self.mask + 1))
        for digest, value in held:
            self._insert(digest, value)

    def remove(self, digest: bytes) -> bool:
        """Forget a digest; whether it was there."""
        at = self._slot(digest)
        if at is None:
            return False
        bucket, slot = at
        del self.prints[bucket][slot], self.stored[bucket][slot]
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.stored:
            yield from bucket


# Digests that a task's index holds while folding its own rows, and that a bucket is given.
_HELD, _PER_BUCKET = 200_000, 200_000
_LIVE, _WITHDRAWN, _ADDED = 0, 1, 2


def _merged(a: tuple, b: tuple) -> tuple:
    """(top id, rows, rows with that id) of two parts of a group; a missing id is the smallest."""
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    first = a if b[0] is None or (a[0] is not None and a[0] > b[0]) else b
    return first[0], a[1] + b[1], first[2]


def _folded(batches: Iterator[pd.DataFrame], held: int | None) -> Iterator[pd.DataFrame]:
    """Fold rows by digest; with ``held``, hand on what is there whenever so many wait."""
    index = CuckooIndex()

    def out() -> pd.DataFrame:
        rows = [(digest, _ADDED, *value) for digest, value in index.items()]
        frame = pd.DataFrame(rows, columns=["_sha", "_turn", "_top", "_n", "_same"])
        frame["_top"] = frame["_top"].astype(object)
        return frame

    for batch in batches:
        tops = [None if pd.isna(t) else t for t in batch["_top"]]
        columns = (batch[c].tolist() for c in ("_n", "_same", "_turn"))
        for digest, top, n, same, turn in zip(batch["_sha"], tops, *columns, strict=True):
            if turn == _WITHDRAWN:
                index.remove(digest)
                continue
            known, new = index.get(digest), (top, n, same)
            index.put(digest, new if known is None else _merged(known, new))
        if held and index.size >= held:
            yield out()
            index = CuckooIndex()
    yield out()


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """Fold rows by digest, each bucket of digests in a task with an index of its own."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(max(tasks, -(-n // _PER_BUCKET)), "_sha")
    folded = dealt.sortWithinPartitions("_turn").mapInPandas(lambda b: _folded(b, None), rows.schema)
    return folded.drop("_turn")


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per digest for staged rows (_sha, _id).

    _top is the largest id, _n the number of rows, _same the number of rows with _top.
    """
    one = F.lit(1).cast("bigint")
    parts = rows.select(
        "_sha", F.lit(_ADDED).alias("_turn"), F.col("_id").alias("_top"),
        one.alias("_n"), one.alias("_same"),
    )
    return _dealt(parts.mapInPandas(lambda b: _folded(b, _HELD), parts.schema), rows.count())


def update_groups(groups: DataFrame, added: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """Groups after the digests of ``withdrawn`` (_sha) go and the groups ``added`` come."""
    columns = ["_sha", "_turn", "_top", "_n", "_same"]
    gone = withdrawn.select("_sha").distinct().withColumn("_turn", F.lit(_WITHDRAWN))
    parts = groups.withColumn("_turn", F.lit(_LIVE)).select(columns)
    parts = parts.unionByName(gone, allowMissingColumns=True)
    parts = parts.unionByName(added.withColumn("_turn", F.lit(_ADDED)).select(columns))
    return _dealt(parts.select(columns), groups.count() + added.count())


def _digest():
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))


def _digests_and_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged: id and digest of every row, and the groups of two and more."""
    rows = stage(docs.select(_digest().alias("_sha"), F.col("doc_id").alias("_id")), "digests")
    groups = digest_groups(rows).filter(F.col("_n") > 1).withColumnRenamed("_sha", "_of")
    return rows, stage(groups, "copied-groups")


def mark_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when identical, a null text counting as empty; equality is that of
    SHA-256.  Of equal texts the row with the largest doc_id stays; rows that repeat both
    id and text are one document and marked alike; a null id is below all others.  An
    empty table gives no rows, and columns beside doc_id and text are not looked at.
    Only groups of two and more are joined back.
    """
    rows, groups = _digests_and_groups(docs)
    known = unique_lookup(rows, groups, "_sha", "_of")
    keep = F.when(F.col("_of").isNull(), F.col("_id")).otherwise(F.col("_top"))
    return known.select(
        F.col("_id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of every group of equal texts, with all its columns.

    That with the largest doc_id, as in ``mark_copies``; where rows repeat both id and
    text, any one of them.
    """
    groups = _digests_and_groups(docs)[1]
    whole = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), _digest().alias("_sha"))
    joined = unique_lookup(whole, groups, "_sha", "_of")
    kept = joined.filter(F.col("_of").isNull() | F.col("_id").eqNullSafe(F.col("_top")))
    if groups.filter(F.col("_same") > 1).isEmpty():
        return kept.select("_row.*")
    twice = F.coalesce(F.col("_same"), F.lit(1)) > 1
    once = kept.filter(twice).dropDuplicates(["_sha"])
    return kept.filter(~twice).select("_row.*").unionByName(once.select("_row.*"))
