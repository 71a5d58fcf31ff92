"""Benchmark decontamination with DataFrame functions alone.

A window of w words always holds a run of b = (w + 1) // 2 words that begins at a multiple
of w - b + 1.  So a document looks up only those aligned runs, by hash, in the set of all
runs of b words of the benchmark; where one is found, the windows around it are compared
word for word with the benchmark's windows.  (Arrays are exploded with the outer form:
the optimiser would put a filter on their size below, and make them twice.)  The set of hashes is broadcast while a
measurement proves it small; a larger one is joined by shuffle, with the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import bounded_broadcast, fits_broadcast, unique_lookup

WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What a word is made of, in lower case and before that.
_LOWERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of a text column with A-Z in lower case; a null text has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(_LOWERED), F.lit(0))


def _joined(words: Column, start: Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def _starts(first: Column | int, last: Column, step: int = 1) -> Column:
    """first, first + step, ... up to last; nothing when last is before first."""
    first = F.lit(first) if isinstance(first, int) else first
    some = F.sequence(first, last, F.lit(step))
    return F.when(last >= first, some).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """_window (its words), _size (their number) and _items (ids) of every distinct window.

    An item of fewer words than a window is one window; one without words has none.
    """
    words = benchmark.select("item_id", words_of("text").alias("_words"))
    words = words.filter(F.size("_words") > 0).withColumn("_size", F.least(F.lit(window), F.size("_words")))
    at = _starts(0, F.size("_words") - F.col("_size"))
    windows = words.select("item_id", "_size", F.explode_outer(F.transform(at, lambda i: _joined(F.col("_words"), i, F.col("_size")))).alias("_window"))
    return windows.groupBy("_window", "_size").agg(F.collect_set(F.col("item_id").cast("string")).alias("_items"))


def _run(size: int) -> tuple[int, int]:
    """Length of the aligned runs for windows of a size, and their distance."""
    length = (size + 1) // 2
    return length, size - length + 1


def _run_hashes(windows: DataFrame, size: int) -> DataFrame:
    """Distinct hashes of all runs in the windows of one size."""
    length, _ = _run(size)
    words = F.split("_window", " ")
    at = _starts(0, F.size(words) - length)
    hashes = F.transform(at, lambda i: F.xxhash64(_joined(words, i, length)))
    return windows.filter(F.col("_size") == size).select(F.explode_outer(hashes).alias("_hash")).distinct()


def _aligned(words: Column, size: int) -> Column:
    length, step = _run(size)
    return _starts(0, F.size(words) - length, step)


def _around(at: Column, words: Column, size: int) -> Column:
    """Starts of the windows of a size that hold the aligned run at ``at``, but no earlier one."""
    step = _run(size)[1]
    return _starts(F.greatest(F.lit(0), at - step + 1), F.least(at, F.size(words) - size))


def _candidates(rows: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """_row, _start and _w of the windows of one size around aligned runs that the benchmark has."""
    length, _ = _run(size)
    words = F.col("_words")

    def around(at: Column) -> Column:
        return F.transform(
            _around(at, words, size), lambda i: F.struct(i.alias("s"), _joined(words, i, size).alias("w"))
        )

    def looked_up(at: Column) -> Column:
        return F.struct(at.alias("at"), F.xxhash64(_joined(words, at, length)).alias("h"))

    hashes = _run_hashes(windows, size)
    aligned = _aligned(words, size)
    if fits_broadcast(hashes):
        # the words stay with their row: a run meets the hash set where its text was read
        runs = rows.select("_row", "_words", F.transform(aligned, looked_up).alias("_runs"))
        runs = runs.select("_row", "_words", F.explode_outer("_runs").alias("_run"))
        hit = runs.join(F.broadcast(hashes), F.col("_run.h") == F.col("_hash"), "left_semi")
        found = hit.select("_row", around(F.col("_run.at")).alias("_a"))
    else:
        # a run takes the windows around it along instead
        sent = F.transform(aligned, lambda at: F.struct(looked_up(at)["h"].alias("h"), around(at).alias("a")))
        runs = rows.select("_row", sent.alias("_runs")).select("_row", F.explode_outer("_runs").alias("_run"))
        hit = runs.join(hashes, F.col("_run.h") == F.col("_hash"), "left_semi")
        found = hit.select("_row", F.col("_run.a").alias("_a"))
    found = found.select("_row", F.explode_outer("_a").alias("_x")).filter(F.col("_x.w").isNotNull())
    return found.select("_row", F.col("_x.s").alias("_start"), F.col("_x.w").alias("_w"))


def covered(spans: Column) -> Column:
    """Disjoint spans, in order, that cover the same places as sorted spans (s, e)."""
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))),
        )
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["e"] < x["s"])
        return F.when(apart, F.concat(done, F.array(x))).otherwise(joined)

    return F.aggregate(spans, empty, step)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans and items of every row of ``docs``.

    ``spans`` are the disjoint runs (s, e) of words, from 0, e exclusive, that lie in an
    occurrence of a benchmark window; ``items`` the sorted ids, as text, of the items whose
    windows occur.  A null text has no words.  Repeated rows get equal results, an empty
    benchmark hits nothing, an empty table gives no rows; other columns are not looked at.
    """
    windows = stage(benchmark_windows(benchmark, window), "windows")
    sizes = sorted(r["_size"] for r in windows.select("_size").distinct().collect())
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_row")
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_CASED)).cast("bigint")
    base = docs.select(row, "doc_id", count.alias("n_words"))
    rows = docs.select(row, words_of("text").alias("_words"))
    no_hits = "_r bigint, _spans array<struct<s:int,e:int>>, _sets array<array<string>>"
    hits = docs.sparkSession.createDataFrame([], no_hits)
    if sizes:
        found = reduce(DataFrame.unionByName, (_candidates(rows, windows, size) for size in sizes))
        small = fits_broadcast(windows)
        exact = found.join(F.broadcast(windows) if small else windows, F.col("_w") == F.col("_window"))
        span = F.struct(F.col("_start").alias("s"), (F.col("_start") + F.col("_size")).alias("e"))
        hits = exact.groupBy(F.col("_row").alias("_r")).agg(
            F.collect_set(span).alias("_spans"), F.collect_set("_items").alias("_sets")
        )  # a document's own places, at most as many as it has words
        hits = stage(hits, "hits")
    joined = unique_lookup(base, hits, "_row", "_r")
    none = F.array().cast("array<struct<s:int,e:int>>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(covered(F.array_sort("_spans")), none).alias("spans"),
        F.coalesce(F.array_sort(F.array_distinct(F.flatten("_sets"))), F.array().cast("array<string>")).alias("items"),
        F.col("_row").alias("row_hash"),
    )


def contamination_digest(found: DataFrame) -> DataFrame:
    """Counts of words hit and items met, and a digest of the items, of each row."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs."""
    found = find_contamination(docs, benchmark, window).filter(F.size("spans") > 0)
    gone = stage(found.select(F.col("row_hash").alias("_gone")).distinct(), "contaminated")
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    whole = docs.select(F.struct("*").alias("_row"), row.alias("_hash"))
    same = F.col("_hash") == F.col("_gone")
    return whole.join(bounded_broadcast(gone), same, "left_anti").select("_row.*")


def cut_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text with every hit run of words cut out, for rows that have one or none.

    A cut reaches from the first hit word to the one after the last, so the text between
    words goes with the word before it.
    """
    found = find_contamination(docs, benchmark, window).filter(F.size("spans") > 0)
    spans = stage(found.select(F.col("row_hash").alias("_r"), "spans").dropDuplicates(["_r"]), "cuts")
    row = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_row")
    joined = unique_lookup(docs.select("doc_id", "text", row), spans, "_row", "_r")
    # what follows each word up to the next belongs to it; the piece before the first to none
    text = F.coalesce("text", F.lit(""))
    lead = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    units = F.regexp_extract_all(text, F.lit(_CASED + r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    kept = F.filter(units, lambda _, i: ~F.exists("spans", lambda x: (x["s"] <= i) & (i < x["e"])))
    cut = F.when(F.col("_r").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return joined.select("doc_id", cut.alias("text"))
