"""Divergence of sources by their terms, with the vocabulary found by iceberg prefix refinement.

A term counts for a language if enough of its documents hold it, and most distinct terms
of a corpus do not.  No document holds a term without each of its byte prefixes, so the
vocabulary is refined: prefixes of a few bytes are counted first, those in too few
documents are discarded with all that begins with them, and the terms left are extended
to prefixes twice as long, until only complete terms remain.  Counters of rare terms are
never shuffled, and the levels grow with the logarithm of the longest frequent term.

A document's distinct terms lie sorted, each with the number of bytes it shares with the
one before: a term is its document's first with a prefix exactly if it shares less than
that prefix.  So documents are counted once per prefix without gathering any.

Sources of a language are compared by exact integer arithmetic over blocks of terms and
blocks of sources; a block's matrix is bounded, whatever the vocabulary or the sources.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import bounded_broadcast, fits_broadcast
from ratingloom.operators.position import row_position

# A term is kept where at least so many documents of its language hold it.
LEAST_DOCUMENTS = 10
# Bytes of the first level's prefixes; every further level doubles them.
FIRST_BYTES = 4
# Ranks that the terms of a group are reported to.
TOP_TERMS = 10
# Terms and sources of a block, about.
BLOCK_TERMS, BLOCK_SOURCES = 4096, 128

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_HEAD, _WHOLE = 16, 8
_FLUSH = 200_000
_WORDS = "lang bigint, _g bigint, t binary, s int, p bigint, n int, d int"


def term_heads(terms: pa.BinaryArray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first eight bytes of each term as one number, the first byte in front, and the
    bytes that it shares with the term before: 0 where ``opens`` says a document begins)."""
    offsets, data = (np.frombuffer(b, t) for b, t in zip(terms.buffers()[1:], (np.int32, np.uint8), strict=True))
    data = np.append(data, np.zeros(_HEAD, np.uint8))  # terms hold no zero bytes
    first, size = offsets[: len(terms)], np.diff(offsets[: len(terms) + 1])
    heads = np.lib.stride_tricks.sliding_window_view(data, _HEAD)[first]
    inside = np.arange(_HEAD) < np.minimum(size[1:], size[:-1])[:, None]
    differ = (heads[1:] != heads[:-1]) | ~inside
    shared = np.zeros(len(terms), np.int32)
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), _HEAD)
    shared[opens] = 0
    for i in np.flatnonzero(shared == _HEAD):
        shared[i] = len(os.path.commonprefix((terms[i - 1].as_py(), terms[i].as_py())))
    front = np.where(np.arange(_WHOLE) < size[:, None], heads[:, :_WHOLE], 0).astype(np.uint8)
    return front.view(">i8").reshape(-1).astype(np.int64), shared


def document_terms(rows: DataFrame) -> DataFrame:
    """lang, _g and, sorted, the distinct terms of each row's text: ``t``, its bytes ``s``, the
    first eight of them as a number ``p``, its occurrences ``n`` and ``d``, the bytes it shares
    with the term before.

    Terms are runs of letters A-Z (lower-cased), a-z and all code points beyond ASCII.
    """

    def packed(langs, groups, terms, counts, sizes) -> pa.RecordBatch:
        sizes = np.array(sizes, np.int32)
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        terms = pa.array(terms, pa.binary())
        heads, shared = term_heads(terms, begins[sizes > 0])
        lengths = np.diff(np.frombuffer(terms.buffers()[1], np.int32)[: len(terms) + 1])
        columns = [np.repeat(np.array(ids, np.int64), sizes) for ids in (langs, groups)]
        columns += [terms, lengths, heads, np.array(counts, np.int32), shared]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "_g", "t", "s", "p", "n", "d"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, groups = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            terms, counts, sizes, first = [], [], [], 0
            for i, text in enumerate(batch.column(2)):
                found = Counter(_TERM.findall(text.as_buffer().to_pybytes().lower()))
                own = sorted(found)
                terms += own
                counts += map(found.__getitem__, own)
                sizes.append(len(own))
                if len(terms) > _FLUSH:
                    yield packed(langs[first : i + 1], groups[first : i + 1], terms, counts, sizes)
                    terms, counts, sizes, first = [], [], [], i + 1
            if terms:
                yield packed(langs[first:], groups[first:], terms, counts, sizes)

    return rows.select("lang", "_g", "text").mapInArrow(made, _WORDS)


def _prefix(at: int) -> Column:
    """The first ``at`` bytes of a term: a number, zeros behind a shorter term, or the bytes."""
    if at > _WHOLE:
        return F.substring("t", 1, at)
    return F.col("p").bitwiseAND(F.lit(-1 << 8 * (_WHOLE - at)))


def refine_prefixes(words: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, t of every term that at least ``least`` documents of its language hold.

    ``words`` is a staged ``document_terms``, read once per level.  Prefixes that survived a
    level prune the next one's rows where they measure small enough to broadcast; beyond
    that the level counts unpruned, and its threshold leaves the same.
    """
    rows = words.select("lang", "t", "s", "p", "d")
    size, at, before = F.col("s"), FIRST_BYTES, None
    levels = []
    while True:
        longer = rows if before is None else rows.filter(size > at // 2)
        if before is not None and fits_broadcast(before):
            same = (F.col("lang") == F.col("_l")) & (_prefix(at // 2) == F.col("_p"))
            longer = longer.join(F.broadcast(before), same, "left_semi")
        counted = (
            longer.groupBy("lang", _prefix(at).alias("_key"))
            .agg(
                F.count_if((size >= at) & (F.col("d") < at)).alias("_docs"),
                F.count_if(size <= at).alias("_own"),
                F.max(F.when(size <= at, size)).alias("_size"),
            )
            .filter((F.col("_docs") >= least) | (F.col("_own") >= least))
        )
        level = stage(counted, "prefixes")
        whole = F.substring(F.unhex(F.hex("_key")), 1, F.col("_size")) if at <= _WHOLE else F.col("_key")
        levels.append(level.filter(F.col("_own") >= least).select("lang", whole.alias("t")))
        # a prefix goes on while documents enough hold what begins with it
        before = level.filter(F.col("_docs") >= least).select(F.col("lang").alias("_l"), F.col("_key").alias("_p"))
        if before.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        at *= 2


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), in decimals so that no count overflows."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10, 0)) * ({n} + 2)) div nullif({total} + 2 * {kept}, 0)")


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """Summed divergence over a block's terms of every pair of its sources, each pair once."""
    lang, bucket, i, j, kept = (block[c].iloc[0] for c in ("lang", "_bucket", "_i", "_j", "_kept"))
    block = block.sort_values("source")
    rest = block["_p0"].fillna(0).to_numpy(np.int64)
    held = [[] if x is None else x for x in block["_cells"]]
    places = [np.array([c["place"] for c in x], np.int64) for x in held]
    present = np.unique(np.concatenate(places))
    p = np.repeat(rest[:, None], len(present), axis=1)
    for k, x in enumerate(held):
        p[k, np.searchsorted(present, places[k])] = [c["p"] for c in x]
    sources, side = block["source"].tolist(), block["_side"].to_numpy()
    out = []
    for k, name in enumerate(sources):
        others = np.arange(k + 1, len(sources))
        if i != j:
            others = others[side[others] != side[k]]
        if not len(others):
            continue
        value = ((p[others] - p[k]) ** 2 // (p[others] + p[k])).sum(axis=1)
        if kept > len(present):
            value += (kept - len(present)) * ((rest[others] - rest[k]) ** 2 // (rest[others] + rest[k]))
        out += [(lang, name, sources[o], int(v)) for o, v in zip(others, value, strict=True)]
    return pd.DataFrame(out, columns=["lang", "_a", "_b", "_value"])


def audit_sources(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how the sources of each language differ.

    A group is a language and a source.  ``p`` of a term is its smoothed share of the
    group's kept terms in billionths, ``q`` that of the other side, and (p-q)^2/(p+q) how
    far they lie apart.  Part ``pair`` has the sum over all kept terms for each other
    source of the language; part ``term`` the ``top`` terms that the group holds more
    often than its language.  Values fall with the rank; ties go by item.

    Every row counts as a document; repeated rows are documents of their own.  Null texts,
    languages and sources are empty ones.  Groups without kept terms have pairs too, of
    value 0 if the language keeps no term.  An empty table gives no rows; columns beside
    lang, source and text are not looked at.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # numbers stand for languages, groups and terms wherever occurrences are counted
    held = stage(docs.select(F.col("lang").alias("_name"), F.col("source").alias("_of")).distinct(), "sources")
    names = stage(held.select("_name").distinct().withColumn("_l", F.monotonically_increasing_id()), "names")
    held = held.join(bounded_broadcast(names), "_name").withColumn("_g", F.monotonically_increasing_id())
    held = stage(held, "groups")
    groups = held.select(F.col("_l").alias("lang"), F.col("_of").alias("source"), "_g")
    same = (F.col("lang") == F.col("_name")) & (F.col("source") == F.col("_of"))
    rows = docs.join(bounded_broadcast(held), same).select(F.col("_l").alias("lang"), "_g", "text")
    # a task has few groups, so that what it counts adds up to few numbers; large groups have many tasks
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange("lang", "_g", "_at")
    words = stage(document_terms(rows), "terms")
    kept = refine_prefixes(words, least)
    terms = stage(row_position(kept, ["lang", "t"], "_no"), "numbered-terms")  # in the order of their bytes

    sizes = terms.groupBy("lang").agg(F.count("*").alias("_v"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("_sources"))
    langs = stage(sources.join(sizes, "lang", "left").na.fill(0, ["_v"]), "languages")

    rows = words.select("lang", "_g", "t", "n")
    if fits_broadcast(terms):
        counts = rows.join(F.broadcast(terms), ["lang", "t"]).groupBy("_g", "_no").agg(F.sum("n").alias("n"))
        counts = counts.join(bounded_broadcast(groups), "_g")
    else:  # what is shuffled has been added up, and hashes leave out most of the rare terms
        hashes = terms.select(F.xxhash64("lang", "t").alias("_h"))
        if fits_broadcast(hashes):
            rows = rows.join(F.broadcast(hashes.distinct()), F.xxhash64("lang", "t") == F.col("_h"), "left_semi")
        counts = rows.groupBy("_g", "t").agg(F.sum("n").alias("n"))
        counts = counts.join(bounded_broadcast(groups), "_g").join(terms, ["lang", "t"])
    counts = stage(counts.select("lang", "source", "_no", "n"), "term-counts")

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("_total"))
    groups = groups.drop("_g").join(totals, ["lang", "source"], "left").join(bounded_broadcast(langs), "lang")
    groups = groups.na.fill(0, ["_total"]).withColumn("_zero", F.lit(0).cast("bigint"))
    groups = stage(groups.withColumn("_p0", _share("_zero", "_total", "_v")).drop("_zero"), "group-totals")
    both = counts.groupBy("lang", "_no").agg(F.sum("n").alias("_both"))
    all_of = counts.groupBy("lang").agg(F.sum("n").alias("_all")).join(langs, "lang")
    both = both.join(bounded_broadcast(all_of), "lang").select("lang", "_no", _share("_both", "_all", "_v").alias("_q"))
    both = stage(both, "shares")
    shares = counts.join(bounded_broadcast(groups.select("lang", "source", "_total", "_v")), ["lang", "source"])
    shares = shares.withColumn("_p", _share("n", "_total", "_v"))

    over = shares.join(bounded_broadcast(both), ["lang", "_no"]).filter("_p > _q")
    over = over.select("lang", "source", "_no", _apart("_p", "_q").alias("value"))
    highest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "_no")
    best = over.withColumn("rank", F.row_number().over(highest)).filter(F.col("rank") <= top)
    best = stage(best, "best-terms").join(terms.select("_no", F.col("t").cast("string").alias("item")), "_no").drop("_no")

    bucket, place = F.floor(F.col("_no") / BLOCK_TERMS), F.col("_no") % BLOCK_TERMS
    cells = shares.groupBy("lang", bucket.alias("_bucket"), "source").agg(
        F.collect_list(F.struct(place.alias("place"), F.col("_p").alias("p"))).alias("_cells")
    )  # as many as a block has terms
    filled = stage(terms.groupBy("lang", bucket.alias("_bucket")).agg(F.count("*").alias("_kept")), "buckets")
    blocks = F.ceil(F.col("_sources") / BLOCK_SOURCES).cast("int")
    laid = (
        groups.join(bounded_broadcast(filled), "lang", "left")
        .na.fill(0, ["_bucket", "_kept"])
        .join(cells, ["lang", "_bucket", "source"], "left")
        .withColumn("_side", F.pmod(F.xxhash64("source"), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("_i", F.least("_side", "_other"))
        .withColumn("_j", F.greatest("_side", "_other"))
        .select("lang", "source", "_bucket", "_side", "_i", "_j", "_p0", "_kept", "_cells")
    )
    parts = laid.groupBy("lang", "_bucket", "_i", "_j").applyInPandas(
        _block_pairs, "lang bigint, _a string, _b string, _value bigint"
    )
    pairs = stage(parts.groupBy("lang", "_a", "_b").agg(F.sum("_value").alias("value")), "source-pairs")
    ways = [pairs.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), "value") for a, b in (("_a", "_b"), ("_b", "_a"))]
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = ways[0].unionByName(ways[1]).withColumn("rank", F.row_number().over(first))
    parts = [frame.withColumn("part", F.lit(name)) for frame, name in ((ranked, "pair"), (best, "term"))]
    found = parts[0].unionByName(parts[1]).join(bounded_broadcast(names), F.col("lang") == F.col("_l"))
    return found.select(F.col("_name").alias("lang"), "source", "part", "item", "value", "rank")
