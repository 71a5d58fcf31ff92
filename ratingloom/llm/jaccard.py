"""Similarity self-join of documents on word shingles under several global token orders.

Two sets that overlap enough share a token among the first few of either set, whatever
global order ranks the tokens.  Rare tokens come first here, so documents that share only
common passages have no candidates at all.  To rank by frequency without moving every
token twice, orders put a fixed fraction of all tokens (those with the smallest hashes)
in front, rarest first, and only tokens a prefix can reach are ever counted: the counts
cover all documents.  Several orders rank the same tokens differently; a pair has to share
prefix tokens under each before it is verified on the whole sets.

Verification takes place where candidates lie together: documents connected by prefix
tokens form clusters, clusters are cut into blocks of bounded size, and every pair of a
cluster's blocks whose sets can be alike in size is a task of its own.  A task returns
links' counts and a spanning forest, never all pairs.

Prefix tokens shared by chance connect ever more documents as a corpus grows.  So of clusters
too large for a block tasks first see only the front tokens that other sets have, which bound
what a pair can share; whole sets go to the much smaller clusters that those bounds leave.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.llm.common import mixed, slices, spread, word_hashes
from ratingloom.llm.components import components
from ratingloom.operators.lookup import bounded_broadcast, unique_lookup

# Share of all tokens, by hash, that orders put in front.
FRONT = 0.2
_FRONT_END = np.uint64(int(FRONT * 2**64))
# Tokens that a block of a cluster holds, about; a task sees two blocks.
BLOCK_TOKENS = 2_000_000
_CHUNK_CHARS = 500_000
_ORDERS = 2
_PLACE = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked if 100 |A & B| >= percent |A | B|."""

    words: int = 4
    percent: int = 85

    def prefix(self, n):
        """Tokens of a set of n under any order that must hold one that a linked set shares."""
        return n - -(-self.percent * n // 100) + 1

    def linked(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def sizes(self, a, b):
        """Whether sets of these sizes can be linked at all."""
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    def band(self, n: Column) -> Column:
        """A number of a size; sets whose numbers differ by more than one cannot be linked."""
        if self.percent < 1:
            return F.lit(0)
        # a little wider than need be: rounding puts no pair that ``sizes`` allows two bands apart
        width = max(math.log(100 / self.percent), 0.01) * (1 + 1e-9)
        return F.floor(F.log(n) / width).cast("int")


def shingle_sets(texts: list[str], rule: Rule) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    Words are runs of anything but blank and 09 to 0D, with A-Z in lower case; fewer words
    than a shingle takes are one shingle, no words none.
    """
    out = []
    for part in slices(texts, _CHUNK_CHARS):
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts[part]]
        codes = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        start, _, h = word_hashes(codes.astype(np.uint32), ~_BLANKS[codes])
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        cuts = np.searchsorted(start, np.cumsum(lengths) - lengths)
        k = rule.words
        if len(h) >= k:
            whole = sum((h[i : len(h) - k + 1 + i] * _PLACE[i] for i in range(k)), np.uint64(k))
            whole = mixed(whole)
        for a, b in zip(cuts, [*cuts[1:], len(h)], strict=True):
            if b - a >= k:
                out.append(np.unique(whole[a : b - k + 1]))
            elif b > a:
                few = (h[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mixed(np.array([few], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_key(tokens: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number."""
    total = mixed(tokens ^ np.uint64(0x51ED270B7F4A7C15)).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(tokens))]))[0].view(np.int64))


def _sets(docs: DataFrame, rule: Rule, whole: bool) -> DataFrame:
    """_id, _fp, _key, _n, _front and tokens: the whole set, or what a prefix can reach of it."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            for part in slices(texts, 4 * _CHUNK_CHARS):
                sets = shingle_sets(texts[part], rule)
                front = [int(np.searchsorted(s, _FRONT_END)) for s in sets]
                sent = sets
                if not whole:
                    sent = [s[: max(f, rule.prefix(len(s)) if len(s) else 0)] for s, f in zip(sets, front, strict=True)]
                yield pd.DataFrame(
                    {
                        "_id": batch["_id"].iloc[part].to_numpy(),
                        "_fp": batch["_fp"].iloc[part].to_numpy(),
                        "_key": [set_key(s) if len(s) else 0 for s in sets],
                        "_n": [len(s) for s in sets],
                        "_front": front,
                        "_tokens": [s.view(np.int64) for s in sent],
                    }
                )

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_fp"), text.alias("text"))
    schema = f"_id {kind}, _fp bigint, _key bigint, _n int, _front int, _tokens array<bigint>"
    return rows.mapInPandas(made, schema)


def _prefixes(nodes: DataFrame, rule: Rule) -> DataFrame:
    """_key, _n and, for each order, those tokens of its prefix that other sets have too; all
    front tokens that other sets have (_tokens) and the number of tokens behind the front (_rest).

    Tokens that no other set has rank first and use up places.  Order 0 ranks by frequency,
    order 1 by its power of two, each breaking ties by a hash of its own; behind the front
    tokens both rank by the token itself, and what was sent of those is all prefix.
    """

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, sizes, rest, fronts, found = [], [], [], [], [[] for _ in range(_ORDERS)]
            columns = (batch[c] for c in ("_key", "_n", "_front", "_shared", "_df"))
            for key, n, front, shared, df in zip(*columns, strict=True):
                tokens, df = np.asarray(shared, np.int64).view(np.uint64), np.asarray(df, np.int64)
                ahead = tokens < _FRONT_END
                places = rule.prefix(n) - (front - int(ahead.sum()))
                if places <= 0:
                    continue
                near, far, often = tokens[ahead], tokens[~ahead], df[ahead]
                keys.append(key)
                sizes.append(n)
                rest.append(n - front)
                fronts.append(near.view(np.int64))
                for k, rank in enumerate((often, np.log2(np.maximum(often, 1)).astype(int))):
                    order = np.lexsort((mixed(near + np.uint64(k)), rank))[:places]
                    found[k].append(np.concatenate((near[order], far)).view(np.int64))
            made_of = {"_key": keys, "_n": sizes, "_rest": rest, "_tokens": fronts}
            yield pd.DataFrame(made_of | {f"_p{k}": found[k] for k in range(_ORDERS)})

    arrays = ", ".join(f"_p{k} array<bigint>" for k in range(_ORDERS))
    return nodes.mapInPandas(made, f"_key bigint, _n int, _rest int, _tokens array<bigint>, {arrays}")


class _Postings:
    """Which rows hold a token, for rows given as arrays of tokens."""

    def __init__(self, rows: list[np.ndarray]):
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        tokens = np.concatenate(rows)
        order = np.argsort(tokens, kind="stable")
        self.row = np.repeat(np.arange(len(rows)), sizes)[order]
        self.token, self.first = np.unique(tokens[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(tokens)))
        self.slot = np.full(len(rows), -1)

    def holders(self, tokens: np.ndarray) -> np.ndarray:
        """The rows that hold one of ``tokens``, once for each that they hold."""
        at = np.searchsorted(self.token, tokens)
        return self.row[spread(self.first[at], self.count[at])]

    def shared(self, tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each of ``rows`` holds; other rows cost nothing but their postings."""
        self.slot[rows] = np.arange(len(rows))
        found = self.slot[self.holders(tokens)]
        self.slot[rows] = -1
        return np.bincount(found[found >= 0], minlength=len(rows))


def verified(block: pd.DataFrame, rule: Rule) -> list[tuple[int, int, int]]:
    """(node, node, links) of the sets in a task's blocks.

    A node's row with itself has the number of its links; rows with others are links that
    join what no earlier row has joined.  Where ``_tokens`` lacks ``_rest`` of a set's own
    tokens, as many may be shared with any other set: links are then those not ruled out.
    """
    sets = [np.asarray(t, np.int64) for t in block["_tokens"]]
    keys, side, n = block["_key"].tolist(), block["_side"].to_numpy(), block["_n"].to_numpy()
    rest = block["_rest"].to_numpy() if "_rest" in block else np.zeros(len(keys), np.int64)
    cross = block["_i"].iloc[0] != block["_j"].iloc[0]  # though one side may have no rows
    orders = [[np.asarray(p, np.int64) for p in block[f"_p{k}"]] for k in range(_ORDERS)]
    prefix, full = [_Postings(p) for p in orders], None
    links, parent, out = np.zeros(len(keys), np.int64), np.arange(len(keys)), []
    for i in range(len(keys)):
        near = prefix[0].holders(orders[0][i])
        near = np.unique(near[near < i])
        if cross:
            near = near[side[near] != side[i]]
        near = near[rule.sizes(n[near], n[i])]
        for k in range(1, _ORDERS):
            if len(near):
                near = near[prefix[k].shared(orders[k][i], near) > 0]
        if not len(near):
            continue
        if full is None:
            full = _Postings(sets)
        most = full.shared(sets[i], near) + np.minimum(rest[near], rest[i])
        near = near[rule.linked(most, n[near], n[i])]
        links[i] += len(near)
        links[near] += 1
        roots = parent[near]
        while (parent[roots] != roots).any():
            roots = parent[roots]
        joins, one = np.unique(roots, return_index=True)
        out += [(keys[i], keys[j], 0) for j in near[one]]
        parent[near] = parent[joins] = i
    return out + [(key, key, int(c)) for key, c in zip(keys, links, strict=True) if c]


def _blocks(clusters: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """node, _large, _group, _side, _i and _j: what tasks see the nodes of ``clusters``.

    Small clusters share a bin.  A large one has blocks of sets alike in size, of one band
    several by hash where it holds much, and a task for each pair of blocks whose bands are
    neighbours or the same.  ``sizes`` has _k, _n and _mass, the tokens that a task would see.
    """
    member = clusters.join(sizes, F.col("node") == F.col("_k")).select("node", "component", "_n", "_mass")
    weight = member.groupBy(F.col("component").alias("_c")).agg(F.sum("_mass").alias("_all"))
    fits = F.when(F.col("_all") <= BLOCK_TOKENS, F.col("_all"))
    total, most = weight.agg(F.sum(fits), F.max("_all")).first()
    bins = F.lit(max(1, -(-(total or 0) // BLOCK_TOKENS)))
    weighed = member.join(weight, F.col("component") == F.col("_c"))
    zero = F.lit(0).cast("bigint")
    small = weighed.filter(F.col("_all") <= BLOCK_TOKENS).select(
        "node", F.lit(False).alias("_large"), F.pmod(F.xxhash64("component"), bins).alias("_group"),
        zero.alias("_side"), zero.alias("_i"), zero.alias("_j"),
    )
    if (most or 0) <= BLOCK_TOKENS:
        return stage(small, "blocks")
    large = weighed.filter(F.col("_all") > BLOCK_TOKENS).withColumn("_band", rule.band(F.col("_n")))
    parts = F.ceil(F.sum("_mass") / BLOCK_TOKENS).cast("int")
    bands = stage(large.groupBy(F.col("component").alias("_of"), F.col("_band").alias("_own")).agg(parts.alias("_parts")), "bands")
    near = bands.withColumn("_near", F.explode(F.array(F.col("_own") - 1, "_own", F.col("_own") + 1))).join(
        bands.select(F.col("_of").alias("_in"), F.col("_own").alias("_next"), F.col("_parts").alias("_sides")),
        (F.col("_of") == F.col("_in")) & (F.col("_near") == F.col("_next")),
    )
    side = F.pmod(F.xxhash64("node"), F.col("_parts"))
    placed = (
        large.join(bounded_broadcast(near), (F.col("component") == F.col("_of")) & (F.col("_band") == F.col("_own")))
        .withColumn("_side", F.shiftleft(F.col("_band").cast("bigint"), 32) + side)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_sides") - 1)))
        .withColumn("_other", F.shiftleft(F.col("_near").cast("bigint"), 32) + F.col("_other"))
        .select(
            "node", F.lit(True).alias("_large"), F.col("component").alias("_group"), "_side",
            F.least("_side", "_other").alias("_i"), F.greatest("_side", "_other").alias("_j"),
        )
    )
    return stage(small.unionByName(placed), "blocks")


def _found(sets: DataFrame, placed: DataFrame, rule: Rule, name: str) -> DataFrame:
    """(_a, _b, _links) as tasks over pairs of blocks find them."""
    tasks = sets.join(placed, F.col("_key") == F.col("node")).drop("node")

    def checked(block: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(verified(block, rule), columns=["_a", "_b", "_links"])

    found = tasks.groupBy("_large", "_group", "_i", "_j").applyInPandas(
        checked, "_a bigint, _b bigint, _links bigint"
    )
    return stage(found, name)


def _close(clusters: DataFrame, prefixes: DataFrame, rule: Rule) -> DataFrame:
    """``clusters``, of those too large for a block only what front tokens do not tell apart."""
    sizes = prefixes.select(F.col("_key").alias("_k"), "_n", (F.size("_tokens") + 1).alias("_mass"))
    weight = clusters.join(sizes, F.col("node") == F.col("_k")).groupBy(F.col("component").alias("_c")).agg(F.sum("_n").alias("_all"))
    large = stage(weight.filter(F.col("_all") > BLOCK_TOKENS).select("_c"), "large")
    if large.isEmpty():
        return clusters
    member, few = F.col("component") == F.col("_c"), bounded_broadcast(large)
    near = _found(prefixes, _blocks(clusters.join(few, member, "left_semi"), sizes, rule), rule, "candidates")
    close = components(near.select(F.col("_a").alias("a"), F.col("_b").alias("b")), "close")
    return stage(clusters.join(few, member, "left_anti").unionByName(close), "close")


def _linked_nodes(docs: DataFrame, sets: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """(_a, _b, _links) of all sets that are linked."""
    rows = reps.select("_key", F.explode("_tokens").alias("_token"))
    df = rows.groupBy(F.col("_token").alias("_t")).agg(F.count("*").alias("_df")).filter("_df > 1")
    shared = rows.join(df, F.col("_token") == F.col("_t")).groupBy("_key").agg(
        F.collect_list("_token").alias("_shared"), F.collect_list("_df").alias("_df")
    )  # a set's own tokens, so a row at most as long as its document
    sized = reps.select(F.col("_key").alias("_k"), F.col("_id"), "_n", "_front")
    nodes = shared.join(sized, F.col("_key") == F.col("_k")).drop("_k")
    prefixes = stage(_prefixes(nodes.drop("_id"), rule), "prefixes")
    # sets in the list of a token hang on the smallest of them
    lists = prefixes.select("_key", F.explode("_p0").alias("_token"))
    heads = lists.groupBy(F.col("_token").alias("_t")).agg(F.min("_key").alias("_head"))
    edges = lists.join(heads, F.col("_token") == F.col("_t")).filter("_key != _head")
    clusters = stage(components(edges.select(F.col("_key").alias("a"), F.col("_head").alias("b")).distinct(), "clusters"), "clusters")
    close = _close(clusters, prefixes, rule)
    placed = _blocks(close, sized.select("_k", "_n", F.col("_n").alias("_mass")), rule)
    # the whole sets of these documents alone, made again from their texts
    wanted = close.join(sized, F.col("node") == F.col("_k")).select(F.col("_id").alias("_w")).distinct()
    texts = docs.select("doc_id", "text")
    texts = texts.join(bounded_broadcast(stage(wanted, "wanted")), F.col("doc_id").eqNullSafe(F.col("_w")), "left_semi")
    whole = _sets(texts, rule, whole=True).select("_key", "_n", "_tokens").dropDuplicates(["_key"])
    orders = prefixes.select(F.col("_key").alias("_k"), *[f"_p{k}" for k in range(_ORDERS)])
    whole = whole.join(orders, F.col("_key") == F.col("_k")).drop("_k")
    return _found(whole, placed, rule, "links")


def join_similar(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id, n_links and text_hash of every row.

    component_id is the smallest doc_id that links reach, n_links the number of other sets
    that the document's set is linked with; copies of a set count as one.  A null or empty
    text has an empty set, is linked with nothing and stands alone.  Rows that repeat an
    id are rows of their own; a null id is larger than others.  Sets are told apart by
    64-bit hashes.  An empty table gives no rows; other columns are not looked at.
    """
    sets = stage(_sets(docs, rule, whole=False).withColumn("_row", F.monotonically_increasing_id()), "sets")
    filled = sets.filter("_n > 0")
    groups = filled.groupBy(F.col("_key").alias("_k")).agg(
        F.min("_id").alias("_first"), F.min("_row").alias("_lead"), F.count("*").alias("_rows")
    )
    several = stage(groups.filter("_rows > 1").drop("_rows"), "equal-sets")
    # one row of each set, whether its copies have ids of their own or the same one
    reps = unique_lookup(filled, several, "_key", "_k").filter(
        F.col("_k").isNull() | (F.col("_row") == F.col("_lead"))
    )
    first = F.when(F.col("_k").isNull(), F.col("_id")).otherwise(F.col("_first"))
    reps = reps.select("_key", first.alias("_id"), "_n", "_front", "_tokens")
    links = _linked_nodes(docs, sets, reps, rule)
    joined = components(links.select(F.col("_a").alias("a"), F.col("_b").alias("b")), "joined")
    ids = reps.select(F.col("_key").alias("_k"), "_id")
    known = stage(joined.join(ids, F.col("node") == F.col("_k")).select("node", "component", "_id"), "linked")
    least = known.groupBy(F.col("component").alias("_c")).agg(F.min("_id").alias("_least"))
    counts = links.groupBy(F.col("_a").alias("_l")).agg(F.sum("_links").alias("n_links"))
    linked = (
        known.join(least, F.col("component") == F.col("_c"))
        .join(counts, F.col("node") == F.col("_l"), "left")
        .select(F.col("node").alias("_of"), "_least", "n_links")
    )
    alone = several.join(known, F.col("_k") == F.col("node"), "left_anti").select(
        F.col("_k").alias("_of"), F.col("_first").alias("_least"), F.lit(0).cast("bigint").alias("n_links")
    )
    table = stage(linked.unionByName(alone).dropDuplicates(["_of"]), "classes")
    rows = sets.select("_id", "_fp", "_n", F.when(F.col("_n") > 0, F.col("_key")).alias("_key"))
    marked = unique_lookup(rows, table, "_key", "_of")
    return marked.select(
        F.col("_id").alias("doc_id"),
        F.col("_n").cast("bigint").alias("n_shingles"),
        F.when(F.col("_of").isNull(), F.col("_id")).otherwise(F.col("_least")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.col("_fp").alias("text_hash"),
    )


def drop_similar(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """The rows of ``docs``, all columns, that lead their component: the smallest doc_id stays.

    Rows that repeat both id and text are one document and stay or go together.
    """
    marks = join_similar(docs, rule).filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = stage(marks.select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_text")).distinct(), "similar")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    whole = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text.alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_hash") == F.col("_text"))
    return whole.join(bounded_broadcast(gone), same, "left_anti").select("_row.*")
