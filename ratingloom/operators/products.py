"""Reviews meet products: first-seen product per key, then a two-key left lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import (
    BROADCAST_BYTES,
    bounded_broadcast,
    fits_broadcast,
    unique_lookup,
)
from ratingloom.operators.position import POS

KEY = "parent_prod_id"
# Product columns that never reach the merged rows.
_NOT_MERGED = (KEY, "id", POS)
# Columns of the merged table, in order, when present.
MERGED_CORE = ("id", "votes", "purchased", "time", "rating")
MERGED_PRODUCT = ("prod_price", "prod_rating_number", "prod_main_category", "prod_store")
MISSING = "NA"
# Keys of a review in the order they are tried, and bits that a product's number takes.
_WAYS = ("prod_id", KEY)
_WAY_BITS = 62


def first_seen(df: DataFrame, key: str = KEY, pos: str = POS) -> DataFrame:
    """The first row of each non-empty key in ``pos`` order; ``pos`` must be distinct.

    Two phases: the least position of every key, a hash aggregate of keys and numbers that
    tasks prepare, and the rows at those positions.  The positions are broadcast while they
    measure small; beyond that the semi-join shuffles rows by position, which no key skews.
    ``df`` is read twice, so it should be a scan.
    """
    keyed = df.filter(F.col(key) != "")
    least = keyed.groupBy(key).agg(F.min(pos).alias("_first"))
    first = stage(least.select("_first"), "first-seen")
    return keyed.join(bounded_broadcast(first), F.col(pos) == F.col("_first"), "left_semi")


def prefixed(products: DataFrame) -> DataFrame:
    """Key and ``prod_``-prefixed columns, without the product's own id."""
    return products.select(
        KEY, *[F.col(c).alias(f"prod_{c}") for c in products.columns if c not in _NOT_MERGED]
    )


def lookup_products(
    reviews: DataFrame,
    products: DataFrame,
    miss: str = "na",
    keep_hit: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left lookup by ``prod_id``, else by ``parent_prod_id``; every review once.

    ``products`` has one row per ``parent_prod_id`` (see ``first_seen``).  On a miss
    all ``prod_*`` columns are ``NA`` (``miss='na'``) or NULL (``miss='null'``).
    ``keep_hit`` adds ``hit``: ``prod_id``, ``parent_prod_id`` or ``none``.
    """
    # numbered and written once, then measured and read as often as need be
    side = stage(prefixed(products).withColumn("_p", F.monotonically_increasing_id()), "products")
    names = [c for c in side.columns if c not in (KEY, "_p")]
    small = fits_broadcast(side, limit)
    found = _looked_up(reviews, side, names) if small else _looked_up_by_position(reviews, side, names)
    hit = F.col("_way").isNotNull()

    def value(name: str) -> Column:
        # a hit's empty cell stays NULL or empty, only a miss is the placeholder
        cell = F.col(f"_hit_{name}")
        return cell if miss == "null" else F.when(hit, cell.cast("string")).otherwise(F.lit(MISSING))

    which = F.when(F.col("_way") == 0, _WAYS[0]).when(F.col("_way") == 1, _WAYS[1]).otherwise("none")
    extra = [which.alias("hit")] if keep_hit else []
    return found.select(*reviews.columns, *[value(n).alias(n) for n in names], *extra)


def _looked_up(reviews: DataFrame, side: DataFrame, names: list[str]) -> DataFrame:
    """Reviews with ``_way``, the number of the key that hit first, and ``_hit_*`` cells: a
    broadcast of the products for each key."""
    joined = reviews
    for n, key in enumerate(_WAYS):
        right = side.select(F.col(KEY).alias(f"_key{n}"), *[F.col(c).alias(f"_{n}_{c}") for c in names])
        joined = unique_lookup(joined, right, key, f"_key{n}", "left", small=True)
    own, parent = F.col("_key0").isNotNull(), F.col("_key1").isNotNull()
    return joined.select(
        *reviews.columns,
        F.when(own, 0).when(parent, 1).alias("_way"),
        *[F.when(own, F.col(f"_0_{c}")).when(parent, F.col(f"_1_{c}")).alias(f"_hit_{c}") for c in names],
    )


def _looked_up_by_position(reviews: DataFrame, side: DataFrame, names: list[str]) -> DataFrame:
    """The same for products of any size; whole reviews cross one exchange.

    Both keys of a review are looked up in one join of keys and numbers, the first that hits
    is the least number per review, and the product found is brought to it by position.
    """
    if POS in reviews.columns:
        rows, place = reviews, POS
    else:
        rows, place = stage(reviews.withColumn("_r", F.monotonically_increasing_id()), "reviews", compact=True), "_r"
    asked = rows.select(
        F.col(place).alias("_of"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("_n"), F.col(k).alias("_asked")) for n, k in enumerate(_WAYS)])),
    ).filter(F.col("_asked").isNotNull())
    keys = side.select(F.col(KEY).alias("_key"), "_p")
    hits = unique_lookup(asked, keys, "_asked", "_key", "inner", small=False)
    # one number holds which key hit, in front, and which product it hit
    code = F.min(F.shiftleft(F.col("_n").cast("bigint"), _WAY_BITS).bitwiseOR(F.col("_p")))
    best = stage(hits.groupBy("_of").agg(code.alias("_code")), "hits").select(
        "_of",
        F.shiftright("_code", _WAY_BITS).cast("int").alias("_way"),
        F.col("_code").bitwiseAND(F.lit((1 << _WAY_BITS) - 1)).alias("_product"),
    )
    cells = side.select("_p", *[F.col(c).alias(f"_hit_{c}") for c in names])
    brought = unique_lookup(best, cells, "_product", "_p", "inner", small=False)
    return unique_lookup(rows, brought, place, "_of", small=False, distinct=True)


def merged_columns(df: DataFrame) -> list[str]:
    """Columns the merged table keeps: position, core, product, embeddings in column order."""
    from ratingloom.operators.features import is_embedding_column

    kept = [c for c in (POS, *MERGED_CORE, *MERGED_PRODUCT) if c in df.columns]
    return kept + [c for c in df.columns if is_embedding_column(c)]


def merged_inputs(reviews: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of both that ``merged_projection`` needs, keys and positions included."""
    from ratingloom.operators.features import is_embedding_column

    core = [c for c in reviews.columns if c in (POS, *_WAYS, *MERGED_CORE) or is_embedding_column(c)]
    kept = [c for c in products.columns if c in (POS, KEY) or f"prod_{c}" in MERGED_PRODUCT or is_embedding_column(c)]
    return reviews.select(*core), products.select(*kept)


def merged_projection(df: DataFrame) -> DataFrame:
    """Drop the texts and identifiers the model never sees."""
    return df.select(*merged_columns(df))
