"""Product lookup and merging queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query
from queries.views import SQL, view
from ratingloom.checkpoints import scratch_path
from ratingloom.operators.position import POS
from ratingloom.operators.products import first_seen, lookup_products
from ratingloom.plans.merging import merge_numbers, merge_products
from ratingloom.sinks.tables import write_merged, write_table
from ratingloom.sources.csv_tables import scan_clean, scan_merged
from ratingloom.sources.schema_file import TRAIN

# Product columns of the merged rows.
PROD = ("main_category", "price", "title", "features", "store", "rating_number")

FIRST_SQL = f"""
select * from (select *, row_number() over (partition by parent_prod_id order by pos) as seen
  from ({SQL["products"]}) p where parent_prod_id <> '') f where seen = 1"""


def merged_sql(miss: str) -> str:
    """Reviews with the product of the first key that hits; ``miss`` is SQL text."""
    columns = ", ".join(
        f"case when a.parent_prod_id is not null then a.{c} "
        f"when b.parent_prod_id is not null then b.{c} else {miss} end as prod_{c}"
        for c in PROD
    )
    return f"""
select r.id, r.user_id, r.prod_id, r.parent_prod_id, r.title, r.comment, r.time, r.votes,
  r.purchased, r.rating, {columns},
  case when a.parent_prod_id is not null then 'prod_id'
    when b.parent_prod_id is not null then 'parent_prod_id' else 'none' end as hit
from ({SQL["reviews"]}) r left join ({FIRST_SQL}) a on r.prod_id = a.parent_prod_id
left join ({FIRST_SQL}) b on r.parent_prod_id = b.parent_prod_id"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "reviews").select(*TRAIN.fields)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "products")


def merged(spark: SparkSession, sf_dir: str, miss: str = "na") -> DataFrame:
    return merge_products(reviews(spark, sf_dir), products(spark, sf_dir), miss)


def merged_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_numbers(reviews(spark, sf_dir), products(spark, sf_dir))


@query(
    "product_first_seen",
    f"select parent_prod_id, id, {', '.join(PROD)} from ({FIRST_SQL}) f",
)
def product_first_seen(spark, sf_dir):
    return first_seen(products(spark, sf_dir)).select("parent_prod_id", "id", *PROD)


_PROD_NAMES = ", ".join(f"prod_{c}" for c in PROD)


@query(
    "lookup_join",
    f"select id, prod_id, parent_prod_id, rating, hit, {_PROD_NAMES} "
    f"from ({merged_sql('null')}) m",
)
def lookup_join(spark, sf_dir):
    found = lookup_products(
        reviews(spark, sf_dir), first_seen(products(spark, sf_dir)), "null", keep_hit=True
    )
    return found.select(
        "id", "prod_id", "parent_prod_id", "rating", "hit", *[f"prod_{c}" for c in PROD]
    )


@query(
    "lookup_join_shuffled",
    f"select id, prod_id, parent_prod_id, rating, hit, {_PROD_NAMES} "
    f"from ({merged_sql('null')}) m",
)
def lookup_join_shuffled(spark, sf_dir):
    """The same lookup as if the products were too large to broadcast."""
    found = lookup_products(
        reviews(spark, sf_dir), first_seen(products(spark, sf_dir)), "null", True, limit=0
    )
    return found.select(
        "id", "prod_id", "parent_prod_id", "rating", "hit", *[f"prod_{c}" for c in PROD]
    )


@query(
    "lookup_join_na",
    f"""select {", ".join(f for f in TRAIN.fields)}, {_PROD_NAMES} from ({merged_sql("'NA'")}) m""",
)
def lookup_join_na(spark, sf_dir):
    return merged(spark, sf_dir)


_MERGED_COLUMNS = (
    "id, votes, purchased, time, rating, prod_price, prod_rating_number, "
    "prod_main_category, prod_store"
)


@query("merged_projection", f"select {_MERGED_COLUMNS} from ({merged_sql(chr(39) + 'NA' + chr(39))}) m")
def merged_columns(spark, sf_dir):
    return merged_numbers(spark, sf_dir)


@query(
    "merged_csv_scan",
    "select "
    + ", ".join(
        f"case when {c} in ('NA', '') then null else {c} end as {c}"
        for c in _MERGED_COLUMNS.split(", ")
    )
    + f" from ({merged_sql(chr(39) + 'NA' + chr(39))}) m",
)
def merged_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "merged")
    write_merged(merged_numbers(spark, sf_dir), path, "csv")
    return scan_merged(spark, path)


@query(
    "merge_from_csv",
    f"""select {", ".join(f for f in TRAIN.fields)}, {_PROD_NAMES} from ({merged_sql("'NA'")}) m""",
)
def merge_from_csv(spark, sf_dir):
    """The lookup on reviews and products that come from cleaned CSV: the first product of a
    key is the first in its file."""
    rows = []
    for name, frame in (("reviews", reviews(spark, sf_dir)), ("products", products(spark, sf_dir))):
        path = scratch_path(spark, name)
        write_table(frame, path, "csv")
        rows.append(scan_clean(spark, path, pos=True))
    return merge_products(*rows).drop(POS)


@query(
    "rating_by_branch",
    f"""with m as ({merged_sql('null')}),
n as (select hit, cast(rating as int) as rating, count(*) as rows from m group by all),
t as (select hit, sum(rows) as total from n group by hit)
select n.hit, n.rating, cast(n.rows as bigint) as rows, round(n.rows * 100.0 / t.total, 4) as percent
from n join t on n.hit = t.hit""",
)
def rating_by_branch(spark, sf_dir):
    found = lookup_products(
        reviews(spark, sf_dir), first_seen(products(spark, sf_dir)), "null", keep_hit=True
    )
    counts = found.groupBy("hit", F.col("rating").cast("int").alias("rating")).agg(
        F.count("*").alias("rows")
    )
    totals = counts.groupBy("hit").agg(F.sum("rows").alias("total"))
    return counts.join(totals, "hit").select(
        "hit", "rating", "rows", F.round(F.col("rows") * 100.0 / F.col("total"), 4).alias("percent")
    )


