"""Review and product views over the given tables.

The view texts below run in Spark and in DuckDB alike; only ``time`` is written
differently.  They carry the defects the cleaning operators repair or report, and
cover every row of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "part")
# A total order over lineitem: all its columns.
LINE_ORDER = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
ORDER_SQL = ", ".join(LINE_ORDER)

_EPOCH_MS = {
    "spark": "cast(datediff(cast(l_shipdate as date), date '1970-01-01') as bigint) * 86400000",
    "duckdb": "date_diff('day', date '1970-01-01', cast(l_shipdate as date)) * 86400000",
}

_REVIEWS = """
select {columns},
  cast(l_orderkey * 10 + l_linenumber as string) as id,
  concat('u_', lpad(cast(o_custkey as string), 16, '0')) as user_id,
  concat('a_', lpad(cast(l_partkey as string), 16, '0')) as prod_id,
  concat('a_', lpad(cast(l_suppkey as string), 16, '0')) as parent_prod_id,
  p_name as title,
  concat(p_type, ' ', p_brand) as comment,
  cast({epoch} as string) as time,
  cast(cast(l_quantity as int) - 5 as string) as votes,
  case when l_returnflag = 'N' then 'TRUE' else 'FALSE' end as purchased,
  cast(1 + (l_partkey + l_linenumber) % 5 as string) as rating,
  p_type, p_brand
from {joined}
"""
_JOINED = "{lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey"

_DIRTY = """
select {columns}, id,
  case when l_orderkey % 20 in (1, 10) then concat('x', user_id) else user_id end as user_id,
  case when l_orderkey % 20 = 2 then substr(prod_id, 1, 10) else prod_id end as prod_id,
  parent_prod_id,
  case when l_orderkey % 20 = 4 then ' '
       when l_orderkey % 20 = 11 then concat(title, chr(7), '!') else title end as title,
  case when l_orderkey % 20 = 3 then '' else comment end as comment,
  case when l_orderkey % 20 = 12 then '' else time end as time,
  case when l_orderkey % 20 in (5, 10) then 'x' else votes end as votes,
  case when l_orderkey % 20 = 6 then 'maybe'
       when l_orderkey % 20 = 7 then 'true' else purchased end as purchased,
  case when l_orderkey % 20 = 8 then '9' when l_orderkey % 20 = 9 then 'four'
       when l_orderkey % 20 = 10 then '0' else rating end as rating
from ({reviews}) r
"""

# One raw record per review, damaged in one of nine ways.
_RAW = """
select {columns}, p_type, p_brand, l_orderkey % 10 as shape,
  id, user_id, prod_id, parent_prod_id, time, rating,
  case when l_orderkey % 10 = 9 then concat(title, chr(7)) else title end as title,
  case when l_orderkey % 10 = 9 then 'x' else votes end as votes,
  case when l_orderkey % 10 = 8 then 'maybe' else purchased end as purchased
from ({reviews}) r
"""
_RECORD = """
select *,
  concat(id, ',', user_id, ',', prod_id, ',', parent_prod_id, ',', title, ',',
    case shape
      when 1 then concat('"', p_type, ', ', p_brand, '"')
      when 2 then concat(p_type, ', ', p_brand)
      when 3 then concat('"', p_type, ' ', p_brand)
      when 4 then concat(p_type, ' ', p_brand, ' ', time, ' ', votes, ' ', purchased, ' ', rating)
      when 5 then concat(p_type, ' ', p_brand, ' ', time, ' ', votes)
      when 6 then concat('"', p_type, chr(10), p_brand, '"')
      when 7 then concat(p_type, chr(10), p_brand)
      else concat(p_type, ' ', p_brand) end,
    case shape
      when 4 then ',,,,'
      when 5 then concat(',', purchased, ',', rating, ',,')
      else concat(',', time, ',', votes, ',', purchased, ',', rating) end) as record
from ({raw}) r
"""

_PRODUCTS = """
select p_partkey as pos,
  cast(p_partkey as string) as id,
  concat('a_', lpad(cast(p_partkey - p_partkey % 3 as string), 16, '0')) as parent_prod_id,
  p_type as main_category,
  concat('$', cast(p_retailprice as string)) as price,
  p_name as title,
  concat(p_brand, ', size ', cast(p_size as string)) as features,
  case when p_partkey % 7 = 0 then '' else p_brand end as store,
  cast(p_size - 3 as string) as rating_number
from {part}
"""
_PRODUCTS_DIRTY = """
select pos,
  case when pos % 23 = 2 then concat(id, 'x') else id end as id,
  case when pos % 23 in (3, 5) then 'a_0' else parent_prod_id end as parent_prod_id,
  main_category, price,
  case when pos % 23 = 6 then chr(7) when pos % 23 = 7 then concat(title, chr(7), '!')
       else title end as title,
  case when pos % 23 = 1 then '' else features end as features,
  store,
  case when pos % 23 in (4, 5) then 'many' else rating_number end as rating_number
from ({products}) p
"""

_MESSY = """
select {columns},
  case l_linenumber % 7
    when 0 then concat('$', cast(l_extendedprice as string))
    when 1 then concat(cast(l_extendedprice as string), ' USD')
    when 2 then concat('1.', cast(l_partkey + 10 as string), 'E+3')
    when 3 then concat('-', cast(cast(l_quantity as int) as string))
    when 4 then concat(cast(l_suppkey as string), '-', cast(l_linenumber as string))
    when 5 then concat(cast(l_suppkey as string), chr(92), cast(l_linenumber as string))
    else case when l_suppkey % 2 = 0 then '' else 'NA' end end as amount,
  case l_linenumber % 4 when 0 then 'TRUE' when 1 then 'true' when 2 then 'False' else 'yes' end
    as flag,
  case l_partkey % 6 when 0 then '5' when 1 then '4.0' when 2 then '4.5' when 3 then 'r3'
    when 4 then '0' else '' end as stars,
  case when l_suppkey % 3 = 0 then cast(null as string) else cast(l_suppkey as string) end as gap
from {lineitem}
"""


def _texts(engine: str, names: dict[str, str]) -> dict[str, str]:
    fill = {"columns": ORDER_SQL, "epoch": _EPOCH_MS[engine], **names}
    found: dict[str, str] = {}
    for name, text in (
        ("joined", _JOINED), ("reviews", _REVIEWS), ("dirty", _DIRTY), ("raw", _RAW), ("records", _RECORD),
        ("products", _PRODUCTS), ("products_dirty", _PRODUCTS_DIRTY), ("messy", _MESSY),
    ):
        found[name] = text.format(**fill, **found)
    return found


# The views as DuckDB text, by name.
SQL = _texts("duckdb", {t: t for t in TABLES})


# Tables whose rows get the work; the others are only looked up.
_FEW = 8
_DRIVING = {"lineitem", "documents", "embeddings"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  A file of one row group would keep a single task busy with all
    the work behind the scan, so a driving table of fewer than ``_FEW`` tasks, a gigabyte
    at the most whatever the cluster, is spread first; others are read as they lie."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in _DRIVING and scan.rdd.getNumPartitions() < _FEW:
        return scan.repartition(_FEW)
    return scan


def _text(name: str) -> str:
    return _texts("spark", {t: "{" + t + "}" for t in TABLES})[name]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a Spark frame."""
    text = _text(name)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def sorted_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view of reviews in line order, partition by partition.

    The joined columns are sorted, not the view's: its long texts repeat them many times over
    and are made where the sorted rows lie.
    """
    joined = _text("joined")
    rows = spark.sql(
        f"select {ORDER_SQL}, o_custkey, p_name, p_type, p_brand from {joined}",
        **{t: table(spark, sf_dir, t) for t in TABLES},
    )
    ranged = rows.repartitionByRange(*LINE_ORDER).sortWithinPartitions(*LINE_ORDER)
    return spark.sql(_text(name).replace(joined, "{rows}"), rows=ranged)
