"""Numeric, feature, split and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.joining import merged, merged_numbers, merged_sql
from queries.registry import query
from queries.views import LINE_ORDER, ORDER_SQL, SQL, table, view
from ratingloom.checkpoints import scratch_path, stage
from ratingloom.functions.numbers import (
    clip_rating,
    coerce_number,
    encode_true,
    parse_number,
    parse_rating,
    strip_number,
    whole_rating,
)
from ratingloom.operators.features import (
    apply_categories,
    category_codes,
    feature_columns,
    feature_frame,
    feature_stats,
    fit_categories,
    fit_scaler,
    na_to_null,
    standardise,
    with_row_ids,
)
from ratingloom.operators.position import number_rows, order_position
from ratingloom.operators.reports import (
    prediction_distribution,
    prediction_stats,
    rating_distribution,
    rating_stats,
    regression_metrics,
    sorted_values,
)
from ratingloom.operators.split import train_val_split
from ratingloom.plans.training import label_report
from ratingloom.sinks.tables import report_rows, write_report

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _line(*extra) -> list:
    return [*_LINE.split(", "), *extra]


def _strip_sql(c: str) -> str:
    kept = rf"regexp_replace({c}, '[^0-9.\-]', '', 'g')"
    return (
        rf"case when regexp_full_match({kept}, '-?[0-9]+(\.[0-9]+)?') "
        f"then cast({kept} as double) else 0.0::double end"
    )


def _coerce_sql(c: str) -> str:
    kept = rf"regexp_replace({c}, '[^0-9.\\\-]', '', 'g')"
    return (
        rf"coalesce(case when regexp_full_match({kept}, '-?([0-9]+\.?[0-9]*|\.[0-9]+)') "
        f"then try_cast({kept} as double) end, 0.0)"
    )


@query("numeric_strip", f"select {_LINE}, {_strip_sql('amount')} as amount from ({SQL['messy']}) m")
def numeric_strip(spark, sf_dir):
    return view(spark, sf_dir, "messy").select(_line(strip_number(F.col("amount")).alias("amount")))


@query("numeric_coerce", f"select {_LINE}, {_coerce_sql('amount')} as amount from ({SQL['messy']}) m")
def numeric_coerce(spark, sf_dir):
    return view(spark, sf_dir, "messy").select(
        _line(coerce_number(F.col("amount")).alias("amount"))
    )


@query(
    "numeric_parse",
    f"select {_LINE}, coalesce(try_cast(amount as double), {_strip_sql('amount')}) as amount "
    f"from ({SQL['messy']}) m",
)
def numeric_parse(spark, sf_dir):
    return view(spark, sf_dir, "messy").select(_line(parse_number(F.col("amount")).alias("amount")))


@query(
    "bool_encode",
    f"select {_LINE}, case when upper(flag) = 'TRUE' then 1.0::double else 0.0::double end as flag "
    f"from ({SQL['messy']}) m",
)
def bool_encode(spark, sf_dir):
    return view(spark, sf_dir, "messy").select(_line(encode_true(F.col("flag")).alias("flag")))


@query(
    "rating_parse",
    rf"""select {_LINE}, case when regexp_full_match(k, '[1-5](\.0+)?') then cast(k as double) end
  as stars from (select *, regexp_replace(stars, '[^0-9.]', '', 'g') as k from ({SQL["messy"]}) m) s""",
)
def rating_parse(spark, sf_dir):
    return view(spark, sf_dir, "messy").select(_line(parse_rating(F.col("stars")).alias("stars")))


@query(
    "null_fill",
    f"select {_LINE}, coalesce(cast(gap as double), 0.0) as gap from ({SQL['messy']}) m",
)
def null_fill(spark, sf_dir):
    rows = view(spark, sf_dir, "messy").select(_line(F.col("gap").try_cast("double").alias("gap")))
    return rows.na.fill({"gap": 0.0})


# --- categories and features --------------------------------------------------------


def _codes_sql(column: str) -> str:
    return f"""select v as {column}, cast(row_number() over (order by v) - 1 as double) as code
from (select distinct coalesce({column}, '') as v from ({merged_sql("null")}) m) d"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir, miss="null")


@query("category_codes", _codes_sql("prod_store"))
def store_codes(spark, sf_dir):
    return category_codes(_gaps(spark, sf_dir), "prod_store", "code")


@query(
    "category_apply",
    f"""with m as ({merged_sql("null")})
select id, rating, cast(dense_rank() over (order by coalesce(prod_main_category, '')) - 1 as double)
  as prod_main_category,
  cast(dense_rank() over (order by coalesce(prod_store, '')) - 1 as double) as prod_store from m""",
)
def category_apply(spark, sf_dir):
    rows = _gaps(spark, sf_dir)
    coded = apply_categories(rows, fit_categories(rows))
    return coded.select("id", "rating", "prod_main_category", "prod_store")


@query(
    "sorted_values",
    f"select distinct title from ({SQL['products']}) p order by title",
)
def sorted_titles(spark, sf_dir):
    return sorted_values(view(spark, sf_dir, "products"), "title")


_FEATURES_SQL = f"""
with m as ({merged_sql("null")})
select id, cast(votes as double) as votes,
  case when purchased = 'TRUE' then 1.0::double else 0.0::double end as purchased,
  cast(time as double) as time,
  coalesce(cast(replace(prod_price, '$', '') as double), 0.0) as prod_price,
  coalesce(cast(prod_rating_number as double), 0.0) as prod_rating_number,
  cast(dense_rank() over (order by coalesce(prod_main_category, '')) - 1 as double)
    as prod_main_category,
  cast(dense_rank() over (order by coalesce(prod_store, '')) - 1 as double) as prod_store,
  cast(rating as double) as label
from m"""


def scalar_features(spark: SparkSession, sf_dir: str, keep=("id",)) -> DataFrame:
    """Feature frame of the merged reviews, without text columns."""
    rows = stage(merged_numbers(spark, sf_dir), "merged")
    return feature_frame(rows, fit_categories(rows), texts=(), keep=keep)


@query("feature_frame", _FEATURES_SQL)
def features(spark, sf_dir):
    return scalar_features(spark, sf_dir)


# time counts in milliseconds: statistics are compared in days
_UNITS = {"time": 86400000.0}
_SCALARS = (
    "votes", "purchased", "time", "prod_price", "prod_rating_number", "prod_main_category",
    "prod_store",
)


@query(
    "feature_stats",
    f"with f as ({_FEATURES_SQL}) "
    + " union all ".join(
        f"select '{c}' as feature, round(avg({c}) / {_UNITS.get(c, 1.0)}, 6) as mean, "
        f"round(case when stddev_pop({c}) = 0 then 1.0 else stddev_pop({c}) end "
        f"/ {_UNITS.get(c, 1.0)}, 6) as sd from f"
        for c in _SCALARS
    ),
)
def stats(spark, sf_dir):
    found = feature_stats(scalar_features(spark, sf_dir), _SCALARS)
    unit = F.when(F.col("feature") == "time", F.lit(_UNITS["time"])).otherwise(F.lit(1.0))
    return found.select(
        "feature",
        F.round(F.col("mean") / unit, 6).alias("mean"),
        F.round(F.col("sd") / unit, 6).alias("sd"),
    )


@query(
    "standardise",
    f"with f as ({_FEATURES_SQL}) select id, label, "
    + ", ".join(
        f"round(({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1.0 "
        f"else stddev_pop({c}) over () end, 5) as {c}"
        for c in _SCALARS
    )
    + " from f",
)
def standardised(spark, sf_dir):
    # read by the fit and by its use
    frame = stage(scalar_features(spark, sf_dir), "features")
    done = standardise(frame, _SCALARS, fit_scaler(frame, _SCALARS))
    return done.select("id", "label", *[F.round(c, 5).alias(c) for c in _SCALARS])


@query(
    "feature_order",
    f"""select 'votes,purchased,time,prod_price,prod_rating_number,prod_main_category,prod_store'
  as features, count(*) as rows from ({merged_sql("null")}) m""",
)
def feature_order(spark, sf_dir):
    rows = merged(spark, sf_dir)
    names = ",".join(feature_columns(rows.columns))
    return na_to_null(rows).agg(F.lit(names).alias("features"), F.count("*").alias("rows"))


# --- split ----------------------------------------------------------------------------


@query(
    "train_val_split",
    f"""with n as (select id, row_number() over (order by {ORDER_SQL}) - 1 as row_no
  from ({SQL["reviews"]}) r),
h as (select *, row_number() over (order by md5(concat_ws(':', id, row_no, 7))) as place,
  count(*) over () as total from n)
select id, row_no, case when place <= greatest(1, least(cast(floor(0.8::double * total) as bigint),
  total - 1)) then 1 else 0 end as is_train from h""",
)
def split(spark, sf_dir):
    ordered = order_position(view(spark, sf_dir, "reviews").select("id", *LINE_ORDER), LINE_ORDER)
    numbered = number_rows(ordered.select("id", "pos"), "row_no")
    done = train_val_split(numbered, "id", "row_no", seed=7)
    return done.select("id", "row_no", F.col("is_train").cast("int").alias("is_train"))


@query(
    "row_number_id",
    f"""select cast(row_number() over (order by {ORDER_SQL}) - 1 as bigint) as id, l_orderkey,
  l_extendedprice from lineitem""",
)
def row_number_id(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return with_row_ids(rows, LINE_ORDER).select("id", "l_orderkey", "l_extendedprice")


# --- distributions and metrics ------------------------------------------------------------


def _all_ratings_sql(counts: str, base: str) -> str:
    return f"""select r.rating, coalesce(c.n, 0) as rows,
  round(coalesce(c.n, 0) * 100.0 / greatest({base}, 1), 4) as percent
from (select unnest([1, 2, 3, 4, 5]) as rating) r left join ({counts}) c on r.rating = c.rating"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "reviews")
    return rows.select(parse_rating(F.col("rating")).alias("label"))


_COUNTS_SQL = (
    f"select cast(rating as int) as rating, count(*) as n from ({SQL['reviews']}) r group by all"
)


def _rounded_percent(df: DataFrame) -> DataFrame:
    return df.withColumn("percent", F.round("percent", 4))


@query("rating_distribution", _all_ratings_sql(_COUNTS_SQL, "(select count(*) from lineitem)"))
def distribution(spark, sf_dir):
    return _rounded_percent(rating_distribution(_labels(spark, sf_dir)))


@query(
    "rating_stats",
    f"""select count(*) as rows, round(avg(cast(rating as double)), 6) as mean,
  round(stddev_samp(cast(rating as double)), 6) as sd from ({SQL["reviews"]}) r""",
)
def label_stats(spark, sf_dir):
    found = rating_stats(_labels(spark, sf_dir))
    return found.select("rows", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


# a made prediction per line: ties, out-of-range and ordinary values
_PREDICTION = "l_quantity / 8.0 - 0.5"


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("prediction", F.expr(_PREDICTION))


@query(
    "clip_predictions",
    f"select {_LINE}, least(greatest({_PREDICTION}, 1.0), 5.0)::double as rating from lineitem",
)
def clip_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir).select(
        _line(clip_rating(F.col("prediction")).alias("rating"))
    )


_WHOLE = f"cast(least(greatest(round_even({_PREDICTION}, 0), 1), 5) as int)"


@query("round_predictions", f"select {_LINE}, {_WHOLE} as rating from lineitem")
def round_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir).select(
        _line(whole_rating(F.col("prediction")).alias("rating"))
    )


@query(
    "prediction_analysis",
    f"""select count(*) as rows, round(avg({_WHOLE}), 6) as mean,
  round(stddev_pop({_WHOLE}), 6) as sd from lineitem""",
)
def analysis(spark, sf_dir):
    found = prediction_stats(round_predictions(spark, sf_dir))
    return found.select("rows", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query(
    "prediction_distribution",
    _all_ratings_sql(
        f"select {_WHOLE} as rating, count(*) as n from lineitem group by all",
        "(select count(*) from lineitem)",
    ),
)
def predicted_distribution(spark, sf_dir):
    return _rounded_percent(prediction_distribution(round_predictions(spark, sf_dir)))


@query(
    "regression_metrics",
    f"""with r as ({SQL["reviews"]}),
m as (select p_type, avg(cast(rating as double)) as guess from r group by p_type),
e as (select guess - cast(rating as double) as err from r join m on r.p_type = m.p_type)
select count(*) as rows, round(avg(err * err), 6) as mse, round(sqrt(avg(err * err)), 6) as rmse,
  round(avg(abs(err)), 6) as mae from e""",
)
def metrics(spark, sf_dir):
    rows = view(spark, sf_dir, "reviews").select(
        "p_type", parse_rating(F.col("rating")).alias("label")
    )
    guesses = rows.groupBy("p_type").agg(F.avg("label").alias("guess"))
    found = regression_metrics(rows.join(guesses, "p_type"), "guess", "label")
    return found.select("rows", *[F.round(c, 6).alias(c) for c in ("mse", "rmse", "mae")])


_LABEL_REPORT_SQL = f"""
select 'rating_distribution' as section, metric, cast(rating as string) as key, value from (
  select rating, unnest(['rows', 'percent']) as metric,
    unnest([cast(rows as double), percent]) as value
  from ({_all_ratings_sql(_COUNTS_SQL, "(select count(*) from lineitem)")}) d) u
union all
select 'rating_statistics', metric, '', value from (
  select unnest(['rows', 'mean', 'sd']) as metric,
    unnest([cast(count(*) as double), round(avg(cast(rating as double)), 4),
      round(stddev_samp(cast(rating as double)), 4)]) as value from ({SQL["reviews"]}) r) s"""
_ANALYSIS_REPORT_SQL = f"""
select 'prediction_analysis' as section, metric, '' as key, value from (
  select unnest(['rows', 'mean', 'sd']) as metric, unnest([cast(count(*) as double),
    round(avg({_WHOLE}), 4), round(stddev_pop({_WHOLE}), 4)]) as value from lineitem) s"""


@query("report_sections", f"{_LABEL_REPORT_SQL} union all {_ANALYSIS_REPORT_SQL}")
def report_sections(spark, sf_dir):
    """A fresh report, then one section written twice: only that one is replaced."""
    path = scratch_path(spark, "report")
    write_report(label_report(_labels(spark, sf_dir)), path, fresh=True)
    whole = round_predictions(spark, sf_dir)
    write_report(report_rows(rating_stats(whole, "rating"), "prediction_analysis"), path)
    write_report(report_rows(prediction_stats(whole), "prediction_analysis"), path)
    found = spark.read.parquet(path)
    return found.select("section", "metric", "key", F.round("value", 4).alias("value"))
