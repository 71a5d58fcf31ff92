"""Queries of what checks, schemas, streams and fits promise."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.cleaning import _checked_sql, _clean_sql, _reason_sql
from queries.models import DIM
from queries.registry import query
from queries.views import SQL, table, view
from ratingloom.checkpoints import scratch_path, stage
from ratingloom.functions.numbers import parse_rating
from ratingloom.operators.embed import expand_embedding, fit_compressor
from ratingloom.operators.features import LABEL, embedding_columns, require_ratings
from ratingloom.operators.regress import evaluate, fit_regressor
from ratingloom.operators.validate import REASONS, validate
from ratingloom.plans.cleaning import clean_file
from ratingloom.sinks.tables import write_csv, write_predictions
from ratingloom.sources.csv_tables import scan_clean
from ratingloom.sources.schema_file import PRODUCT, TRAIN, read_fields
from ratingloom.streaming.cleaning import check_record_stream, write_checked_stream


def _joined():
    return F.array_join(REASONS, "; ").alias(REASONS)


@query(
    "schema_file_scan",
    """select cast(row_number() over (order by n_nationkey) - 1 as int) as place, n_name as field
from nation where regexp_full_match(n_name, '[A-Za-z_][A-Za-z0-9_]*')""",
)
def schema_file_scan(spark, sf_dir):
    """A column list out of ``name: text`` lines; names that are no identifiers drop out."""
    path = scratch_path(spark, "schema")
    lines = table(spark, sf_dir, "nation").repartitionByRange(1, "n_nationkey").sortWithinPartitions("n_nationkey")
    lines.select(F.concat(F.lit(" "), "n_name", F.lit(" : region "), F.col("n_regionkey").cast("string"))).write.text(path)
    fields = read_fields(spark, path)
    return spark.range(1).select(F.posexplode(F.array(*map(F.lit, fields))).alias("place", "field"))


_ARITY = "8 + l_linenumber % 4"


@query(
    "arity_reasons",
    f"""select id, case when {_ARITY} < 10 then 'missing attribute'
  when {_ARITY} > 10 then 'extra attribute' else {_reason_sql(TRAIN)} end as corruption_reasons
from ({SQL["dirty"]}) d""",
)
def arity_reasons(spark, sf_dir):
    rows = view(spark, sf_dir, "dirty").withColumn("n", F.expr(_ARITY))
    return validate(rows, TRAIN, n_cells="n").select("id", _joined())


@query(
    "extra_columns",
    f"""select id, case when l_linenumber % 3 = 0 then 'extra attribute'
  else {_reason_sql(TRAIN)} end as corruption_reasons from ({SQL["dirty"]}) d""",
)
def extra_columns(spark, sf_dir):
    """Rows read by header name with a column without one: it spoils where it holds a value."""
    nameless = F.when(F.col("l_linenumber") % 3 == 0, "more").otherwise(" ").alias("_c10")
    rows = view(spark, sf_dir, "dirty").select(*TRAIN.fields, nameless)
    return validate(rows, TRAIN, by_name=True).select("id", _joined())


_HEADED = f"({_checked_sql(PRODUCT, SQL['products'])}) k"


@query("invalid_header", f"select id, 'invalid header' as corruption_reasons from {_HEADED} where corruption_reasons = ''")
def invalid_header(spark, sf_dir):
    """A file whose columns have other names: every row is corrupt if the header is checked."""
    path = scratch_path(spark, "headed")
    rows = view(spark, sf_dir, "products").select(*PRODUCT.fields).withColumnRenamed("store", "shop")
    write_csv(rows, path)
    return clean_file(spark, path, PRODUCT, check_header=True).quarantine.select("id", REASONS)


@query(
    "observed_summary",
    f"""select count(*) as input_rows, count(*) filter (corruption_reasons = '') as clean_rows,
  count(*) filter (corruption_reasons <> '') as corrupted_rows
from ({_checked_sql(PRODUCT, SQL["products_dirty"])}) k""",
)
def observed_summary(spark, sf_dir):
    """Counts of a cleaning run, taken while its rows were written."""
    path = scratch_path(spark, "observed")
    write_csv(view(spark, sf_dir, "products_dirty").select(*PRODUCT.fields), path)
    return clean_file(spark, path, PRODUCT).summary


_STARS = "case when l_partkey % 6 = 0 then '9' else cast(1 + l_partkey % 5 as string) end"


@query(
    "dataset_assertions",
    """select count(*) as rows, count(*) filter (l_partkey % 6 = 0) as bad_rows,
  count(*) filter (l_partkey % 6 = 0) = 0 as whole_passes, true as valid_rows_pass, false as none_passes
from lineitem""",
)
def dataset_assertions(spark, sf_dir):
    """Whether the assertion in front of a training run lets rated rows through."""
    rows = table(spark, sf_dir, "lineitem").select(parse_rating(F.expr(_STARS)).alias(LABEL))

    def passes(frame):
        try:
            require_ratings(frame)
        except ValueError:
            return False
        return True

    verdicts = {
        "whole_passes": passes(rows),
        "valid_rows_pass": passes(rows.filter(F.col(LABEL).isNotNull())),
        "none_passes": passes(rows.limit(0)),
    }
    counts = rows.agg(F.count("*").alias("rows"), F.count_if(F.col(LABEL).isNull()).alias("bad_rows"))
    return counts.select("*", *[F.lit(v).alias(k) for k, v in verdicts.items()])


@query(
    "embedding_order",
    f"""select cast(pos as int) as place, 'comment_emb_' || pos as field, round(avg(v), 4) as mean from (
  select unnest(range({DIM})) as pos, unnest(embedding)::double as v from embeddings) e group by pos""",
)
def embedding_order(spark, sf_dir):
    """Embedding columns that lie in text order come back in the order of their numbers."""
    rows = table(spark, sf_dir, "embeddings").select("embedding")
    wide = expand_embedding(rows, "embedding", "comment", DIM)
    shuffled = wide.select(*sorted(wide.columns))
    ordered = embedding_columns(shuffled.columns)
    means = shuffled.agg(*[F.round(F.avg(c), 4).alias(c) for c in ordered])
    cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("field"), F.col(c).alias("mean")) for i, c in enumerate(ordered)]
    return means.select(F.inline(F.array(*cells)))


@query(
    "pca_topk",
    "select cast(k as int) as component, true as centred, true as uncorrelated, true as falling "
    "from (select unnest(range(8)) as k) c",
)
def pca_topk(spark, sf_dir):
    """The first components have mean 0, no covariance, and variances that fall."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    short = fit_compressor(rows, "embedding", 8).apply(rows).select(*[F.col("embedding")[i].alias(f"c{i}") for i in range(8)])
    n = range(8)
    figures = short.agg(
        *[F.avg(f"c{i}").alias(f"mean{i}") for i in n],
        *[F.var_samp(f"c{i}").alias(f"var{i}") for i in n],
        *[F.abs(F.covar_samp(f"c{i}", f"c{j}")).alias(f"cov{i}_{j}") for i in n for j in range(i)],
    )
    none = F.lit(1e-8)
    cells = [
        F.struct(
            F.lit(i).alias("component"),
            (F.abs(f"mean{i}") < none).alias("centred"),
            (F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"cov{max(i, j)}_{min(i, j)}") for j in n if j != i]) < none).alias("uncorrelated"),
            (F.col(f"var{i}") <= F.col(f"var{i - 1}") if i else F.lit(True)).alias("falling"),
        )
        for i in n
    ]
    return figures.select(F.inline(F.array(*cells)))


@query(
    "fit_one_feature",
    """with f as (select avg(y) as my, avg(x) as mx, regr_slope(y, x) as s from (
  select cast(l_quantity as double) as x, cast(l_extendedprice as double) as y from lineitem) v)
select round(sqrt(avg((y - (my + s * (x - mx))) * (y - (my + s * (x - mx))))), 1) as rmse, count(*) as rows
from f, (select cast(l_quantity as double) as x, cast(l_extendedprice as double) as y from lineitem) v""",
)
def fit_one_feature(spark, sf_dir):
    """The linear regressor on one feature leaves the least squares' error."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias(LABEL)
    )
    model = fit_regressor(rows, rows, ["x"], algo="linear", regParam=0.0)
    figures = evaluate(rows, model)
    return figures.select(F.round("rmse", 1).alias("rmse"), F.lit(rows.count()).alias("rows"))


@query(
    "prediction_sinks",
    """select id, round(p, 3) as rating, cast(round_even(p, 0) as int) as whole from (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as id,
    cast(1 + (l_partkey % 1000) * 0.004 as double) as p from lineitem) v""",
)
def prediction_sinks(spark, sf_dir):
    """Both prediction files, read back and put side by side."""
    path = scratch_path(spark, "predictions")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.monotonically_increasing_id()).alias("id"),
        (1 + (F.col("l_partkey") % 1000) * 0.004).cast("double").alias("rating"),
    )
    write_predictions(stage(rows, "predicted"), path)
    floats = scan_clean(spark, f"{path}/predictions_float")
    whole = scan_clean(spark, f"{path}/predictions_int").withColumnRenamed("rating", "whole")
    order, line = (F.split("id", "-")[i].cast("bigint") for i in (0, 1))
    return floats.join(whole, "id").select(
        (order * 10 + line).cast("string").alias("id"),
        F.round(F.col("rating").cast("double"), 3).alias("rating"),
        F.col("whole").cast("int").alias("whole"),
    )


@query("stream_clean", _clean_sql(PRODUCT, SQL["products_dirty"]))
def stream_clean(spark, sf_dir):
    """Product lines cleaned as a stream, file by file, until all that is there is read."""
    path = scratch_path(spark, "stream")
    quoted = F.concat(F.lit('"'), "features", F.lit('"'))
    record = F.concat_ws(",", "id", "parent_prod_id", "main_category", "price", "title", quoted, "store", "rating_number")
    view(spark, sf_dir, "products_dirty").select(record.alias("value")).repartition(3).write.text(f"{path}/raw")
    lines = spark.readStream.text(f"{path}/raw")
    write_checked_stream(check_record_stream(lines, PRODUCT), PRODUCT, f"{path}/out", f"{path}/progress").awaitTermination()
    return spark.read.parquet(f"{path}/out/clean").select(*PRODUCT.fields)
