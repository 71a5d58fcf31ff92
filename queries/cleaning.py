"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query
from queries.views import LINE_ORDER, ORDER_SQL, SQL, sorted_view, table, view
from ratingloom.checkpoints import scratch_path
from ratingloom.functions.cells import csv_cells
from ratingloom.functions.text import sanitise
from ratingloom.operators.features import with_row_ids
from ratingloom.operators.ids import max_id, reassign_duplicate_ids
from ratingloom.operators.normalise import clamp_negative, clamp_rating, normalise
from ratingloom.operators.position import (
    POS,
    first_rows,
    order_position,
    row_position,
)
from ratingloom.operators.repair import (
    lift_tail_words,
    merge_surplus,
    pad_cells,
    recover_absorbed_tail,
    undo_left_shift,
)
from ratingloom.operators.reports import row_size_profile
from ratingloom.operators.validate import (
    clean_rows,
    cleaning_summary,
    quarantined_rows,
    reason_counts,
)
from ratingloom.plans.cleaning import CleaningRun, check_rows, clean_file, clean_frame, strict_rows
from ratingloom.sinks.tables import write_csv, write_table
from ratingloom.sources.csv_tables import scan_clean
from ratingloom.sources.raw_text import frame_records, scan_lines
from ratingloom.sources.schema_file import PREDICT, PRODUCT, TRAIN, Layout

# --- SQL pieces -----------------------------------------------------------------

_NO_CONTROL = r"regexp_replace({c}, '[\x00-\x1F\x{{FFFD}}]', ' ', 'g')"
_INT = r"regexp_full_match(trim({c}), '[+-]?[0-9]+')"


def _sane(c: str) -> str:
    return _NO_CONTROL.format(c=c) + f" as {c}"


def _reason_sql(layout: Layout) -> str:
    """Why a row is corrupt, '' if it is not."""
    stop = " ".join(
        f"when trim({f}) = '' then '{f} missing attribute'"
        for f in layout.fields
        if f not in layout.optional
    )
    tests = []
    if layout.kind == "product":
        tests.append(f"case when not {_INT.format(c='id')} then 'id not integer' end")
    for f, letter in (("user_id", "u"), ("prod_id", "a"), ("parent_prod_id", "a")):
        if f in layout.fields:
            tests.append(
                f"case when not regexp_full_match(trim({f}), '{letter}_[A-Za-z0-9]{{16}}') "
                f"then '{f} malformed' end"
            )
    for f in ("votes", "rating_number"):
        if f in layout.fields:
            tests.append(f"case when not {_INT.format(c=f)} then '{f} not integer' end")
    if "purchased" in layout.fields:
        tests.append(
            "case when upper(trim(purchased)) not in ('TRUE', 'FALSE') "
            "then 'purchased malformed' end"
        )
    if layout.has_rating:
        tests.append(
            f"case when not {_INT.format(c='rating')} then 'rating not integer' "
            "when cast(rating as bigint) not between 1 and 5 then 'rating out of range' end"
        )
    return f"case {stop} else concat_ws('; ', {', '.join(tests)}) end"


def _checked_sql(layout: Layout, source: str) -> str:
    comment = (
        "replace (case when trim(comment) = '' then 'NA' else comment end as comment)"
        if "comment" in layout.fields
        else ""
    )
    return (
        f"select *, {_reason_sql(layout)} as corruption_reasons "
        f"from (select * {comment} from ({source}) s) c"
    )


def _clean_sql(layout: Layout, source: str) -> str:
    """Valid rows, normalised."""
    columns = []
    for f in layout.fields:
        c = f
        if f in layout.sanitised:
            c = _NO_CONTROL.format(c=c)
        if layout.kind == "product" and f in layout.optional:
            c = f"case when trim({c}) = '' then 'NA' else {c} end"
        if f in ("votes", "rating_number"):
            c = f"case when cast({f} as bigint) < 0 then '0' else {f} end"
        columns.append(f"{c} as {f}")
    return (
        f"select {', '.join(columns)} from ({_checked_sql(layout, source)}) k "
        "where corruption_reasons = ''"
    )


def _quarantine_sql(layout: Layout, source: str) -> str:
    return (
        f"select {', '.join(layout.fields)}, corruption_reasons "
        f"from ({_checked_sql(layout, source)}) k where corruption_reasons <> ''"
    )


def _renumbered_sql(layout: Layout, source: str) -> str:
    """Clean rows with later copies of an id renumbered in line order."""
    names = ", ".join(layout.fields)
    others = ", ".join(f for f in layout.fields if f != "id")
    clean = _clean_sql(layout, source).replace(
        "select ", f"select row_number() over (order by {ORDER_SQL}) as rn, ", 1
    )
    return f"""
with clean as ({clean}),
copies as (select *, row_number() over (partition by cast(id as bigint) order by rn) as copy
           from clean),
ranked as (select *, sum(case when copy > 1 then 1 else 0 end) over (order by rn) as later,
           max(cast(id as bigint)) over () as top from copies)
select case when copy > 1 then cast(top + later as string) else id end as id, {others}
from (select rn, copy, later, top, {names} from ranked) r"""


# --- frames of text columns -------------------------------------------------------


def _checked(spark: SparkSession, sf_dir: str, name: str, layout: Layout) -> DataFrame:
    return check_rows(view(spark, sf_dir, name).select(*layout.fields), layout)


def _clean(spark: SparkSession, sf_dir: str, name: str, layout: Layout) -> DataFrame:
    return normalise(clean_rows(_checked(spark, sf_dir, name, layout)), layout)


@query("reviews_clean", _clean_sql(TRAIN, SQL["dirty"]))
def reviews_clean(spark, sf_dir):
    return _clean(spark, sf_dir, "dirty", TRAIN)


@query("reviews_quarantine", _quarantine_sql(TRAIN, SQL["dirty"]))
def reviews_quarantine(spark, sf_dir):
    return quarantined_rows(_checked(spark, sf_dir, "dirty", TRAIN))


@query("predict_clean", _clean_sql(PREDICT, SQL["dirty"]))
def predict_clean(spark, sf_dir):
    return _clean(spark, sf_dir, "dirty", PREDICT)


@query("predict_quarantine", _quarantine_sql(PREDICT, SQL["dirty"]))
def predict_quarantine(spark, sf_dir):
    return quarantined_rows(_checked(spark, sf_dir, "dirty", PREDICT))


@query("products_clean", _clean_sql(PRODUCT, SQL["products_dirty"]))
def products_clean(spark, sf_dir):
    return _clean(spark, sf_dir, "products_dirty", PRODUCT)


@query("products_quarantine", _quarantine_sql(PRODUCT, SQL["products_dirty"]))
def products_quarantine(spark, sf_dir):
    return quarantined_rows(_checked(spark, sf_dir, "products_dirty", PRODUCT))


@query(
    "clean_summary",
    f"""select count(*) as input_rows,
  count(*) filter (corruption_reasons = '') as clean_rows,
  count(*) filter (corruption_reasons <> '') as corrupted_rows
from ({_checked_sql(TRAIN, SQL["dirty"])}) k""",
)
def clean_summary(spark, sf_dir):
    return cleaning_summary(_checked(spark, sf_dir, "dirty", TRAIN))


@query(
    "reason_histogram",
    f"""select reason, count(*) as rows from (
  select unnest(string_split(corruption_reasons, '; ')) as reason
  from ({_checked_sql(TRAIN, SQL["dirty"])}) k where corruption_reasons <> '') r
group by reason""",
)
def reason_histogram(spark, sf_dir):
    return reason_counts(_checked(spark, sf_dir, "dirty", TRAIN))


@query(
    "max_valid_id",
    f"""select greatest(coalesce(max(cast(id as bigint)), 0), 0) as max_id
from ({_clean_sql(TRAIN, SQL["dirty"])}) k""",
)
def max_valid_id(spark, sf_dir):
    rows = _clean(spark, sf_dir, "dirty", TRAIN).select("id")
    return spark.range(1).select(max_id(rows).cast("bigint").alias("max_id"))


@query("dup_id_reassign", _renumbered_sql(TRAIN, SQL["reviews"]))
def dup_id_reassign(spark, sf_dir):
    rows = order_position(view(spark, sf_dir, "reviews"), LINE_ORDER).select(POS, *TRAIN.fields)
    return reassign_duplicate_ids(normalise(rows, TRAIN)).drop(POS)


@query("train_clean", _renumbered_sql(TRAIN, SQL["dirty"]))
def train_clean(spark, sf_dir):
    ordered = order_position(view(spark, sf_dir, "dirty"), LINE_ORDER)
    return clean_frame(ordered, TRAIN).clean.drop(POS)


@query(
    "strict_valid_rows",
    f"""select {", ".join(TRAIN.fields)} from ({_checked_sql(TRAIN, SQL["dirty"])}) k
where corruption_reasons = ''""",
)
def strict_valid_rows(spark, sf_dir):
    path = scratch_path(spark, "strict")
    write_csv(view(spark, sf_dir, "dirty").select(*TRAIN.fields), path)
    return strict_rows(spark, path, TRAIN)


@query("clean_csv_round_trip", _clean_sql(TRAIN, SQL["dirty"]))
def clean_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "clean")
    write_csv(reviews_clean(spark, sf_dir), path)
    return scan_clean(spark, path)


# times and votes whose cells hold line breaks, as they may in valid rows
_BREAKS = """
select {columns}, id, user_id, prod_id, parent_prod_id, title, comment,
  case when l_orderkey % 3 = 0 then concat(substr(time, 1, 4), chr(10), substr(time, 5))
       else time end as time,
  case when l_orderkey % 5 = 0 then concat(votes, chr(10)) else votes end as votes,
  purchased, rating
from ({reviews}) r"""


def _with_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _BREAKS.format(columns=ORDER_SQL, reviews="select * from {r}")
    rows = spark.sql(text, r=view(spark, sf_dir, "reviews"))
    return order_position(rows, LINE_ORDER).select(POS, *TRAIN.fields)


_BREAKS_SQL = _BREAKS.format(columns=ORDER_SQL, reviews=SQL["reviews"])
_BREAKS_CLEAN = f"""
select {{row}}, user_id, prod_id, parent_prod_id, title, comment, time,
  case when cast(replace(votes, chr(10), '') as bigint) < 0 then '0' else votes end as votes,
  purchased, rating
from ({_BREAKS_SQL}) b"""


@query("clean_csv_breaks", _BREAKS_CLEAN.format(row="id"))
def clean_csv_breaks(spark, sf_dir):
    """Cells with line breaks through the CSV sink and the scan that splits files."""
    path = scratch_path(spark, "clean")
    write_table(normalise(_with_breaks(spark, sf_dir), TRAIN), path, "csv")
    return scan_clean(spark, path)


@query("csv_row_ids", _BREAKS_CLEAN.format(row=f"row_number() over (order by {ORDER_SQL}) - 1 as id"))
def csv_row_ids(spark, sf_dir):
    """Rows that come without ids are numbered in the order of the files' records."""
    path = scratch_path(spark, "clean")
    write_table(normalise(_with_breaks(spark, sf_dir), TRAIN).drop("id"), path, "csv")
    return with_row_ids(scan_clean(spark, path, pos=True), [POS]).drop(POS)


@query("strict_csv_breaks", f"select {', '.join(TRAIN.fields)} from ({_BREAKS_SQL}) b")
def strict_csv_breaks(spark, sf_dir):
    path = scratch_path(spark, "strict")
    write_table(_with_breaks(spark, sf_dir), path, "csv")
    return strict_rows(spark, path, TRAIN)


# --- single operators ---------------------------------------------------------------


@query("sanitize_text", f"select doc_id, {_sane('text')} from documents")
def sanitize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", sanitise(F.col("text")).alias("text"))


@query(
    "clamp_values",
    f"""select id, case when cast(votes as bigint) < 0 then '0' else votes end as votes,
  cast(least(greatest(cast(votes as bigint), 1), 5) as string) as rating
from ({SQL["reviews"]}) r""",
)
def clamp_values(spark, sf_dir):
    rows = view(spark, sf_dir, "reviews")
    return rows.select(
        "id",
        clamp_negative(F.col("votes")).alias("votes"),
        clamp_rating(F.col("votes")).alias("rating"),
    )


# comments of two to four comma-separated parts, unquoted, and records without a tail
_SURPLUS = """
select concat_ws(',', id, user_id, prod_id, parent_prod_id, title, {comment}, time, votes,
  purchased, rating) as record, id, {comment} as comment, time, rating
from ({reviews}) r"""
_COMMENT = (
    "case when l_linenumber % 3 = 0 then comment "
    "when l_linenumber % 3 = 1 then concat(p_type, ', ', p_brand) "
    "else concat(p_type, ',', p_brand, ', ', title, ',x') end"
)


@query(
    "merge_surplus",
    f"""select id, regexp_replace(comment, ',', ' ', 'g') as comment, time, rating
from ({_SURPLUS.format(comment=_COMMENT, reviews=SQL["reviews"])}) s""",
)
def merge_surplus_cells(spark, sf_dir):
    record = F.concat_ws(
        ",", "id", "user_id", "prod_id", "parent_prod_id", "title", F.expr(_COMMENT),
        "time", "votes", "purchased", "rating",
    )
    cells = view(spark, sf_dir, "reviews").select(csv_cells(record).alias("cells"))
    merged = cells.select(merge_surplus(F.col("cells"), TRAIN).alias("c"))
    return merged.select(
        F.col("c")[0].alias("id"),
        F.col("c")[5].alias("comment"),
        F.col("c")[6].alias("time"),
        F.col("c")[9].alias("rating"),
    )


@query(
    "pad_short",
    f"""select id, title, '' as comment, '' as rating, 10 as n_cells from ({SQL["reviews"]}) r""",
)
def pad_short(spark, sf_dir):
    record = F.concat_ws(",", "id", "user_id", "prod_id", "parent_prod_id", "title")
    cells = view(spark, sf_dir, "reviews").select(csv_cells(record).alias("c"))
    padded = cells.select(pad_cells(F.col("c"), TRAIN.size).alias("c"))
    return padded.select(
        F.col("c")[0].alias("id"),
        F.col("c")[4].alias("title"),
        F.col("c")[5].alias("comment"),
        F.col("c")[9].alias("rating"),
        F.size("c").alias("n_cells"),
    )


_ABSORBED = (
    "concat(comment, ',', time, ',', votes, ',', purchased, "
    "case when l_linenumber % 4 = 0 then '' else concat(',', rating) end)"
)


@query(
    "tail_regex",
    rf"""with a as (select id, {_ABSORBED} as cell from ({SQL["reviews"]}) r),
m as (select id, cell, regexp_full_match(cell,
  '(?s).*,[0-9Ee.+-]+,[0-9]+,(TRUE|FALSE|True|False|true|false),[0-9]+') as hit from a)
select id, case when hit then string_split(cell, ',')[1] else cell end as comment,
  case when hit then string_split(cell, ',')[2] end as time,
  case when hit then string_split(cell, ',')[3] end as votes,
  case when hit then string_split(cell, ',')[4] end as purchased,
  case when hit then string_split(cell, ',')[5] end as rating from m""",
)
def tail_regex(spark, sf_dir):
    cells = F.array(
        "id", "user_id", "prod_id", "parent_prod_id", "title", F.expr(_ABSORBED)
    )
    rows = view(spark, sf_dir, "reviews").select(recover_absorbed_tail(cells, TRAIN).alias("c"))
    names = {"id": 0, "comment": 5, "time": 6, "votes": 7, "purchased": 8, "rating": 9}
    return rows.select(*[F.get("c", F.lit(i)).alias(n) for n, i in names.items()])


# a third each: whole rows, rows with all four values in the comment, rows with three
_TAIL_WORDS = """
select id, user_id, prod_id, parent_prod_id, title,
  case l_linenumber % 3 when 0 then comment
    when 1 then concat(comment, ', ', time, ' ', votes, ',', purchased, ' ', rating)
    else concat(comment, ' ', votes, ' ', purchased, ' ', rating) end as comment,
  case when l_linenumber % 3 = 1 then '' else time end as time,
  case when l_linenumber % 3 = 0 then votes else '' end as votes,
  case when l_linenumber % 3 = 0 then purchased else '' end as purchased,
  case when l_linenumber % 3 = 0 then rating else '' end as rating
from ({reviews}) r"""
_TAIL_COLUMNS = ("id", "comment", "time", "votes", "purchased", "rating")


@query(
    "tail_tokens",
    rf"""with t as ({_TAIL_WORDS.format(reviews=SQL["reviews"])}),
w as (select *, regexp_split_to_array(trim(comment), '[\s,]+') as w from t),
h as (select *, purchased = '' as bad, try_cast(w[-4] as double) is not null as timed from w)
select id,
  case when bad then array_to_string(w[:(len(w) - case when timed then 4 else 3 end)], ' ')
    else comment end as comment,
  case when bad and timed then w[-4] else time end as time,
  case when bad then w[-3] else votes end as votes,
  case when bad then w[-2] else purchased end as purchased,
  case when bad then w[-1] else rating end as rating from h""",
)
def tail_tokens(spark, sf_dir):
    rows = spark.sql(
        _TAIL_WORDS.format(reviews="select * from {r}"), r=view(spark, sf_dir, "reviews")
    )
    return lift_tail_words(rows, TRAIN).select(*_TAIL_COLUMNS)


_SHIFTED = """
select id, user_id, prod_id, parent_prod_id, title,
  case when l_linenumber % 2 = 0 then comment
    else concat(comment, ' ', time, ' ', votes) end as comment,
  case when l_linenumber % 2 = 0 then time else purchased end as time,
  case when l_linenumber % 2 = 0 then votes else rating end as votes,
  case when l_linenumber % 2 = 0 then purchased else '' end as purchased,
  case when l_linenumber % 2 = 0 then rating else '' end as rating
from ({reviews}) r"""


@query(
    "left_shift",
    rf"""with s as ({_SHIFTED.format(reviews=SQL["reviews"])}),
w as (select *, string_split(comment, ' ') as w, time in ('TRUE', 'FALSE') as hit from s)
select id, case when hit then array_to_string(w[:(len(w) - 2)], ' ') else comment end as comment,
  case when hit then w[-2] else time end as time,
  case when hit then w[-1] else votes end as votes,
  case when hit then time else purchased end as purchased,
  case when hit then votes else rating end as rating from w""",
)
def left_shift(spark, sf_dir):
    rows = spark.sql(
        _SHIFTED.format(reviews="select * from {r}"), r=view(spark, sf_dir, "reviews")
    )
    return undo_left_shift(rows, TRAIN).select(*_TAIL_COLUMNS)


# --- raw text, from files -----------------------------------------------------------

# Records of a packed file, which one task reads whole: about a common split's bytes of text.
_FILE_RECORDS = 1_000_000


def _raw_file(spark: SparkSession, sf_dir: str, packed: bool = True) -> str:
    """The damaged records as text files in line order."""
    path = scratch_path(spark, "raw-reviews")
    writer = sorted_view(spark, sf_dir, "records").select("record").write
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", _FILE_RECORDS)
    writer.text(path)
    return path


def _raw_run(spark: SparkSession, sf_dir: str) -> CleaningRun:
    return clean_file(spark, _raw_file(spark, sf_dir), TRAIN, header=False)


@query(
    "frame_and_tokenise",
    f"""with r as ({SQL["records"]}),
c as (select case
  when shape in (1, 6) then list_concat(string_split(split_part(record, '"', 1), ',')[:5],
    [split_part(record, '"', 2)], string_split(split_part(record, '"', 3), ',')[2:])
  when shape = 3 then list_concat(string_split(split_part(record, '"', 1), ',')[:5],
    [split_part(record, '"', 2)])
  else string_split(record, ',') end as cells from r)
select array_to_string(cells, '|') as cells, cast(len(cells) as int) as n_cells from c""",
)
def frame_and_tokenise(spark, sf_dir):
    records = frame_records(scan_lines(spark, _raw_file(spark, sf_dir)), header=False)
    cells = records.select(csv_cells(F.col("record")).alias("cells"))
    return cells.select(F.array_join("cells", "|").alias("cells"), F.size("cells").alias("n_cells"))


_REPAIRED = f"""
select {ORDER_SQL}, id, user_id, prod_id, parent_prod_id, title,
  case shape when 1 then concat(p_type, ', ', p_brand) when 2 then concat(p_type, '  ', p_brand)
    when 6 then concat(p_type, chr(10), p_brand) when 7 then concat(p_type, chr(10), p_brand)
    else concat(p_type, ' ', p_brand) end as comment,
  time, votes, purchased, rating
from ({SQL["raw"]}) r"""


@query("raw_train_clean", _renumbered_sql(TRAIN, _REPAIRED))
def raw_train_clean(spark, sf_dir):
    return _raw_run(spark, sf_dir).clean.drop(POS)


@query("raw_train_quarantine", _quarantine_sql(TRAIN, _REPAIRED))
def raw_train_quarantine(spark, sf_dir):
    return _raw_run(spark, sf_dir).quarantine.drop(POS)


@query(
    "raw_train_summary",
    f"""select count(*) as input_rows, count(*) filter (corruption_reasons = '') as clean_rows,
  count(*) filter (corruption_reasons <> '') as corrupted_rows
from ({_checked_sql(TRAIN, _REPAIRED)}) k""",
)
def raw_train_summary(spark, sf_dir):
    return _raw_run(spark, sf_dir).summary


def _raw_product_run(spark: SparkSession, sf_dir: str) -> CleaningRun:
    path = scratch_path(spark, "raw-products")
    quoted = F.concat(F.lit('"'), "features", F.lit('"'))
    record = F.concat_ws(
        ",", "id", "parent_prod_id", "main_category", "price", "title",
        F.when(F.contains("features", F.lit(",")), quoted).otherwise(F.col("features")),
        "store", "rating_number",
    )
    rows = view(spark, sf_dir, "products_dirty")
    rows.repartitionByRange("pos").sortWithinPartitions("pos").select(record).write.text(path)
    return clean_file(spark, path, PRODUCT, header=False)


@query("raw_products_clean", _clean_sql(PRODUCT, SQL["products_dirty"]))
def raw_products_clean(spark, sf_dir):
    return _raw_product_run(spark, sf_dir).clean.drop(POS)


@query("raw_products_quarantine", _quarantine_sql(PRODUCT, SQL["products_dirty"]))
def raw_products_quarantine(spark, sf_dir):
    return _raw_product_run(spark, sf_dir).quarantine.select(*PRODUCT.fields, "corruption_reasons")


# --- order and size -------------------------------------------------------------------


@query(
    "row_position",
    f"""select l_orderkey, l_linenumber, l_partkey,
  row_number() over (order by {ORDER_SQL}) - 1 as row_no from lineitem""",
)
def row_positions(spark, sf_dir):
    rows = row_position(table(spark, sf_dir, "lineitem"), LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "row_no")


@query(
    "row_size_profile",
    f"""select count(*) as lines, cast(sum(strlen(record) + 1) as bigint) as bytes,
  round(avg(strlen(record) + 1), 6) as avg_line_bytes, count(*) as est_rows
from (select unnest(string_split(record, chr(10))) as record from ({SQL["records"]}) s) r""",
)
def size_profile(spark, sf_dir):
    # the file has no header, and each of its lines a line feed
    profile = row_size_profile(spark, _raw_file(spark, sf_dir, packed=False), header=False)
    return profile.withColumn("avg_line_bytes", F.round("avg_line_bytes", 6))


@query(
    "first_lines",
    f"""select id, record from ({SQL["records"]}) r order by {ORDER_SQL} limit 1000""",
)
def first_lines(spark, sf_dir):
    # the sampling operator itself: its size is the feature
    return first_rows(view(spark, sf_dir, "records"), 1000, LINE_ORDER).select("id", "record")
