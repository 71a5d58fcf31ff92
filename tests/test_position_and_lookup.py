"""Positions, id repair, split and lookups, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import lookup
from ratingloom.operators.features import apply_categories, category_codes
from ratingloom.operators.ids import reassign_duplicate_ids
from ratingloom.operators.position import (
    file_position,
    first_rows,
    number_rows,
    row_position,
)
from ratingloom.operators.products import first_seen, lookup_products, merged_projection
from ratingloom.plans import merging
from ratingloom.operators import split as split_module
from ratingloom.operators.split import train_size, train_val_split


def skewed_ids(n=3000, seed=1):
    rng = random.Random(seed)
    return [
        (i, "7" if rng.random() < 0.34 else rng.choice(["007", "x"] + [str(k) for k in range(900)]))
        for i in range(n)
    ]


def python_reassign(rows):
    def whole(s):
        return int(s) if s.isdigit() else None

    top = max([0, *(whole(s) for _, s in rows if whole(s) is not None)])
    seen, out = set(), []
    for pos, s in rows:
        n = whole(s)
        if n is not None and n in seen:
            top += 1
            out.append((pos, str(top)))
        else:
            out.append((pos, s if n is None else str(n)))
        seen.add(n)
    return out


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_reassign_matches_a_sequential_pass(spark, monkeypatch, limit):
    monkeypatch.setattr(
        lookup, "fits_broadcast", lambda df, _=None: lookup.measured_bytes(df) <= limit
    )
    rows = skewed_ids()
    df = spark.createDataFrame(rows, "pos bigint, id string").repartition(5)
    found = reassign_duplicate_ids(df).orderBy("pos").collect()
    assert [(r["pos"], r["id"]) for r in found] == python_reassign(rows)


def test_number_rows_over_gaps_and_many_runs(spark):
    positions = sorted(random.Random(2).sample(range(1 << 45), 5000))
    df = spark.createDataFrame([(p,) for p in positions], "pos bigint").repartition(7)
    found = number_rows(df, "n").orderBy("pos").collect()
    assert [r["n"] for r in found] == list(range(5000))


def test_order_position_with_a_hot_leading_key(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(6)
    found = row_position(df, ["k", "i"], "n").collect()
    assert [(r["k"], r["i"]) for r in sorted(found, key=lambda r: r["n"])] == sorted(rows)
    assert first_rows(df, 10, ["k", "i"]).count() == 10


def test_file_position(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") * 3)
    for part in range(3):
        df.filter(F.col("id") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path))
    placed = file_position(spark.read.parquet(str(tmp_path))).orderBy("pos").collect()
    assert len({r["pos"] for r in placed}) == 1000
    # file after file, each in its own order
    parts = [r["id"] % 3 for r in placed]
    assert sum(a != b for a, b in zip(parts, parts[1:])) == 2
    for part in range(3):
        own = [r["id"] for r in placed if r["id"] % 3 == part]
        assert own == sorted(own)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 50}")) for i in range(3000)],
        "i int, k string",
    ).repartition(8)
    right = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(40)]], "r string, v int")
    salted = lookup.salted_join(left, right, "k", "r", how).select("i", "k", "v")
    plain = left.join(right, F.col("k") == F.col("r"), how).select("i", "k", "v")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    spread = lookup.salted_join(left, right, "k", "r", how)
    assert spread.columns == ["i", "k", "r", "v"]


def test_first_seen_and_two_key_lookup(spark):
    products = spark.createDataFrame(
        [(2, "20", "A", "second"), (1, "10", "A", "first"), (3, "30", "B", None), (4, "40", "", "x")],
        "pos bigint, id string, parent_prod_id string, title string",
    )
    reviews = spark.createDataFrame(
        [("1", "A", "B"), ("2", "Z", "B"), ("3", "Z", "Y"), ("4", None, "A"), ("5", "", "")],
        "id string, prod_id string, parent_prod_id string",
    )
    seen = first_seen(products)
    assert {(r["parent_prod_id"], r["id"]) for r in seen.collect()} == {("A", "10"), ("B", "30")}
    expected = {
        "1": ("first", "prod_id"), "2": (None, "parent_prod_id"), "3": ("NA", "none"),
        "4": ("first", "parent_prod_id"), "5": ("NA", "none"),
    }
    for limit in (lookup.BROADCAST_BYTES, 0):
        found = lookup_products(reviews, seen, keep_hit=True, limit=limit).collect()
        assert {r["id"]: (r["prod_title"], r["hit"]) for r in found} == expected


def test_split_is_exact_and_repeatable(spark, monkeypatch):
    df = spark.createDataFrame([(str(i % 10), i) for i in range(5003)], "id string, pos bigint")
    picked = train_val_split(df, seed=5).filter("is_train")
    assert picked.count() == train_size(5003) == 4002
    again = train_val_split(df.repartition(9), seed=5).filter("is_train")
    assert picked.exceptAll(again).count() == 0
    other = train_val_split(df, seed=6).filter("is_train")
    assert picked.exceptAll(other).count() > 0
    assert train_size(1) == 1 and train_size(2) == 1
    # ranges that are still too full are cut further
    monkeypatch.setattr(split_module, "_FULL", 3)
    narrow = train_val_split(df, seed=5).filter("is_train")
    assert picked.exceptAll(narrow).count() == 0


def test_category_codes_both_ways(spark, monkeypatch):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("",)], "c string")
    small = {r["c"]: r["c_code"] for r in category_codes(df, "c").collect()}
    assert small == {"": 0.0, "a": 1.0, "b": 2.0}
    codes = category_codes(df, "c")
    new = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    assert [r["c"] for r in apply_categories(new, {"c": codes}).collect()] == [1.0, -1.0, 0.0]
    from ratingloom.operators import features

    monkeypatch.setattr(features, "fits_broadcast", lambda df: False)
    large = {r["c"]: r["c_code"] for r in category_codes(df, "c").collect()}
    assert large == small


def test_numbers_are_merged_without_the_texts(spark, monkeypatch):
    """The same rows as a projection of the whole lookup, but no text of a review or product
    reaches it."""
    names = "id", "prod_id", "parent_prod_id", "title", "comment", "time", "votes", "purchased", "rating"
    rows = [(str(i), f"k{i % 7}", f"k{i % 5}", "t", "c", "1", "2", "TRUE", "5") for i in range(40)]
    reviews = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    kinds = "pos bigint, id string, parent_prod_id string, main_category string, price string, title string, store string, rating_number string"
    products = spark.createDataFrame([(i, str(i), f"k{i % 3}", "m", f"${i}", "t", f"s{i}", "7") for i in range(6)], kinds)
    given = []

    def looked_up(left, right, miss):
        given.extend([*left.columns, *right.columns])
        return lookup_products(left, right, miss, limit=0)

    monkeypatch.setattr(merging, "lookup_products", looked_up)
    whole = merged_projection(merging.merge_products(reviews, products))
    assert {"title", "comment"} < set(given)
    given.clear()
    numbers = merging.merge_numbers(reviews, products)
    assert not {"title", "comment", "features", "user_id"} & set(given)
    assert numbers.columns == whole.columns
    assert sorted(map(tuple, numbers.collect())) == sorted(map(tuple, whole.collect()))
