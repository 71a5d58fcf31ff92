"""Column expressions against Python's own reading of the same text."""

import csv
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.functions import numbers, text
from ratingloom.functions.cells import csv_cells


def evaluate(spark, values, **exprs):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    found = rows.select("i", *[e(F.col("v")).alias(n) for n, e in exprs.items()])
    return [tuple(r)[1:] for r in sorted(found.collect(), key=lambda r: r["i"])]


def python_cells(record):
    try:
        return next(csv.reader([record], delimiter=","))
    except csv.Error:
        return record.split(",")


RECORD = st.text(alphabet='",,ab \n', min_size=1, max_size=14).map(
    lambda s: s.strip("\n")
).filter(bool)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(records=st.lists(RECORD, min_size=150, max_size=400))
def test_csv_cells_reads_as_python_does(spark, records):
    found = evaluate(spark, records, cells=csv_cells)
    wrong = [(r, f[0], python_cells(r)) for r, f in zip(records, found) if f[0] != python_cells(r)]
    assert not wrong


def test_long_cells(spark):
    half = "y," * 70_000
    records = [f'a,"{half}{half}",b', f'"{"q" * 100_000},{"z" * 100_000}', "y" * 140_000]
    found = [f[0] for f in evaluate(spark, records, cells=csv_cells)]
    assert found == [["a", half + half, "b"], [f"{'q' * 100_000},{'z' * 100_000}"], ["y" * 140_000]]


def python_int(s):
    try:
        return str(int(s.strip()))
    except ValueError:
        return None


def python_float(s):
    try:
        float(s.strip())
        return True
    except ValueError:
        return False


def number_like(rng):
    alphabet = "0123456789" * 3 + "+-_._eE  \t\x1c\x85  ٣７xnaif"
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6)))


def test_number_texts_read_as_python_does(spark):
    rng = random.Random(3)
    values = [number_like(rng) for _ in range(6000)]
    values += ["inf", "-Infinity", "nan", "1e5", "1_0.5_0e1_0", "007", "-0", "-00", "+5", "1d", "1f",
               "99999999999999999999", "-٣", " 4 ", "0x1", "1__0", "_1", "1_"]
    found = evaluate(spark, values, n=text.integer_text, i=text.is_integer, f=text.is_float,
                     neg=text.is_negative, r=text.is_rating, b=text.is_blank, s=text.strip)
    for v, (n, i, f, neg, r, b, s) in zip(values, found):
        expected = python_int(v)
        assert n == expected and i == (expected is not None), repr(v)
        assert f == python_float(v), repr(v)
        assert neg == (expected is not None and int(v.strip()) < 0), repr(v)
        assert r == (expected in ("1", "2", "3", "4", "5")), repr(v)
        assert b == (v.strip() == "") and s == v.strip(), repr(v)


def test_nulls_are_blank_and_no_number(spark):
    (row,) = evaluate(spark, [None], b=text.is_blank, i=text.is_integer, f=text.is_float,
                      t=text.is_true_false, r=text.is_rating, n=text.default_na)
    assert row == (True, False, False, False, False, "NA")


def test_float_values(spark):
    values = ["1.58E+12", " 2.5 ", "1_000", "x", "1d"]
    assert evaluate(spark, values, v=text.float_value) == [
        (1.58e12,), (2.5,), (1000.0,), (None,), (None,),
    ]


def test_sanitise_and_words(spark):
    values = ["a\x00b\x1f\ufffdc\x20\x7f", " one,two\u00a0 three,, "]
    assert evaluate(spark, values, s=text.sanitise, w=text.words) == [
        ("a b  c \x7f", ["a\x00b", "\ufffdc", "\x7f"]),
        (values[1], ["one", "two", "three"]),
    ]


@pytest.mark.parametrize(
    "fn, cases",
    [
        (numbers.strip_number, {"1x2": 12.0, "-5": -5.0, "1-2": 0.0, "": 0.0, "1.58E+12": 1.5812,
                                None: 0.0}),
        (numbers.coerce_number, {"$1,234.50": 1234.5, "1\\2": 0.0, None: 0.0, "5.": 5.0, ".5": 0.5,
                                 ".": 0.0, "--5": 0.0}),
        (numbers.parse_number, {"1.58E+12": 1.58e12, "3 votes": 3.0, "nan": 0.0, None: 0.0}),
        (numbers.parse_rating, {"4": 4.0, "4.0": 4.0, "4.5": None, "r3": 3.0, "0": None, "6": None,
                                None: None}),
        (numbers.encode_true, {"TRUE": 1.0, "true": 1.0, "False": 0.0, "": 0.0, None: 0.0}),
    ],
)
def test_numbers(spark, fn, cases):
    assert evaluate(spark, list(cases), v=fn) == [(v,) for v in cases.values()]


def test_whole_ratings_round_half_to_even(spark):
    rows = spark.createDataFrame([(2.5, 2), (3.5, 4), (0.2, 1), (9.0, 5), (4.4, 4)], "p double, e int")
    found = rows.select(numbers.whole_rating(F.col("p")).alias("w"), "e").collect()
    assert all(r["w"] == r["e"] for r in found)
    clipped = rows.select(numbers.clip_rating(F.col("p")).alias("c")).collect()
    assert [r["c"] for r in clipped] == [2.5, 3.5, 1.0, 5.0, 4.4]


def test_a_number_is_read_once(spark):
    """Plain cells are cast as they stand, others read once."""
    cells = [None, "", "7", "-0", "1.50", "+5", "1_000", "nan", "inf", "1.58E+12", "5.", "4 stars", "٣"]
    rows = spark.createDataFrame([(c,) for c in cells], "c string")
    done = rows.select(numbers.parse_number(F.col("c")).alias("n"))
    expected = [0.0, 0.0, 7.0, -0.0, 1.5, 5.0, 1000.0, 0.0, float("inf"), 1.58e12, 5.0, 4.0, 3.0]
    assert [r["n"] for r in done.collect()] == expected
    assert done._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1


def test_numbers_are_coerced_the_same_with_and_without_replacing(spark):
    """Dollar signs anywhere, signs behind them, and texts that only look like numbers."""
    cells = ["$5", "$$5", "$-5", "-$5", "5$", "$5$", "$.5", "$5.", "5", "-5.25", "1e5", "NaN", " 5", "5\n", "$5\n", "5d", "+5", "--5", "$", "", "-."]
    cells += ["5.5.5", "1,234.5", "$1,234.5", "\\5", "$\\5"]
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select("c", numbers.coerce_number(F.col("c"))).collect()
    for cell, value in rows:
        kept = re.sub(r"[^0-9.\\-]", "", cell)
        plain = re.fullmatch(r"-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)", kept)
        assert value == (float(kept) if plain else 0.0), cell
