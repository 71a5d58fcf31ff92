"""Split scans of quoted CSV against the reader that takes files whole."""

import csv
import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingloom import checkpoints
from ratingloom.plans.cleaning import strict_rows
from ratingloom.sources import csv_records
from ratingloom.sources.csv_records import read_csv_records, states_before
from ratingloom.sources.csv_tables import BROKEN, scan_clean, scan_merged, scan_strict
from ratingloom.sources.schema_file import TRAIN

_ALPHABET = ['"', '""', ",", "\n", "a", "bc", " ", "é", "x" * 40]


def rows_of(r, n, width=4):
    def cell():
        return "".join(r.choice(_ALPHABET) for _ in range(r.randrange(6)))

    return [[cell() for _ in range(width)] for _ in range(n)]


def csv_text(rows, r, end="\n"):
    out = io.StringIO()
    for row in rows:
        cells = [c if not set(c) & set('",\n') and r.random() < 0.5 and c.strip() == c and c else '"' + c.replace('"', '""') + '"' for c in row]
        out.write(",".join(cells) + end + (end if r.random() < 0.1 else ""))
    return out.getvalue()


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=30), st.integers(0, 1))
def test_states_follow_the_maps(maps, first):
    state, expected = first, [first]
    for m in maps:
        state = {0: 0, 1: 1, 2: state, 3: 1 - state, 4: state}[m]
        expected.append(state)
    assert states_before(np.array(maps, np.int64), first).tolist() == expected


@pytest.mark.parametrize(("seed", "limit"), [(1, csv_records.SPLITS_BYTES), (2, 0)])
def test_records_of_split_files(spark, tmp_path, tiny_splits, monkeypatch, seed, limit):
    monkeypatch.setattr(csv_records, "SPLITS_BYTES", limit)
    r = random.Random(seed)
    expected = []
    for k, n in enumerate((150, 0, 1, 90)):
        rows = rows_of(r, n)
        rows += [["long", "\n".join(["line"] * 400), '","', "z"]] if k == 3 else []
        (tmp_path / f"f{k}.csv").write_text("a,b,c,d\n" + csv_text(rows, r) if k != 1 else "")
        expected += rows
    expected = [tuple(row) for row in expected]
    records, headers = read_csv_records(spark, str(tmp_path))
    found = sorted((x["pos"], x["record"]) for x in records.collect())
    assert [p for p, _ in found] == list(range(len(expected)))
    assert [tuple(next(csv.reader(io.StringIO(x, newline="")))) for _, x in found] == expected
    assert {x["record"] for x in headers.collect()} == {"a,b,c,d"}
    clean = scan_clean(spark, str(tmp_path), pos=True).orderBy("pos").collect()
    assert [tuple(x)[1:] for x in clean] == expected


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_splits):
    r = random.Random(3)
    (tmp_path / "one.csv").write_text("a,b,c,d\n" + csv_text(rows_of(r, 300), r))
    lines = csv_records._lines(spark, str(tmp_path), False)
    assert lines.rdd.getNumPartitions() > 10


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_strict_scan_equals_the_whole_file_reader(spark, tmp_path, tiny_splits, end):
    r = random.Random(4)
    rows = rows_of(r, 120, TRAIN.size) + rows_of(r, 9, TRAIN.size - 1) + rows_of(r, 9, TRAIN.size + 2)
    r.shuffle(rows)
    path = str(tmp_path / "s.csv")
    with open(path, "w", newline="") as f:
        f.write(",".join(TRAIN.fields) + end + csv_text(rows, r, end))
    found = scan_strict(spark, path, TRAIN)
    whole = spark.read.csv(path, schema=found.schema, header=True, escape='"', multiLine=True, columnNameOfCorruptRecord=BROKEN)
    ok = [BROKEN]
    same = [sorted(map(repr, df.filter(f"{BROKEN} is null").drop(*ok).collect())) for df in (found, whole)]
    assert same[0] == same[1] and len(same[0]) == 120
    assert found.filter(f"{BROKEN} is not null").count() == 18


def test_merged_scan_equals_the_whole_file_reader(spark, tmp_path, tiny_splits):
    text = 'a,b,c\n NA ,"x\ny", 1 \n"", "q\n""r""\n",\n,NA,"NA"\n' * 20
    (tmp_path / "m.csv").write_text("h1,h2,h3\n" + text.replace("a,b,c\n", ""))
    found = scan_merged(spark, str(tmp_path / "m.csv"))
    whole = spark.read.csv(
        str(tmp_path / "m.csv"), header=True, escape='"', multiLine=True, nullValue="NA",
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
    )
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_open_quote_takes_in_the_rest_of_its_file_only(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text("h,i\n1,2\n3,\"open\n" + "x,y\n" * 200)
    (tmp_path / "b.csv").write_text("h,i\n5,6\n")
    records = read_csv_records(spark, str(tmp_path))[0].orderBy("pos").collect()
    assert [x["record"] for x in records] == ["1,2", "3,\"open\n" + "\n".join(["x,y"] * 200), "5,6"]


def test_files_must_agree_on_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h,i\n1,2\n")
    (tmp_path / "b.csv").write_text("i,h\n5,6\n")
    with pytest.raises(ValueError, match="headers"):
        scan_clean(spark, str(tmp_path))


def test_empty_and_missing_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv_records(spark, str(tmp_path))[0].count() == 0
    with pytest.raises(FileNotFoundError):
        scan_clean(spark, str(tmp_path / "none"))


def test_filters_on_cells_do_not_parse_again(spark, tmp_path):
    """A record is parsed once, whatever the tests on its cells."""
    path = str(tmp_path / "strict")
    row = ["1", "u_0123456789abcdef", "a_0123456789abcdef", "a_0123456789abcdef", "t", "c", "1", "2", "TRUE", "5"]
    (tmp_path / "strict").mkdir()
    (tmp_path / "strict" / "a.csv").write_text("\n".join([",".join(TRAIN.fields), ",".join(row), "1,2"]) + "\n")
    rows = strict_rows(spark, path, TRAIN)
    assert [list(r) for r in rows.collect()] == [row]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_records_are_cut_compactly(spark, tmp_path, monkeypatch):
    """Whole rows of text wait as zstd between the scan and its readers, and come back as they were."""
    cuts = str(tmp_path / "cuts")
    monkeypatch.setattr(checkpoints, "shared_folder", lambda spark: cuts)
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,\n')
    rows = scan_clean(spark, str(tmp_path / "t.csv"), pos=True)
    assert sorted(map(tuple, rows.collect())) == [(0, "1", "x\ny"), (1, "2", "")]
    parts = list((tmp_path / "cuts").glob("csv-records-*/*.parquet"))
    assert parts and all(".zstd." in p.name for p in parts)
