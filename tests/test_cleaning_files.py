"""Raw review and product files, against rows derived by hand."""

import random
import re

import pytest

from ratingloom.operators.validate import REASONS
from ratingloom.plans.cleaning import clean_file, strict_rows
from ratingloom.sources.raw_text import frame_records, scan_lines
from ratingloom.sources.schema_file import PREDICT, PRODUCT, TRAIN

T = "1600000000000"
P = "a_BBBBBBBBBBBBBBBB,a_CCCCCCCCCCCCCCCC"


def U(i):
    return f"u_AAAAAAAAAAAAAAA{i}"


HEADER = ",".join(TRAIN.fields)
LINES = [
    f"1,{U(1)},{P},Nice,Good stuff,{T},3,TRUE,5",
    f'2,{U(2)},{P},Nice,"Good, stuff",{T},3,TRUE,5',
    f"3,{U(3)},{P},Nice,Good, stuff,{T},3,TRUE,5",
    f'4,{U(4)},{P},Nice,"Good stuff,{T},3,TRUE,5',
    f"5,{U(5)},{P},Nice,Good stuff {T} 3 TRUE 5,,,,",
    f"6,{U(6)},{P},Nice,Good stuff {T} 3,TRUE,5,,",
    f"7,{U(7)},{P},Nice,,{T},-4,false,4",
    f"8,{U(8)},{P},,Good,{T},3,TRUE,5",
    f'9,{U(9)},{P},Nice,"line1\nline2",{T},3,TRUE,5',
    f"10,{U(0)},{P},Nice,line1\nline2,{T},3,TRUE,5",
    f"11,{U(1)},{P},Nice,Good,{T},x,TRUE,9",
    f"1,{U(1)},{P},Ni\x07ce,Good,{T},3,TRUE,2",
    f"13,{U(3)},{P},A,B,Good,{T},3,TRUE,5\nx14,{U(4)},{P},Nice,Good,{T},3,TRUE,5",
]
SWALLOWED = f"B Good {T} 3 TRUE 5 x14 {U(4)} {P.replace(',', ' ')} Nice Good"
# id -> title, comment, time, votes, purchased, rating
EXPECTED = {
    "1": ("Nice", "Good stuff", T, "3", "TRUE", "5"),
    "2": ("Nice", "Good, stuff", T, "3", "TRUE", "5"),
    "3": ("Nice", "Good  stuff", T, "3", "TRUE", "5"),
    "4": ("Nice", "Good stuff", T, "3", "TRUE", "5"),
    "5": ("Nice", "Good stuff", T, "3", "TRUE", "5"),
    "6": ("Nice", "Good stuff", T, "3", "TRUE", "5"),
    "7": ("Nice", "NA", T, "0", "false", "4"),
    "9": ("Nice", "line1 line2", T, "3", "TRUE", "5"),
    "10": ("Nice", "line1 line2", T, "3", "TRUE", "5"),
    "13": ("A", SWALLOWED, T, "3", "TRUE", "5"),
    "14": ("Ni ce", "Good", T, "3", "TRUE", "2"),
}


@pytest.fixture(scope="module")
def train_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "train.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", newline="")
    return str(path)


def tail(rows):
    names = ("title", "comment", "time", "votes", "purchased", "rating")
    return {r["id"]: tuple(r[n] for n in names) for r in rows}


def test_golden_lines(spark, train_file):
    run = clean_file(spark, train_file, TRAIN)
    assert tail(run.clean.collect()) == EXPECTED
    assert run.summary.first().asDict() == {
        "input_rows": 13, "clean_rows": 11, "corrupted_rows": 2,
    }
    bad = {r["id"]: r[REASONS] for r in run.quarantine.collect()}
    assert bad == {
        "8": "title missing attribute",
        "11": "votes not integer; rating out of range",
    }
    assert {r["reason"]: r["rows"] for r in run.reasons.collect()} == {
        "title missing attribute": 1, "votes not integer": 1, "rating out of range": 1,
    }


def test_compat_keeps_the_time_word(spark, train_file):
    run = clean_file(spark, train_file, TRAIN, compat=True)
    rows = tail(run.clean.collect())
    assert rows["5"][1] == f"Good stuff {T}"
    assert {k: v for k, v in rows.items() if k != "5"} == {
        k: v for k, v in EXPECTED.items() if k != "5"
    }


@pytest.mark.parametrize("size", ["97", "230"])
def test_framing_does_not_depend_on_splits(spark, train_file, size):
    before = {k: spark.conf.get(k) for k in
              ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = scan_lines(spark, train_file)
        assert lines.select("split").distinct().count() > 5
        found = [r["record"] for r in frame_records(lines).orderBy("pos").collect()]
        assert found == LINES
        clean = clean_file(spark, train_file, TRAIN).clean
        assert tail(clean.collect()) == EXPECTED
        assert [r["id"] for r in clean.orderBy("pos").collect()] == [
            "1", "2", "3", "4", "5", "6", "7", "9", "10", "14", "13",
        ]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("header", [True, False])
def test_random_framing_equals_a_regex_split(spark, tmp_path, header):
    r = random.Random(5)
    expected = []
    for k in range(4):
        lines = ["head"] if header else []
        for _ in range(120):
            start = f"{r.randrange(99)},{U(1)}," if r.random() < 0.6 else ""
            lines.append(start + "x" * r.choice([0, 1, 5, 60]))
        lines += ["y" * 50] * 40 if k == 2 else []  # splits without any start
        (tmp_path / f"f{k}.csv").write_text("\n".join(lines) + "\n")
        body = "\n".join(lines[header:])
        expected += [c.strip("\n") for c in re.split(r"\n(?=\d+,u_[A-Za-z0-9]{16},)", body) if c.strip("\n")]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for n, v in zip(names, ("400", "1")):
        spark.conf.set(n, v)
    try:
        records = frame_records(scan_lines(spark, str(tmp_path)), header).orderBy("pos").collect()
    finally:
        for n in names:
            spark.conf.unset(n)
    assert [x["record"] for x in records] == expected
    assert len({x["pos"] for x in records}) == len(expected)


def test_lines_ahead_of_the_first_record_and_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"head\n\njunk1\njunk2\n{LINES[0]}\n\nmore\n\n")
    (tmp_path / "b.csv").write_text(f"{LINES[1]}\nstray\n{LINES[2]}")
    (tmp_path / "c.csv").write_text("head\n")
    (tmp_path / "d.csv").write_text("")
    found = frame_records(scan_lines(spark, str(tmp_path))).orderBy("pos")
    assert [r["record"] for r in found.collect()] == [
        "junk1\njunk2", f"{LINES[0]}\n\nmore", "stray", LINES[2],
    ]
    unheaded = frame_records(scan_lines(spark, str(tmp_path)), header=False).orderBy("pos")
    assert [r["record"] for r in unheaded.collect()] == [
        "head\n\njunk1\njunk2", f"{LINES[0]}\n\nmore", f"{LINES[1]}\nstray", LINES[2], "head",
    ]


def test_other_line_breaks_and_bad_bytes(spark, tmp_path):
    path = tmp_path / "t.csv"
    line = f"1,{U(1)},{P},Ni\x0bce,A B,{T},3,TRUE,5"
    path.write_bytes(b"h\r\n" + line.encode() + b"\r2,bad\xff\n")
    found = [r["record"] for r in frame_records(scan_lines(spark, str(path))).collect()]
    assert found == [f"1,{U(1)},{P},Ni\nce,A\nB,{T},3,TRUE,5\n2,bad�"]


def test_predict_file(spark, tmp_path):
    lines = [
        f"7,{U(1)},{P},Nice,Good stuff {T} 3 TRUE,,,",
        f"007,{U(2)},{P},Nice,Good stuff {T} 3,TRUE,x,",
        f'x,{U(3)},{P},Nice,Good,{T},3,TRUE',
        f'9,{U(4)},{P},Nice,"Good,{T},3,True',
        f"9,{U(5)},{P},Nice,Good 4 FALSE,{T},,",
        f"9,{U(6)},{P},Nice,Good,{T},3,perhaps",
    ]
    path = tmp_path / "p.csv"
    path.write_text("\n".join([",".join(PREDICT.fields), *lines]))
    run = clean_file(spark, str(path), PREDICT)
    rows = [tuple(r)[1:] for r in run.clean.orderBy("pos").collect()]
    keys = [(r[0], r[5], r[6], r[7], r[8]) for r in rows]
    # the row with the unusual id belongs to the record in front of it
    swallowed = f"Good stuff TRUE x  x {U(3)} {P.replace(',', ' ')} Nice Good"
    assert keys == [
        ("7", "Good stuff", T, "3", "TRUE"),
        ("007", swallowed.replace("stuff TRUE", f"stuff {T} 3 TRUE"), T, "3", "TRUE"),
        ("9", "Good", T, "3", "True"),
        ("9", "Good", T, "4", "FALSE"),
    ]
    assert [r[REASONS] for r in run.quarantine.collect()] == ["purchased malformed"]


def test_product_file(spark, tmp_path):
    k = "a_AAAAAAAAAAAAAAAA"
    lines = [
        f"1,{k},Cat,$1,\x01,Feat\x02ure,Store,-5",
        "",
        f'2,{k},,,"T, ""x""",F,,7',
        f"3,{k},Cat,$1,T,,Store,7",
        "4,bad,Cat,$1,T,F,Store,x",
        f"5,{k},Cat,$1,T,F,Store,7,extra,more",
        f"6,{k},Cat",
        f"x,{k},Cat,$1,T,F,Store,1_0",
    ]
    path = tmp_path / "prod.csv"
    path.write_text("\n".join([",".join(PRODUCT.fields), *lines]))
    run = clean_file(spark, str(path), PRODUCT)
    assert [tuple(r)[1:] for r in run.clean.orderBy("pos").collect()] == [
        ("1", k, "Cat", "$1", "NA", "Feat ure", "Store", "0"),
        ("2", k, "NA", "NA", 'T, "x"', "F", "NA", "7"),
    ]
    bad = {r["id"]: (r[REASONS], r["extra_cells"]) for r in run.quarantine.collect()}
    assert bad == {
        "3": ("features missing attribute", None),
        "4": ("parent_prod_id malformed; rating_number not integer", None),
        "5": ("extra attribute", ["extra", "more"]),
        "6": ("features missing attribute", None),
        "x": ("id not integer", None),
    }
    assert run.summary.first()["input_rows"] == 7


def test_strict_rows(spark, train_file, tmp_path):
    # an open quote swallows lines up to the next quote; ids are not checked
    assert sorted(r["id"] for r in strict_rows(spark, train_file, TRAIN).collect()) == [
        "1", "1", "2", "x14",
    ]
    good = [LINES[i] for i in (0, 1, 6, 7, 8, 10)]
    path = tmp_path / "t.csv"
    path.write_text("\n".join([HEADER, *good, "", "3,4"]))
    found = {r["id"]: r for r in strict_rows(spark, str(path), TRAIN).collect()}
    assert set(found) == {"1", "2", "7", "9"}
    assert found["7"]["comment"] == "NA" and found["7"]["votes"] == "-4"
    assert found["9"]["comment"] == "line1\nline2"


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        clean_file(spark, str(tmp_path / "none.csv"), TRAIN)


def test_framing_survives_other_splits(spark, tmp_path):
    path = tmp_path / "many"
    path.mkdir()
    user = "u_" + "a" * 16
    for part in range(4):
        rows = [f"{part * 5000 + i},{user},x" + ("\ntail" if i % 7 == 0 else "") for i in range(5000)]
        (path / f"part-{part}.csv").write_text("\n".join(rows) + "\n")
    expected = sorted(
        f"{n},{user},x" + ("\ntail" if n % 5000 % 7 == 0 else "") for n in range(20_000)
    )
    names = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in zip(names, ("4", "128m", "1k")):
            spark.conf.set(n, v)
        records = frame_records(scan_lines(spark, str(path)), header=False)
        for n, v in zip(names, ("16", "16k", "1k")):
            spark.conf.set(n, v)
        assert sorted(r["record"] for r in records.collect()) == expected
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_ownerless_text_beyond_a_value_is_named(spark, tmp_path, monkeypatch):
    from ratingloom.sources import raw_text

    path = tmp_path / "wrong.csv"
    path.write_text("no record\n" * 50)
    monkeypatch.setattr(raw_text, "RECORD_BYTES", 100)
    with pytest.raises(ValueError, match="wrong.csv"):
        frame_records(scan_lines(spark, str(path)), header=False)


def test_size_profile_reads_raw_bytes(spark, tmp_path):
    from ratingloom.operators.reports import row_size_profile

    raw = b"h\r\nab\xff\r\n" + "c\u2028d\n".encode()
    (tmp_path / "f.csv").write_bytes(raw)
    row = row_size_profile(spark, str(tmp_path)).first()
    assert (row["lines"], row["bytes"]) == (2, len(raw))
    assert row["avg_line_bytes"] == (5 + 6) / 2 and row["est_rows"] == int(len(raw) / 5.5)


def test_ids_beyond_64_bits(spark):
    from ratingloom.operators.ids import reassign_duplicate_ids

    rows = spark.createDataFrame([(0, "9" * 20), (1, "5"), (2, "5")], "pos long, id string")
    found = [r["id"] for r in reassign_duplicate_ids(rows).orderBy("pos").collect()]
    assert found == ["9" * 20, "5", "1" + "0" * 20]


def test_an_id_without_end_does_not_end_the_run(spark):
    from ratingloom.operators.ids import reassign_duplicate_ids

    rows = spark.createDataFrame([(0, "9" * 50), (1, "5"), (2, "5"), (3, "9" * 50)], "pos long, id string")
    found = [r["id"] for r in reassign_duplicate_ids(rows).orderBy("pos").collect()]
    assert found == ["9" * 50, "5", "6", "7"]
