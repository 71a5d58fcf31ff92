"""Raw review files that queries write for themselves."""

import gzip
from pathlib import Path
from urllib.parse import urlparse

from __spark_entry__ import queries
from queries import cleaning
from queries.views import LINE_ORDER, view

DATA = "/root/testdata/sf0.001"


def test_raw_files_are_packed_short_and_in_line_order(spark, monkeypatch):
    whole = sorted(map(tuple, queries()["raw_train_clean"](spark, DATA).collect()))
    monkeypatch.setattr(cleaning, "_FILE_RECORDS", 500)
    folder = Path(urlparse(cleaning._raw_file(spark, DATA)).path)
    texts = [gzip.decompress(p.read_bytes()).decode() for p in sorted(folder.glob("part-*.gz"))]
    rows = [r["record"] for r in view(spark, DATA, "records").orderBy(*LINE_ORDER).select("record").collect()]
    assert len(texts) >= len(rows) / 500
    assert "".join(texts) == "".join(r + "\n" for r in rows)
    assert sorted(map(tuple, queries()["raw_train_clean"](spark, DATA).collect())) == whole


def test_texts_are_made_behind_the_sort(spark):
    rows = cleaning.sorted_view(spark, DATA, "records").select("record")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "RepartitionByExpression" in line]
    assert len(sorts) == 1
    below = plan[plan.index(sorts[0]) :]
    assert "concat(" not in below and "lpad(" not in below
