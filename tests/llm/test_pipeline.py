"""The pipeline's stages one by one, and its queries' SQL."""

import duckdb
import pytest

import corpus_pipeline
from ratingloom.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    expected = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in order)) for r in df.collect()) == expected


def test_all_queries():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    marks = {
        "quality": {r["doc_id"] for r in QUERIES["op1_line_field_quality"](spark, DATA).filter("predicted = 1").collect()},
        "exact_dedup": {r["doc_id"] for r in QUERIES["op5_cuckoo_dedup"](spark, DATA).filter("kept").collect()},
        "jaccard_join": {r["doc_id"] for r in QUERIES["op7_order_filtered_join"](spark, DATA).filter("doc_id = component_id").collect()},
        "decontamination": {r["doc_id"] for r in QUERIES["op3_benchmark_windows"](spark, DATA).filter("not contaminated").collect()},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.select("doc_id").collect()} == marks[name], name


def test_run_packs_what_is_left(spark):
    packed = corpus_pipeline.run(spark, DATA)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < packed.select("doc_id").distinct().count() < 1000
