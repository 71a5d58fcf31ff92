"""Encoding, compression and expansion of text columns."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ratingloom.operators.embed import (
    Compressor,
    distinct_texts,
    encode_text,
    encode_with_model,
    expand_embedding,
    fit_compressor,
    fit_encoder,
    load_or_fit,
    random_directions,
    weighted_moments,
)
from ratingloom.operators.features import embedding_columns, feature_columns, require_embeddings
from ratingloom.plans import merging


@pytest.fixture(scope="module")
def vectors(spark, small):
    return spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding")


@pytest.fixture(scope="module")
def matrix(vectors):
    rows = sorted(vectors.collect(), key=lambda r: r["vec_id"])
    return np.asarray([r["embedding"] for r in rows], dtype=float)


def applied(model, vectors):
    rows = sorted(model.apply(vectors).collect(), key=lambda r: r["vec_id"])
    return np.asarray([r["embedding"] for r in rows])


def test_pca_equals_svd(vectors, matrix, tmp_path):
    model = fit_compressor(vectors, "embedding", k=32)
    centred = matrix - matrix.mean(0)
    directions = np.linalg.svd(centred, full_matrices=False)[2][:32]
    lead = directions[np.arange(32), np.abs(directions).argmax(1)]
    expected = centred @ (directions * np.sign(lead)[:, None]).T
    found = applied(model, vectors)
    assert found.shape == (len(matrix), 32)
    np.testing.assert_allclose(found, expected, atol=1e-9)
    np.testing.assert_allclose(found.mean(0), 0, atol=1e-9)
    model.save(str(tmp_path / "c"))
    np.testing.assert_allclose(applied(Compressor.load(str(tmp_path / "c")), vectors), found)


def test_weighted_rows_stand_for_repeated_ones(spark, vectors, matrix):
    counts = [1 + i % 4 for i in range(len(matrix))]
    rows = [(i, m.tolist(), c) for i, (m, c) in enumerate(zip(matrix, counts))]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<double>, weight long").repartition(5)
    model = fit_compressor(once, "embedding", k=6, weight="weight")
    repeated = np.repeat(matrix, counts, axis=0)
    n, mean, covariance = weighted_moments(once, "embedding", "weight")
    assert n == len(repeated)
    np.testing.assert_allclose(mean, repeated.mean(0), atol=1e-12)
    np.testing.assert_allclose(covariance, np.cov(repeated.T), atol=1e-12)
    plain = fit_compressor(spark.createDataFrame([(m.tolist(),) for m in repeated], "embedding array<double>"), "embedding", k=6)
    np.testing.assert_allclose(applied(model, vectors), applied(plain, vectors), atol=1e-7)
    two = once.limit(1).selectExpr("vec_id", "embedding", "2L as weight")
    assert fit_compressor(two, "embedding", k=6, weight="weight").dim == 2


def test_each_distinct_text_is_encoded_once(spark):
    texts = ["red shoe", "red hat", "", None, "blue shoe shoe"]
    rows = spark.createDataFrame([(texts[i % 5 if i % 3 else 0],) for i in range(60)], "t string")
    distinct = distinct_texts(rows, "t")
    assert distinct.count() == 4 and distinct.agg({"weight": "sum"}).first()[0] == 60
    plain = fit_encoder(rows, "t", dim=64)
    weighted = fit_encoder(distinct, "t", dim=64, weight="weight")
    found = [
        {r["t"]: r["t_vec"].toArray() for r in encode_text(rows, e, "t").distinct().collect()} for e in (plain, weighted)
    ]
    assert set(found[0]) == set(found[1])
    for t, v in found[0].items():
        np.testing.assert_allclose(found[1][t], v, atol=1e-12)


def test_random_directions(vectors, matrix, tmp_path):
    model = fit_compressor(vectors, "embedding", k=8, method="random", seed=3)
    expected = (matrix - matrix.mean(0)) @ random_directions(64, 8, 3)
    np.testing.assert_allclose(applied(model, vectors), expected, atol=1e-9)
    model.save(str(tmp_path / "r"))
    again = load_or_fit(str(tmp_path / "r"), vectors, "embedding")
    np.testing.assert_allclose(applied(again, vectors), expected, atol=1e-9)


def test_few_rows_clamp_the_width_and_missing_models(vectors, tmp_path):
    few = vectors.orderBy("vec_id").limit(5)
    assert fit_compressor(few, "embedding", k=32).dim == 5
    assert load_or_fit(str(tmp_path / "none"), few, "embedding").dim == 5
    with pytest.raises(Exception, match="."):
        load_or_fit(str(tmp_path / "none"), few, "embedding", on_missing="error")


def test_encoder(spark):
    df = spark.createDataFrame(
        [(1, "good Good product"), (2, "bad product"), (3, None), (4, "good GOOD, product!")],
        "id int, t string",
    )
    encoded = encode_text(df, fit_encoder(df, "t", dim=64), "t")
    rows = {r["id"]: np.asarray(r["v"]) for r in
            encoded.select("id", vector_to_array("t_vec").alias("v")).collect()}
    assert np.linalg.norm(rows[1]) == pytest.approx(1) and not rows[3].any()
    np.testing.assert_allclose(rows[1], rows[4])
    assert rows[1] @ rows[2] < 0.99


def test_own_sentence_model(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else "x" * i) for i in range(50)], "i int, t string")

    def load():
        return lambda texts: np.asarray([[len(t), 1.0] for t in texts])

    found = encode_with_model(df, "t", load, batch=7).select("i", vector_to_array("t_vec").alias("v"))
    assert {r["i"]: r["v"] for r in found.collect()} == {
        i: [0.0 if i % 5 == 0 else float(i), 1.0] for i in range(50)
    }


def test_expansion_and_column_order(spark):
    df = spark.createDataFrame([(1, [0.12345649, -2.0])], "id int, v array<double>")
    assert expand_embedding(df, "v", "title", 2).first().asDict() == {
        "id": 1, "title_emb_0": 0.123456, "title_emb_1": -2.0,
    }
    names = [f"title_emb_{i}" for i in (10, 2, 1)] + ["comment_emb_0", "prod_price", "id", "x_emb_y"]
    assert embedding_columns(names) == ["comment_emb_0", "title_emb_1", "title_emb_2", "title_emb_10"]
    assert feature_columns(names)[:4] == ["votes", "purchased", "time", "prod_price"]
    with pytest.raises(ValueError, match="prod_title"):
        require_embeddings(names)


def test_rounding_is_that_of_decimal_text(spark):
    """Ties, halves that doubles miss, signs of zero and what has no millionths."""
    values = [0.0000005, 0.0000015, -0.0000005, 1.0000005, 0.1234565, 2.5e-7, -1e-9, 123456.7890125, 4e12, 1e300]
    values += [float("nan"), float("inf"), -float("inf"), None, *np.random.RandomState(3).randn(2000).tolist()]
    rows = spark.createDataFrame([([v], v) for v in values], "v array<double>, x double")
    done = expand_embedding(rows, "v", "t", 1).withColumn("want", F.bround("x", 6))
    bits = [F.hex(F.col(c).cast("string").cast("binary")) for c in ("t_emb_0", "want")]
    assert done.filter(~bits[0].eqNullSafe(bits[1])).count() == 0


def test_shared_review_texts_are_encoded_once(spark, monkeypatch):
    """Texts of reviews that repeat are looked up as those of products are; others are not."""
    few = spark.range(400).select(F.concat(F.lit("word "), (F.col("id") % 3).cast("string")).alias("title"))
    assert merging.repeated_texts(few, ["title", "prod_title"]) == {"title", "prod_title"}
    many = spark.range(400_000).select(F.col("id").cast("string").alias("title"))
    assert merging.repeated_texts(many, ["title"]) == set()
    encoded = []
    encode = merging.encode_text
    monkeypatch.setattr(merging, "encode_text", lambda df, *rest: encoded.append(df.count()) or encode(df, *rest))
    models = merging.fit_text_models(few, ["title"], k=2, dim=16)
    shared = models.apply(few, keep_text=True)
    assert encoded == [3, 3]
    monkeypatch.setattr(merging, "repeated_texts", lambda *_: set())
    alone = models.apply(few, keep_text=True).select(shared.columns)
    assert shared.exceptAll(alone).count() == alone.exceptAll(shared).count() == 0
