"""Regressors, training and scoring runs."""

from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from queries import models as query_models
from queries.joining import products, reviews
from ratingloom.operators import mlp
from ratingloom.operators.mlp import Shape, TrainConfig, backward, forward, pack
from ratingloom.operators.regress import (
    epoch_table,
    evaluate,
    fit_regressor,
    load_regressor,
    save_regressor,
    score_ratings,
    whole_ratings,
)
from ratingloom.plans.merging import TextModels, merge_with_embeddings
from ratingloom.plans.scoring import run_scoring, score_reviews
from ratingloom.plans.training import RatingModel, train_ratings
from ratingloom.sinks.tables import report_lines, write_merged

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(6000).select(
        F.col("id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) * 1e9).alias("b"),
        F.lit(7.0).alias("c"),
    )
    label = F.lit(1) + F.col("a") / 5 + (F.col("b") > 5e11).cast("double") * 1.5
    df = df.withColumn("label", label)
    return df.filter("id % 5 > 0"), df.filter("id % 5 = 0")


def constant_rmse(rows):
    return rows.agg(F.stddev_pop("label")).first()[0]


@pytest.mark.parametrize("norm", ["layer", "batch"])
def test_mlp_learns_and_survives_saving(planted, tmp_path, norm):
    train, val = planted
    cfg = TrainConfig(epochs=12, hidden=(32, 16), batch_size=64, lr=3e-3, norm=norm, dropout=0.05)
    model = fit_regressor(train, val, FEATURES, algo="mlp", config=cfg)
    found = evaluate(val, model).first()
    assert found["rows"] == 1200 and found["rmse"] < 0.5 * constant_rmse(val)
    save_regressor(model, str(tmp_path / "m"))
    again = load_regressor(str(tmp_path / "m"))
    assert again.features == FEATURES and again.shape == model.shape
    a = {r["id"]: r["prediction"] for r in model.score(val).collect()}
    assert a == {r["id"]: r["prediction"] for r in again.score(val).collect()}
    assert min(e["val_mse"] for e in model.epochs) == pytest.approx(found["mse"], rel=1e-3)
    with pytest.raises(ValueError, match="missing"):
        again.score(val.drop("a"))


def test_early_stop_and_epoch_table(spark, planted):
    train, val = planted
    flat = train.withColumn("label", F.lit(3.0)), val.withColumn("label", F.col("a") * 0 - 50.0)
    cfg = TrainConfig(epochs=20, hidden=(4,), early_stopping_patience=2, lr=1e-2)
    model = fit_regressor(*flat, FEATURES, config=cfg)
    table = epoch_table(spark, model)
    assert 3 <= table.count() == len(model.epochs) < 20
    assert {"train_rmse", "val_mae", "epoch_time_s"} < set(table.columns)


@pytest.mark.parametrize("norm", ["layer", "batch"])
def test_gradients(norm):
    shape = Shape(3, (5, 4), norm, dropout=0.0)
    params = [p.astype(np.float64) for p in shape.start(1)]
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(8, 3)), rng.normal(size=8)

    def loss():
        return float(np.mean((forward(shape, params, x, rng)[0] - y) ** 2))

    predicted, tape = forward(shape, params, x, rng)
    grads = backward(shape, params, tape, predicted - y)
    for p, g in zip(params, grads):
        if not g.any():
            continue
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = p[at], 1e-3
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=1e-4)
    assert shape.unpack(pack(params))[0].shape == (3, 5)


@pytest.mark.parametrize("algo, params", [
    ("linear", {}), ("gbt", {"maxIter": 8, "validate": True}), ("forest", {"numTrees": 10, "featureSubsetStrategy": "all"}),
])
def test_table_models(planted, tmp_path, algo, params):
    train, val = planted
    model = fit_regressor(train, val, FEATURES, algo=algo, **params)
    assert evaluate(val, model).first()["rmse"] < 0.7 * constant_rmse(val)
    save_regressor(model, str(tmp_path / "m"))
    scored = score_ratings(val, load_regressor(str(tmp_path / "m")))
    assert scored.columns == ["id", "rating"]
    low, high = scored.agg(F.min("rating"), F.max("rating")).first()
    assert low >= 1.0 and high <= 5.0
    assert set(r[0] for r in whole_ratings(scored).select("rating").distinct().collect()) <= {1, 2, 3, 4, 5}


def test_training_and_scoring_run(spark, small, tmp_path):
    merged, models = merge_with_embeddings(reviews(spark, small), products(spark, small))
    models.save(str(tmp_path / "text"))
    write_merged(merged, str(tmp_path / "merged"))
    rows = spark.read.parquet(str(tmp_path / "merged"))
    texts = ("comment", "title", "prod_title", "prod_features")
    assert all(f"{t}_emb_0" in rows.columns for t in texts) and "comment" not in rows.columns
    report_path = str(tmp_path / "report")
    run = train_ratings(
        rows, config=TrainConfig(epochs=2, hidden=(16,)), report_path=report_path
    )
    assert run.train.count() == 4800 and run.val.count() == 1200
    assert run.model.regressor.features[:7] == (
        "votes", "purchased", "time", "prod_price", "prod_rating_number", "prod_main_category",
        "prod_store",
    )
    assert run.model.regressor.features[7].startswith("comment_emb_")
    run.model.save(str(tmp_path / "model"))

    fresh, _ = merge_with_embeddings(
        reviews(spark, small).drop("rating"), products(spark, small),
        TextModels.load(str(tmp_path / "text")),
    )
    assert "rating" not in fresh.columns
    model = RatingModel.load(str(tmp_path / "model"))
    for _ in range(2):
        scored = run_scoring(fresh, model, str(tmp_path / "out"), report_path)
    assert scored.count() == 6000
    ints = spark.read.option("header", True).csv(str(tmp_path / "out/predictions_int"))
    assert ints.columns == ["id", "rating"] and ints.count() == 6000
    assert ints.filter(~F.col("rating").isin("1", "2", "3", "4", "5")).count() == 0
    report = spark.read.parquet(report_path)
    sections = {r["section"]: r["n"] for r in report.groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert sections["epochs"] == 2 * 7 and sections["prediction_analysis"] == 3 + 10
    assert sections["inference"] == 3 and sections["rating_distribution"] == 10
    assert report_lines(report).filter("line like 'rows[5]: %'").count() == 2
    unnumbered = score_reviews(fresh.drop("id"), model)
    assert unnumbered.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (0, 5999, 6000)
    with pytest.raises(ValueError, match="embedding"):
        score_reviews(fresh.drop(*[c for c in fresh.columns if c.startswith("title_emb")]), model)


def test_training_refuses_bad_ratings(spark):
    schema = "id string, votes string, purchased string, time string, rating string"
    df = spark.createDataFrame([("1", "1", "TRUE", "1", "5"), ("2", "1", "TRUE", "1", "x")], schema)
    with pytest.raises(ValueError, match="1 rows"):
        train_ratings(df, texts=())
    with pytest.raises(ValueError, match="Empty"):
        train_ratings(df.limit(0), texts=())
    with pytest.raises(ValueError, match="embedding"):
        train_ratings(df)
    with pytest.raises(ValueError, match="no 'rating' column"):
        train_ratings(df.drop("rating"), texts=())


def test_rows_reach_the_network_as_arrow_matrices():
    """Also slices of batches, and no row as an object of its own."""
    x = pa.array([[float(i), float(-i)] for i in range(10)], pa.list_(pa.float32()))
    whole = mlp._matrix(x)
    assert whole.dtype == np.float32 and whole.shape == (10, 2)
    np.testing.assert_array_equal(mlp._matrix(x.slice(3, 4)), whole[3:7])
    batch = pa.RecordBatch.from_arrays([x, pa.array(np.arange(10, dtype=np.float32))], ["x", "y"])
    parts = [batch.slice(0, 0), batch.slice(0, 6), batch.slice(6)]
    found = [(a[:n], b[:n]) for a, b, n in mlp._mixed_windows(iter(parts), np.random.default_rng(0), 4)]
    assert sorted(float(v) for _, b in found for v in b) == list(range(10))
    assert all((a[:, 0] == b).all() and (a[:, 1] == -b).all() for a, b in found)


def test_scoring_reads_the_features_that_training_wrote(spark, monkeypatch):
    """The merged reviews are looked up once, not once more for the scores."""
    made = []
    rows = spark.range(300).select(
        "id", *[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(query_models._SCALARS)],
        (1 + F.col("id") % 5).cast("double").alias("label"),
    )
    monkeypatch.setattr(query_models, "scalar_features", lambda *_: made.append(1) or rows)
    fit = query_models.fit_regressor
    short = mlp.TrainConfig(epochs=1)
    monkeypatch.setattr(query_models, "fit_regressor", lambda *a, **k: fit(*a, **k, config=short))
    assert query_models.score_saved(spark, "none").count() == 300 and made == [1]


def test_packed_rows_are_the_same_rows(monkeypatch):
    """In blocks bounded by their bytes; an absent label stays absent."""
    monkeypatch.setattr(mlp, "_BLOCK_BYTES", 32)  # four rows of two features
    x = pa.array([[float(i), float(-i)] for i in range(10)], pa.list_(pa.float32()))
    y = pa.array([None, *map(float, range(1, 10))], pa.float32())
    whole = pa.RecordBatch.from_arrays([x, y], ["x", "y"])
    packed = list(mlp._packed(iter([whole.slice(0, 7), whole.slice(7), whole.slice(0, 0)])))
    assert [p.num_rows for p in packed] == [2, 1]
    found = list(mlp._unpacked(iter(packed)))
    np.testing.assert_array_equal(np.concatenate([mlp._matrix(b["x"]) for b in found]), mlp._matrix(x))
    np.testing.assert_array_equal(np.concatenate([b["y"].to_numpy() for b in found]), [np.nan, *range(1, 10)])


@pytest.mark.parametrize("norm", ["layer", "batch"])
def test_passes_equal_the_plain_formula(norm):
    """Also for inputs far out, and whatever the number of rows that go through at once."""
    shape, rng = Shape(3, (5, 4), norm, dropout=0.0), np.random.default_rng(0)
    params = [p.astype(np.float64) + rng.normal(size=p.shape) ** 2 for p in shape.start(1)]
    rows = rng.normal(size=(1500, 3)) * 1e3
    x = rows
    for i in range(2):
        w, b, gain, shift, mean, var = params[6 * i : 6 * i + 6]
        z = x @ w + b
        if norm == "layer":
            mean, var = z.mean(1, keepdims=True), z.var(1, keepdims=True)
        y = gain * (z - mean) / np.sqrt(var + 1e-5) + shift
        x = y / (1 + np.exp(-y)) if norm == "layer" else np.maximum(y, 0)
    plain = (x @ params[-2] + params[-1])[:, 0]
    np.testing.assert_allclose(mlp._scored(shape, params, rows), plain, rtol=1e-9)


def test_dropout_draws_16_bits_a_place():
    """The share and the mean are kept, and what the numbers are."""
    drawn, rng = [], mock.Mock()
    rng.bit_generator.random_raw = lambda n: drawn.append(n) or np.random.default_rng(0).bit_generator.random_raw(n)
    keep = mlp._dropout(rng, 0.1, (99, 1001), np.dtype(np.float32))
    assert sum(drawn) <= 99 * 1001 / 4 + 1
    assert keep.dtype == np.float32 and keep.shape == (99, 1001) and len(np.unique(keep)) == 2
    assert abs((keep == 0).mean() - 0.1) < 0.005 and abs(keep.mean() - 1) < 0.005


def test_sides_are_hashed_once_for_all_passes(spark, small):
    rows = query_models._ordered(spark, small)
    train, val = query_models._sides(rows)
    assert train.count() == int(0.8 * rows.count()) and train.count() + val.count() == rows.count()
    for side in (train, val):
        assert "md5" not in side._jdf.queryExecution().optimizedPlan().toString()


def test_train_and_score_merges_numbers_alone(spark, small, monkeypatch):
    """No text of a review or product is cut, sorted or read by a run that trains on none."""
    monkeypatch.setattr(query_models, "train_ratings", lambda rows, **_: mock.Mock(model=None))
    monkeypatch.setattr(query_models, "score_reviews", lambda rows, model: rows)
    rows = query_models.train_and_score(spark, small)
    assert rows.count() == 6000
    assert rows.columns == [
        "id", "votes", "purchased", "time", "rating", "prod_price", "prod_rating_number", "prod_main_category",
        "prod_store",
    ]
