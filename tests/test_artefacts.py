"""Publication of saved models."""

import warnings

import pytest

from ratingloom.artefacts import ArtefactBroken, ArtefactMissing, load_or, publish, published


def version(spark, n):
    def write(folder):
        spark.range(n).coalesce(1).write.parquet(f"{folder}/a")
        spark.range(n + 1).coalesce(1).write.parquet(f"{folder}/b")

    return write


def sizes(spark, path):
    folder = published(path)
    return [spark.read.parquet(f"{folder}/{part}").count() for part in "ab"]


def test_last_version_is_loaded(spark, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(ArtefactMissing):
        published(path)
    for n in (3, 5, 4):
        publish(path, version(spark, n))
        assert sizes(spark, path) == [n, n + 1]


def test_run_that_dies_between_two_writes_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "model")
    publish(path, version(spark, 3))

    def dies(folder):
        spark.range(9).write.parquet(f"{folder}/a")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(path, dies)
    assert sizes(spark, path) == [3, 4]


@pytest.mark.parametrize("harm", ["lose", "change", "add"])
def test_harmed_files_are_noticed(spark, tmp_path, harm):
    path = tmp_path / "model"
    publish(str(path), version(spark, 3))
    part = next(path.glob("*/a/part-*.parquet"))
    if harm == "lose":
        part.unlink()
    elif harm == "change":
        part.write_bytes(next(path.glob("*/b/part-*.parquet")).read_bytes())
    else:
        (part.parent / "part-more.parquet").write_bytes(b"x")
    with pytest.raises(ArtefactBroken):
        published(str(path))


def test_only_absent_or_broken_models_are_fitted_anew(spark, tmp_path):
    path = str(tmp_path / "model")
    with pytest.warns(UserWarning, match="fitting anew"):
        assert load_or(lambda: published(path), lambda: "fitted") == "fitted"
    with pytest.raises(ArtefactMissing):
        load_or(lambda: published(path), lambda: "fitted", "error")
    with pytest.raises(ZeroDivisionError):
        load_or(lambda: 1 / 0, lambda: "fitted")
    publish(path, version(spark, 2))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert load_or(lambda: published(path), lambda: "fitted") != "fitted"
