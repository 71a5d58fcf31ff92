"""The jobs in a row, from raw text to predictions."""

from pyspark.sql import functions as F

from queries.views import view
from ratingloom.__main__ import main
from ratingloom.sources.schema_file import PREDICT, TRAIN


def test_raw_text_to_predictions(spark, small, tmp_path):
    at = {n: str(tmp_path / n) for n in (
        "train", "test", "prod", "clean", "tclean", "pclean", "models", "merged", "tmerged",
        "model", "out", "report")}
    rows = view(spark, small, "reviews").filter("l_orderkey % 4 = 0")
    record = F.concat_ws(",", *TRAIN.fields)
    rows.select(record).coalesce(1).write.text(at["train"])
    rows.select(F.concat_ws(",", *PREDICT.fields)).coalesce(1).write.text(at["test"])
    products = view(spark, small, "products").select(
        F.concat_ws(",", "id", "parent_prod_id", "main_category", "price", "title",
                    F.concat(F.lit('"'), "features", F.lit('"')), "store", "rating_number"))
    products.coalesce(1).write.text(at["prod"])

    main(["clean", "train", at["train"], at["clean"]], spark)
    main(["clean", "predict", at["test"], at["tclean"]], spark)
    main(["clean", "product", at["prod"], at["pclean"]], spark)
    main(["merge", at["clean"], at["pclean"], at["merged"], "--models", at["models"]], spark)
    main(["merge", at["tclean"], at["pclean"], at["tmerged"], "--models", at["models"], "--reuse"],
         spark)
    main(["train", at["merged"], at["model"], "--report", at["report"], "--epochs", "1"], spark)
    main(["score", at["tmerged"], at["model"], at["out"], "--report", at["report"]], spark)

    cleaned = spark.read.parquet(at["clean"])
    n = cleaned.count()
    assert n == rows.count() - 1  # the first line is a header, whatever it holds
    assert cleaned.select("id").distinct().count() == n
    predicted = spark.read.option("header", True).csv(at["out"] + "/predictions_float")
    assert predicted.count() == spark.read.parquet(at["tclean"]).count()
    sections = {r[0] for r in spark.read.parquet(at["report"]).select("section").distinct().collect()}
    assert sections == {"rating_distribution", "rating_statistics", "times", "validation", "epochs",
                        "prediction_analysis", "inference"}
