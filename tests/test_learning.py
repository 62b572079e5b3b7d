"""AUC, importances, versions and tuning."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from millrace.operators import learning as L


def test_auc_equals_the_library_with_ties(spark):
    df = spark.range(500).select(
        (F.xxhash64("id") % 7 + F.when(F.col("id") % 3 == 0, 2).otherwise(0)).cast("double").alias("s"),
        (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = L.auc(df, "y", "s").first()
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(
        df.withColumn("y", F.col("y").cast("double")))
    assert got.auc == pytest.approx(want) and got.positives + got.negatives == 500


def test_training_finds_the_signal_and_not_the_noise(spark):
    df = spark.range(400).select(
        F.col("id").alias("subscriber_id"), (F.col("id") % 10).cast("double").alias("tenure"),
        (F.xxhash64("id") % 2).cast("int").alias("country_a"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    model, columns = L.train_boosted(df, "y", ["subscriber_id"], rounds=3, depth=2)
    assert columns == ["tenure", "country_a"]
    weights = L.importances(spark, model, columns)
    assert L.top_features(weights, 1).first().feature == "tenure"
    spread = {r.is_noise: r.high for r in L.importance_spread(weights, "country_").collect()}
    assert spread[False] > spread[True]
    assert L.auc(L.score(model, columns, df), "y", "probability").first().auc > 0.95


def test_versions(spark):
    runs = spark.createDataFrame([("m", 1, 0.7), ("m", 2, 0.9), ("m", 3, 0.9), ("x", 4, 0.1)], "model string, run_id bigint, auc double")
    got = {r.run_id: (r.version, r.is_best) for r in L.model_versions(runs).collect()}
    assert got == {1: (1, False), 2: (2, True), 3: (3, False), 4: (1, True)}


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.7)], "y int, p double")
    assert L.auc(df, "y", "p").first().auc is None


def test_leaderboard_ties_and_missing(spark):
    runs = spark.createDataFrame([(1, 0.9), (2, 0.9), (3, 0.5), (3, 0.8), (4, None)], "student_id int, auc double")
    got = {r.student_id: (r.runs, r.auc, r.place) for r in L.leaderboard(runs).collect()}
    assert got == {1: (1, 0.9, 1), 2: (1, 0.9, 1), 3: (2, 0.8, 3), 4: (1, None, 4)}


@pytest.mark.parametrize("name", ["ml_train_churn", "ml_importance"])
def test_registered_queries_fit_all_rounds(spark, sf, monkeypatch, name):
    from millrace.plans import QUERIES

    asked = []

    class Stop(Exception):
        pass

    def boosted(rounds, depth, rate, seed):
        asked.append((rounds, depth, rate))
        raise Stop

    monkeypatch.setattr(L, "_boosted", boosted)
    with pytest.raises(Stop):
        QUERIES[name](spark, sf)
    assert asked == [(300, 6, 0.1)]
