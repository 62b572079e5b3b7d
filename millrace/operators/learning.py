"""Training, scoring and comparing models on one-row-per-person tables."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.ordering import range_running
from millrace.sources.staging import shared_dir


def assembled(df: DataFrame, label: str, leave_out: list[str]) -> tuple[DataFrame, list[str]]:
    columns = [c for c in df.columns if c != label and c not in leave_out]
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return vectors.select("features", F.col(label).cast("double").alias("label")), columns


def _boosted(rounds: int, depth: int, rate: float, seed: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=0.9, seed=seed,
    )


def train_boosted(
    df: DataFrame, label: str, leave_out: list[str],
    rounds: int = 300, depth: int = 6, rate: float = 0.1, seed: int = 42,
):
    """Boosted trees on everything but the label and the columns left out: (model, feature names)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        # Hundreds of rounds would otherwise grow one lineage from the first tree on.
        context.setCheckpointDir(shared_dir(df.sparkSession))
    vectors, columns = assembled(df, label, leave_out)
    return _boosted(rounds, depth, rate, seed).fit(vectors), columns


def score(model, columns: list[str], df: DataFrame) -> DataFrame:
    """Adds ``probability`` of the positive label."""
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return (
        model.transform(vectors).withColumn("_p", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "prediction", "probability")
        .withColumnRenamed("_p", "probability")
    )


def auc(df: DataFrame, label: str, score_column: str) -> DataFrame:
    """Exact area under the ROC curve from average ranks: (auc, positives, negatives).

    Rows are counted per distinct score first, so ties cost one row, and the ranks run over range
    pieces of the scores instead of one sorted partition. With one class only there is no area: null.
    """
    counted = df.groupBy(F.col(score_column).alias("_s")).agg(
        F.count("*").alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_pos")
    )
    ranked = range_running(counted, [], [F.col("_s")], {"_upto": ("sum", F.col("_n"))})
    average_rank = F.col("_upto") - (F.col("_n") - 1) / 2.0
    sums = ranked.agg(
        F.sum(F.col("_pos") * average_rank).alias("_ranks"), F.sum("_pos").alias("positives"),
        F.sum(F.col("_n") - F.col("_pos")).alias("negatives"),
    )
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return sums.select(F.try_divide(F.col("_ranks") - p * (p + 1) / 2, p * n).alias("auc"), "positives", "negatives")


def importances(spark: SparkSession, model, columns: list[str]) -> DataFrame:
    """(feature, importance); as many rows as the model has features."""
    rows = list(zip(columns, (float(v) for v in model.featureImportances.toArray())))
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(weights: DataFrame, n: int = 8) -> DataFrame:
    return weights.orderBy(F.round("importance", 9).desc(), "feature").limit(n)


def importance_spread(weights: DataFrame, noise_prefix: str) -> DataFrame:
    """Do planted noise columns stand apart? Smallest, largest and their distance per group."""
    return weights.groupBy(F.col("feature").startswith(noise_prefix).alias("is_noise")).agg(
        F.count("*").alias("features"), F.min("importance").alias("low"), F.max("importance").alias("high"),
        (F.max("importance") - F.min("importance")).alias("spread"),
    )


def model_versions(runs: DataFrame) -> DataFrame:
    """Registering a name again makes version 2, 3, ...; the run with the highest AUC is best.

    Versions are counted in range pieces of (model, run), so neither a model with most runs nor ids far apart matter.
    """
    numbered = range_running(runs, ["model"], [F.col("run_id")], {"version": ("sum", F.lit(1).cast("bigint"))})
    best = runs.groupBy("model").agg(F.min(F.struct((-F.col("auc")).alias("low"), F.col("run_id").alias("run")))["run"].alias("_best"))
    both = numbered.join(best.withColumnRenamed("model", "_of"), F.col("model").eqNullSafe(F.col("_of")))
    return both.withColumn("is_best", F.col("run_id") == F.col("_best")).drop("_best", "_of")


def leaderboard(runs: DataFrame) -> DataFrame:
    """Best AUC and number of runs per student, placed in range pieces: equal AUCs share a place."""
    best = runs.groupBy("student_id").agg(F.count("*").alias("runs"), F.max("auc").alias("auc"))
    equal = best.groupBy(F.col("auc").alias("_auc")).agg(F.count("*").alias("_n"))
    places = range_running(equal, [], [F.col("_auc").desc()], {"_upto": ("sum", F.col("_n"))})
    place = (F.col("_upto") - F.col("_n") + 1).alias("place")
    return best.join(places, F.col("auc").eqNullSafe(F.col("_auc"))).select("student_id", "runs", "auc", place)


def tune(
    df: DataFrame, label: str, leave_out: list[str], depths: list[int], rounds: list[int], rates: list[float],
    seed: int = 42,
) -> DataFrame:
    """One row per parameter set with its validation AUC."""
    vectors, _ = assembled(df, label, leave_out)
    trees = _boosted(rounds[0], depths[0], rates[0], seed)
    grid = (
        ParamGridBuilder().addGrid(trees.maxDepth, depths).addGrid(trees.maxIter, rounds)
        .addGrid(trees.stepSize, rates).build()
    )
    search = TrainValidationSplit(
        estimator=trees, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="label"),
        trainRatio=0.75, seed=seed,
    ).fit(vectors)
    rows = [
        (int(p[trees.maxDepth]), int(p[trees.maxIter]), float(p[trees.stepSize]), float(m))
        for p, m in zip(grid, search.validationMetrics)
    ]
    schema = T.StructType([
        T.StructField("depth", T.IntegerType()), T.StructField("rounds", T.IntegerType()),
        T.StructField("rate", T.DoubleType()), T.StructField("auc", T.DoubleType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema)
