"""Fare prediction with a random forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Label, features and forest settings.
LABEL, PREDICTION = "fare_amount", "predicted_fare_amount"
NUMERIC = ("passenger_count", "pickup_hour", "pickup_day", "avg_temp", "precipitation", "distance_km")
BOROUGH, BOROUGH_INDEX = "borough", "boroughIndex"
FEATURES = (*NUMERIC, BOROUGH_INDEX)
TREES, DEPTH, SEED = 100, 5, 42
GRID_TREES, GRID_DEPTHS, FOLDS = (100, 150, 200), (10, 15, 20), 3
MAX_CATEGORIES = 4
# A prime, so that neighbouring ids spread over the tenths.
SPLIT_PRIME = 7919


def split(df: DataFrame, key: str, tenths: int = 9) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key: the same rows whatever the partitions, unlike a random split."""
    slot = F.pmod(F.col(key).cast("bigint") * SPLIT_PRIME, F.lit(10))
    return df.where(slot < tenths), df.where(slot >= tenths)


def training_rows(df: DataFrame) -> DataFrame:
    """Rows with every feature and a label; the assembler takes no nulls."""
    return df.dropna(subset=[*NUMERIC, BOROUGH, LABEL])


def indexer(unseen: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=BOROUGH, outputCol=BOROUGH_INDEX, handleInvalid=unseen)


def assembler(output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol=output)


def forest(features: str = "features", trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=LABEL, featuresCol=features, predictionCol=PREDICTION, numTrees=trees, maxDepth=depth, seed=seed)


def fare_pipeline(unseen: str = "error", index_small: bool = False, **settings) -> Pipeline:
    """Borough index, feature vector, optional indexing of low-cardinality features, forest."""
    stages = [indexer(unseen), assembler()]
    features = "features"
    if index_small:
        stages.append(VectorIndexer(
            inputCol="features", outputCol="indexedFeatures", maxCategories=MAX_CATEGORIES, handleInvalid="keep"))
        features = "indexedFeatures"
    return Pipeline(stages=[*stages, forest(features, **settings)])


def tune(
    train: DataFrame, trees: Sequence[int] = GRID_TREES, depths: Sequence[int] = GRID_DEPTHS, folds: int = FOLDS,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Grid search by RMSE. Preparation is part of each fold, so no fold sees the others' boroughs."""
    pipeline = fare_pipeline("keep", index_small=True)
    model = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(model.numTrees, list(trees)).addGrid(model.maxDepth, list(depths)).build()
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator("rmse"), numFolds=folds, seed=SEED,
        parallelism=parallelism,
    ).fit(train)


def evaluator(metric: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName=metric)


def scores(predictions: DataFrame) -> DataFrame:
    """RMSE and R² as one aggregate."""
    y, p = F.col(LABEL), F.col(PREDICTION)
    squared = F.sum((y - p) * (y - p))
    return predictions.agg(
        F.count("*").alias("n"), F.sqrt(squared / F.count("*")).alias("rmse"),
        # var_pop times the count is the total sum of squares.
        (1 - squared / (F.var_pop(y) * F.count(y))).alias("r2"),
    )


def comparison(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        F.col(LABEL).alias("Actual_Fare"), F.round(PREDICTION, 2).alias("Predicted_Fare"),
        F.round(F.col(LABEL) - F.col(PREDICTION), 2).alias("Error"))


def describe(predictions: DataFrame) -> DataFrame:
    """Count, mean, deviation and range of label and prediction, a row each."""
    columns = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in (LABEL, PREDICTION)]))
    return predictions.select(columns.alias("c")).groupBy("c.column").agg(
        F.count("c.value").alias("count"), F.avg("c.value").alias("mean"), F.stddev("c.value").alias("stddev"),
        F.min("c.value").alias("min"), F.max("c.value").alias("max"))


def importances(model: PipelineModel) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    return SparkSession.active().createDataFrame(
        [(n, float(w)) for n, w in zip(FEATURES, weights)], "feature string, importance double")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score(path: str, df: DataFrame) -> DataFrame:
    """Predictions of a saved model."""
    return PipelineModel.load(path).transform(df)
