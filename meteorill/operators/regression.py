"""Linear regression of monthly precipitation."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteorill.functions.metrics import rmse
from meteorill.operators.features import (
    REGRESSION_SCALARS,
    country_encoder,
    regression_features,
    regression_vector,
    row_bucket,
    with_split,
)

LABEL = "AvgPrcp"
COLUMNS = ["StationId", "FIPS_code", *REGRESSION_SCALARS, LABEL]

# The settings the final model uses, and the grid they are searched in.
SETTINGS = {"maxIter": 1, "regParam": 1.0, "elasticNetParam": 0.8}
GRID = {
    "maxIter": [1, 5, 10],
    "regParam": [0.1, 0.5, 1.0],
    "elasticNetParam": [0.0, 0.5, 0.8],
}


def linear_regression(**settings) -> LinearRegression:
    return LinearRegression(labelCol=LABEL, featuresCol="features", **settings)


def fit_features(weather: DataFrame, with_temperature: bool = True) -> PipelineModel:
    return regression_features(with_temperature).fit(weather)


def fit_linear(
    weather: DataFrame, with_temperature: bool = True, **settings
) -> tuple[PipelineModel, LinearRegressionModel]:
    """Fit the feature stages on all rows and the regression on the training rows."""
    features = fit_features(weather, with_temperature)
    train = features.transform(with_split(weather.select(COLUMNS))).filter("split = 'train'")
    # The normal-equation solver reads the training rows once: nothing to cache.
    return features, linear_regression(**{**SETTINGS, **settings}).fit(train)


def linear_predictions(weather: DataFrame, with_temperature: bool = True, **settings) -> DataFrame:
    """Predictions for train and test rows alike, told apart by `split`."""
    features, model = fit_linear(weather, with_temperature, **settings)
    return predict(weather, features, model)


def predict(weather: DataFrame, features: PipelineModel, model: LinearRegressionModel) -> DataFrame:
    """Predictions for every row; one that lacks a feature keeps its place with a null."""
    *encoder, assembler = features.stages
    rows = PipelineModel(encoder).transform(with_split(weather.select(COLUMNS)))
    rows = model.transform(assembler.copy().setHandleInvalid("keep").transform(rows))
    known = F.when(~F.isnan("prediction"), F.col("prediction")).alias("prediction")
    return rows.select("StationId", "Year", "Month", "FIPS_code", "split", F.col(LABEL).alias("label"), known)


def ablation(weather: DataFrame) -> DataFrame:
    """RMSE by country and split, with and without the temperature features.

    The country index is fitted once, the vectors of both models are cached together, and one
    aggregation evaluates both; its few rows come to the driver.
    """
    spark = weather.sparkSession
    variants = {"all": True, "no_temperature": False}
    rows = Pipeline(stages=country_encoder()).fit(weather).transform(with_split(weather.select(COLUMNS)))
    for name, with_temperature in variants.items():
        rows = regression_vector(with_temperature, f"features_{name}").transform(rows)
    rows = rows.select("split", "FIPS_code", LABEL, *[f"features_{n}" for n in variants])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        predicted = rows
        for name in variants:
            estimator = linear_regression(**SETTINGS).setFeaturesCol(f"features_{name}")
            model = estimator.fit(rows.filter("split = 'train'"))
            predicted = model.setPredictionCol(f"p_{name}").transform(predicted)
        errors = predicted.groupBy("split", "FIPS_code").agg(*[rmse(f"p_{n}", LABEL).alias(n) for n in variants]).collect()
    finally:
        rows.unpersist()
    data = [(name, r["split"], r["FIPS_code"], r[name]) for name in variants for r in errors]
    return spark.createDataFrame(data, "features string, split string, FIPS_code string, rmse double")


def with_fold(df: DataFrame, folds: int) -> DataFrame:
    return df.withColumn("fold", row_bucket(folds))


def cross_validate(
    weather: DataFrame,
    grid: dict[str, list] = GRID,
    folds: int = 3,
    parallelism: int = 8,
    keep_models: bool = False,
) -> DataFrame | tuple[DataFrame, list[list[LinearRegressionModel]]]:
    """Validation RMSE of every setting in every fold, and with `keep_models` the models by fold.

    The folds come from the row's key. The feature stages, which never see the label, are fitted
    once, on all rows, so that every fold knows every country. In each fold the settings are
    fitted side by side on the cached vectors, and all of them are evaluated in one pass over
    the validation rows. The result has settings x folds rows.
    """
    estimator = linear_regression()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), values)
    settings = builder.build()

    spark = weather.sparkSession
    features = fit_features(weather)
    rows = features.transform(with_fold(weather.select(COLUMNS), folds))
    rows = rows.select("fold", "features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    metrics, kept = [], []
    try:
        for fold in range(folds):
            train = rows.filter(F.col("fold") != fold)
            fit = inheritable_thread_target(spark)(partial(estimator.fit, train))
            with ThreadPoolExecutor(parallelism) as pool:
                models = list(pool.map(fit, settings))
            if keep_models:
                kept.append(models)
            validation = rows.filter(F.col("fold") == fold)
            for i, model in enumerate(models):
                validation = model.setPredictionCol(f"p{i}").transform(validation)
            errors = validation.agg(
                *[rmse(f"p{i}", LABEL).alias(f"rmse{i}") for i in range(len(models))]
            ).first()
            for setting, error in zip(settings, errors, strict=True):
                named = {param.name: value for param, value in setting.items()}
                metrics.append((*[float(named[name]) for name in grid], fold, error))
    finally:
        rows.unpersist()
    schema = ", ".join([*[f"{name} double" for name in grid], "fold int", "rmse double"])
    table = spark.createDataFrame(metrics, schema)
    return (table, kept) if keep_models else table


def average_metrics(metrics: DataFrame, parameters: Iterable[str] = tuple(GRID)) -> DataFrame:
    return metrics.groupBy(*parameters).agg(F.avg("rmse").alias("avg_rmse"))


def best_setting(metrics: DataFrame, parameters: Iterable[str] = tuple(GRID)) -> DataFrame:
    """The setting with the lowest average error; ties go to the smaller parameters."""
    return average_metrics(metrics, parameters).orderBy("avg_rmse", *parameters).limit(1)


def refit(
    weather: DataFrame, metrics: DataFrame, parameters: Iterable[str] = tuple(GRID)
) -> tuple[PipelineModel, LinearRegressionModel]:
    """The model of the best setting, fitted on all rows."""
    best = best_setting(metrics, parameters).first()
    setting = {name: best[name] for name in parameters}
    if "maxIter" in setting:
        setting["maxIter"] = int(setting["maxIter"])
    features = fit_features(weather)
    return features, linear_regression(**setting).fit(features.transform(weather.select(COLUMNS)))
