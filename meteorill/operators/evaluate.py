"""Errors of predictions, in one aggregation for all groups."""

from pyspark.sql import DataFrame

from meteorill.functions.metrics import accuracy, error_rate, rmse


def rmse_by(predictions: DataFrame, *keys: str) -> DataFrame:
    """RMSE of `prediction` against `label`, overall or for each group."""
    return predictions.groupBy(*keys).agg(rmse().alias("rmse"))


def rmse_train_test(predictions: DataFrame) -> DataFrame:
    """RMSE of each country, train beside test."""
    return predictions.groupBy("FIPS_code").pivot("split", ["train", "test"]).agg(rmse())


def error_by_country(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("FIPS_code").agg(
        accuracy().alias("accuracy"), error_rate().alias("test_error")
    )
