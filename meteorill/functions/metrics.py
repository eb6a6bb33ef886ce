"""Model quality as aggregate expressions, so that one pass serves any grouping."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(prediction: str = "prediction", label: str = "label") -> Column:
    error = F.col(prediction) - F.col(label)
    return F.sqrt(F.avg(error * error))


def accuracy(prediction: str = "prediction", label: str = "label") -> Column:
    return F.avg((F.col(prediction) == F.col(label)).cast("double"))


def error_rate(prediction: str = "prediction", label: str = "label") -> Column:
    return 1 - accuracy(prediction, label)
