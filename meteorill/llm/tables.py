"""Reading the given tables, cutting lineage, and joins whose small side has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.plans.workspace import new_folder

#: White space that splits words: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """The same rows read from a new table in the shared folder: lineage ends there."""
    spark = spark or df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int, most: int) -> DataFrame:
    """`df`, to be broadcast if it has been counted to hold at most `most` rows, else shuffled."""
    return F.broadcast(df) if rows <= most else df.hint("merge")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where lambdas inside `body` use it."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
