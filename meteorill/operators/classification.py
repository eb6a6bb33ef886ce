"""Random forests for month and season, one for each country."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteorill.operators.features import location_features, with_season, with_split
from meteorill.schemas import COORDINATES, COUNTRIES

COLUMNS = [
    "StationId", "FIPS_code", "Year", "Month", "AvgPrcp", "AvgTmin", "AvgTmax", *COORDINATES,
]


def forest_pipeline(
    label: str, labels: list[str], include_label: bool, trees: int, seed: int
) -> Pipeline:
    index = StringIndexerModel.from_labels(labels, inputCol=label, outputCol="indexedLabel")
    return Pipeline(
        stages=[
            index,
            *location_features(more=[label] if include_label else []),
            # "keep" gives a value that the training rows lack a place of its own.
            VectorIndexer(
                inputCol="features",
                outputCol="indexedFeatures",
                maxCategories=4,
                handleInvalid="keep",
            ),
            RandomForestClassifier(
                labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=trees, seed=seed
            ),
            IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=labels),
        ]
    )


def label_lists(rows: DataFrame, label: str) -> dict[str, list[str]]:
    """Labels of each country that has usable training rows, most frequent first.

    One small aggregation for all countries: at most a dozen labels each.
    """
    usable = F.lit(True)
    for column in COORDINATES:
        usable = usable & F.col(column).isNotNull()
    counts = (
        rows.groupBy("FIPS_code", F.col(label).cast("string").alias("name"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(usable & (F.col("split") == "train"), 1)).alias("n_train"),
        )
        .filter(F.col("name").isNotNull())
        .collect()
    )
    lists: dict[str, list[str]] = {}
    trainable = {row.FIPS_code for row in counts if row.n_train > 0}
    for row in sorted(counts, key=lambda r: (-r.n, r.name)):
        if row.FIPS_code in trainable:
            lists.setdefault(row.FIPS_code, []).append(row.name)
    return lists


def labelled_rows(weather: DataFrame, label: str, codes: Iterable[str]) -> DataFrame:
    rows = weather.select(COLUMNS).filter(F.col("FIPS_code").isin(list(codes)))
    return with_split(with_season(rows) if label == "Season" else rows)


def fit_forests(
    rows: DataFrame,
    label: str,
    include_label: bool = False,
    trees: int = 10,
    seed: int = 7,
    parallelism: int = 5,
) -> dict[str, PipelineModel]:
    """One model for each country with training rows, fitted a few at a time."""
    lists = label_lists(rows, label)

    def fit(code: str) -> PipelineModel:
        train = rows.filter((F.col("FIPS_code") == code) & (F.col("split") == "train"))
        return forest_pipeline(label, lists[code], include_label, trees, seed).fit(train)

    codes = sorted(lists)
    with ThreadPoolExecutor(parallelism) as pool:
        models = pool.map(inheritable_thread_target(rows.sparkSession)(fit), codes)
        return dict(zip(codes, models, strict=True))


def forest_predictions(
    weather: DataFrame,
    label: str = "Month",
    codes: Iterable[str] = tuple(COUNTRIES),
    include_label: bool = False,
    with_features: bool = False,
    **options,
) -> DataFrame:
    """Predictions for the test rows of every country, with the feature vectors if asked for.

    A row that lacks a coordinate has no vector and a null prediction. The label is not among the features unless `include_label` asks for it. A country without
    training rows has no predictions.
    """
    rows = labelled_rows(weather, label, codes)
    models = fit_forests(rows, label, include_label, **options)
    test = rows.filter("split = 'test'")
    keys = ["StationId", "Year", "Month", "FIPS_code", F.col(label).cast("string").alias("label")]
    nothing = [F.lit(None).cast("string").alias("prediction")]
    found = [F.col("predictedLabel").alias("prediction")]
    if with_features:
        nothing.append(F.lit(None).cast("array<double>").alias("features"))
        found.append(vector_to_array("features").alias("features"))
    incomplete = F.lit(False)
    for column in COORDINATES:
        incomplete = incomplete | F.col(column).isNull()
    parts = [test.filter(incomplete & F.col("FIPS_code").isin(list(models))).select(*keys, *nothing)]
    for code, model in models.items():
        parts.append(model.transform(test.filter(F.col("FIPS_code") == code)).select(*keys, *found))
    return reduce(DataFrame.unionByName, parts)
