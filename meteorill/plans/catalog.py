"""Every query by name: a function of a session and the folder of the given tables.

Each reads whole tables. Queries over the published weather table write it first, to a new
folder of the workspace, and read it from there, as a user of that table would.
"""

from collections.abc import Callable
from itertools import product

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.functions.codes import fips_code, season_name
from meteorill.functions.dates import month_of, year_of
from meteorill.operators import classification, distinct, evaluate, features, gram, monthly, profile, regression, series, splits
from meteorill.operators.observations import clean, parse_observations
from meteorill.operators.preview import preview
from meteorill.operators.stations import (
    enrich,
    weather_from_bits,
    weather_from_daily,
    weather_from_monthly,
    weather_from_partials,
    weather_from_sketches,
)
from meteorill.plans import fixtures as fx
from meteorill.plans.workspace import new_folder
from meteorill.schemas import COUNTRIES, RAW_RECORD, SEASON_NAMES, STATION_HISTORY
from meteorill.sources import snapshots, tables, text
from meteorill.sources.stream import admitted, observation_stream
from meteorill.streaming.ingest import batch_partials, start_daily_ingest, start_distinct_ingest, start_ingest
from meteorill.streaming.monthly_state import start_monthly_state
from meteorill.streaming.progress import ProgressLog, follow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# Weather tables that were published for several queries, by session and input.
_published: dict[tuple[str, str], str] = {}


def publish(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark)
    tables.write_weather(fx.weather(spark, sf_dir), path)
    return path


def publish_once(spark: SparkSession, sf_dir: str) -> None:
    """Let this session's queries read one published table instead of publishing each for itself."""
    _published[spark.sparkContext.applicationId, sf_dir] = publish(spark, sf_dir)


def published_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _published.get((spark.sparkContext.applicationId, sf_dir)) or publish(spark, sf_dir)
    return tables.read_weather(spark, path)


# Sources and sinks


@query
def station_fixed_width(spark, sf_dir):
    path = new_folder(spark)
    fx.station_lines(spark, sf_dir).write.text(path)
    return text.read_stations(spark, path)


@query
def inventory_scan(spark, sf_dir):
    path = new_folder(spark)
    fx.inventory_lines(spark, sf_dir).write.text(path)
    return text.read_inventory(spark, path)


@query
def partials_table(spark, sf_dir):
    """Write the partials of four batches twice; the second time replaces the first."""
    path = new_folder(spark)
    partials = enrich(monthly.monthly_partials(fx.batched_obs(spark, sf_dir)), fx.stations(spark, sf_dir))
    partials = partials.withColumn("stream", F.lit("main"))
    tables.write_partials(partials, path)
    tables.write_partials(partials, path)
    return tables.read_partials(spark, path)


@query
def weather_table(spark, sf_dir):
    return tables.read_weather(spark, publish(spark, sf_dir))


# Parsing and cleaning


@query
def json_observations(spark, sf_dir):
    return parse_observations(fx.records(fx.obs(spark, sf_dir)))


@query
def clean_observations(spark, sf_dir):
    return fx.clean_obs(spark, sf_dir).select("StationId", "Date", "Variable", "Value")


@query
def date_parts(spark, sf_dir):
    return fx.obs(spark, sf_dir).select("Date", year_of().alias("Year"), month_of().alias("Month"))


@query
def fips_code_query(spark, sf_dir):
    return fx.obs(spark, sf_dir).select("StationId", fips_code().alias("FIPS_code"))


# Monthly sums and averages


@query
def daily_pivot(spark, sf_dir):
    return monthly.daily_pivot(fx.clean_obs(spark, sf_dir))


@query
def pivot_missing_variable(spark, sf_dir):
    """The minimum temperature never occurs, and its columns are there all the same."""
    without = clean(fx.obs(spark, sf_dir), fx.FLOOR, ("TMAX", "PRCP"))
    return monthly.monthly_partials(without)


@query
def monthly_partials(spark, sf_dir):
    return monthly.monthly_partials(fx.clean_obs(spark, sf_dir))


@query
def partials_sample(spark, sf_dir):
    return preview(monthly_partials(spark, sf_dir), "StationId", "Year", "Month")


@query
def monthly_partials_by_batch(spark, sf_dir):
    return monthly.monthly_partials(fx.batched_obs(spark, sf_dir))


@query
def merge_partials(spark, sf_dir):
    return monthly.merge_partials(monthly.monthly_partials(fx.batched_obs(spark, sf_dir)))


@query
def enrich_stations(spark, sf_dir):
    """Enriched partials of a single batch, as a micro-batch makes them."""
    return batch_partials(fx.clean_obs(spark, sf_dir), 0, fx.stations(spark, sf_dir))


@query
def exact_distinct_values(spark, sf_dir):
    return monthly.monthly_partials(fx.clean_obs(spark, sf_dir), "distinct")


def _estimates(spark, sf_dir) -> DataFrame:
    return monthly.monthly_partials(fx.clean_obs(spark, sf_dir), "approx_distinct")


@query
def approx_distinct_values(spark, sf_dir):
    """Sums, and whether each estimate is near the exact number of distinct values."""
    exact = monthly.monthly_partials(fx.clean_obs(spark, sf_dir), "distinct")
    keys = ["StationId", "Month", "Year"]
    named = exact.select(*keys, *[F.col(c).alias(f"exact_{c}") for c in monthly.COUNTS])
    near = [
        (F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.greatest(F.lit(1.0), F.col(f"exact_{c}") * 0.15)).cast("int").alias(f"near_{c}")
        for c in monthly.COUNTS
    ]
    return _estimates(spark, sf_dir).join(named, keys).select(*keys, *monthly.SUMS, *near)


@query
def sketch_distinct_values(spark, sf_dir):
    """Sums and estimates from the merged sketches of four batches; so few values are counted without error."""
    merged = distinct.merge_sketches(distinct.sketch_partials(fx.batched_obs(spark, sf_dir)))
    return distinct.counted_sketches(merged)


@query
def bit_distinct_values(spark, sf_dir):
    """Sums and numbers of distinct values from the merged bits of four batches."""
    return distinct.counted_bits(distinct.merge_bits(distinct.bit_partials(fx.batched_obs(spark, sf_dir))))


@query
def weather_distinct_divisor(spark, sf_dir):
    return weather_from_bits(distinct.bit_partials(fx.batched_obs(spark, sf_dir)), fx.stations(spark, sf_dir))


@query
def weather_approx_divisor(spark, sf_dir):
    return weather_from_sketches(distinct.sketch_partials(fx.batched_obs(spark, sf_dir)), fx.stations(spark, sf_dir))


# Inventory profile


@query
def inventory_recent(spark, sf_dir):
    return profile.inventory_recent(fx.inventory(spark, sf_dir), fx.INVENTORY_YEAR)


@query
def stations_per_country(spark, sf_dir):
    return profile.stations_per_country(inventory_recent(spark, sf_dir))


@query
def variable_counts(spark, sf_dir):
    return profile.variable_counts(inventory_recent(spark, sf_dir))


@query
def top_variables(spark, sf_dir):
    return profile.top_variables(inventory_recent(spark, sf_dir), fx.TOP_VARIABLES)


@query
def variable_share(spark, sf_dir):
    return profile.variable_share(inventory_recent(spark, sf_dir), fx.TOP_VARIABLES)


# Slices and series


@query
def station_list(spark, sf_dir):
    return series.distinct_values(fx.weather(spark, sf_dir), "StationId")


@query
def month_list(spark, sf_dir):
    return series.distinct_values(fx.weather(spark, sf_dir), "Month")


@query
def variable_list(spark, sf_dir):
    return series.distinct_values(fx.inventory(spark, sf_dir), "VARIABLE")


@query
def top_stations_per_country(spark, sf_dir):
    return series.top_stations(fx.weather(spark, sf_dir), ("CH", "GM", "GR", "BR", "IS"), 3)


@query
def q_temporal(spark, sf_dir):
    return series.temporal(published_weather(spark, sf_dir))


@query
def q_spatial_param(spark, sf_dir):
    return series.spatial(published_weather(spark, sf_dir), "GM", 2, fx.SPATIAL_YEAR)


@query
def q_spatiotemporal(spark, sf_dir):
    return series.spatiotemporal(published_weather(spark, sf_dir), years=fx.SERIES_YEARS)


@query
def temporal_series(spark, sf_dir):
    return series.temporal_series(published_weather(spark, sf_dir))


@query
def spatial_slices(spark, sf_dir):
    return series.spatial_slices(published_weather(spark, sf_dir), year=fx.SPATIAL_YEAR)


@query
def spatial_pairs(spark, sf_dir):
    pairs = [("CH", 2), ("BR", 8), ("GM", 2)]
    return series.spatial_pairs(published_weather(spark, sf_dir), pairs, fx.SPATIAL_YEAR)


@query
def spatiotemporal_series(spark, sf_dir):
    return series.spatiotemporal_series(published_weather(spark, sf_dir), years=fx.SERIES_YEARS)


@query
def temp_prcp_corr(spark, sf_dir):
    corr = series.temp_prcp_corr(fx.weather(spark, sf_dir))
    return corr.withColumn("corr", F.round("corr", 6))


# Streaming


#: Files that the records of each part of a stream are written to, at least, and records of a file on average: files, and
#: with them the tasks that read a micro-batch, stay of one size however many records there are.
FILES, FILE_RECORDS = 4, 50_000


def _files(spark: SparkSession, sf_dir: str) -> int:
    """Files of each part; all parts have the same number."""
    n = fx.table(spark, sf_dir, "lineitem").count()
    return max(FILES, -(-n // (fx.BATCHES * FILE_RECORDS)))


def _records(spark: SparkSession, sf_dir: str, base: str, part, parts: range = range(fx.BATCHES)) -> DataFrame:
    """A stream that takes the observations of one part after the other, a batch for each.

    `part` says which of the parts an observation belongs to. All files are there before the stream starts; it
    admits as many at a time as a part has.
    """
    files = _files(spark, sf_dir)
    for k in parts:
        some = fx.obs(spark, sf_dir).filter(part == k).repartition(files)
        fx.records(some).write.mode("append").parquet(f"{base}/records")
    return observation_stream(spark, admitted(files=files), "parquet", RAW_RECORD, f"{base}/records")


def _run(records: DataFrame, base: str, start, progress: ProgressLog | None = None, **options) -> None:
    query = start(records, checkpoint=f"{base}/checkpoint", floor=fx.FLOOR, trigger={"availableNow": True}, progress=progress, **options)
    query.awaitTermination()
    if progress is not None:
        progress.wait(query)


def _by_day(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """All records of a day in the same batch."""
    return _records(spark, sf_dir, base, F.pmod("Date", F.lit(fx.BATCHES)))


def _ingest(spark: SparkSession, sf_dir: str, progress: ProgressLog | None = None) -> str:
    """Partials by batch; gives the folder."""
    base = new_folder(spark)
    _run(_by_day(spark, sf_dir, base), base, start_ingest, progress, stations=fx.stations(spark, sf_dir), path=f"{base}/partials")
    return base


@query
def stream_ingest(spark, sf_dir):
    base = _ingest(spark, sf_dir)
    return weather_from_partials(tables.read_partials(spark, f"{base}/partials"), fx.stations(spark, sf_dir))


@query
def stream_compacted(spark, sf_dir):
    """The same, with the first three batches compacted, in two versions of the compacted table."""
    base = _ingest(spark, sf_dir)
    for up_to in (1, {"main": 2}):
        tables.compact_partials(spark, f"{base}/partials", f"{base}/compacted", up_to)
    partials = tables.read_partials(spark, f"{base}/partials", f"{base}/compacted")
    return weather_from_partials(partials, fx.stations(spark, sf_dir))


@query
def stream_daily_ingest(spark, sf_dir):
    """Repeated values of a day, spread over the micro-batches."""
    base = new_folder(spark)
    records = _records(spark, sf_dir, base, F.pmod(F.xxhash64("seq"), F.lit(fx.BATCHES)))
    _run(records, base, start_daily_ingest, path=f"{base}/daily")
    return weather_from_daily(tables.read_daily(spark, f"{base}/daily"), fx.stations(spark, sf_dir))


@query
def stream_distinct_divisor(spark, sf_dir):
    """Numbers of distinct values from the bits of four micro-batches."""
    base = new_folder(spark)
    _run(_by_day(spark, sf_dir, base), base, start_distinct_ingest, path=f"{base}/bits")
    return weather_from_bits(tables.read_bit_partials(spark, f"{base}/bits"), fx.stations(spark, sf_dir))


@query
def stream_approx_divisor(spark, sf_dir):
    """Estimates of them from the sketches of four micro-batches."""
    base = new_folder(spark)
    _run(_by_day(spark, sf_dir, base), base, start_distinct_ingest, path=f"{base}/sketches", exact=False)
    return weather_from_sketches(tables.read_sketch_partials(spark, f"{base}/sketches"), fx.stations(spark, sf_dir))


@query
def stream_monthly_state(spark, sf_dir):
    """Sums kept by a stateful stream. It goes through the years, and half of each part's records come with the next part:
    days are cut over batches, and some first values come last.
    """
    base = new_folder(spark)
    late = F.pmod(F.xxhash64("seq"), F.lit(2)).cast("int")
    part = F.least(F.call_function("div", F.greatest(fx.month_number(), F.lit(0)), F.lit(fx.PART_MONTHS)).cast("int") + late, F.lit(fx.PARTS - 1))
    records = _records(spark, sf_dir, base, part, range(fx.PARTS))
    _run(records, base, start_monthly_state, path=f"{base}/monthly", lateness=fx.LATENESS)
    return weather_from_monthly(tables.read_monthly(spark, f"{base}/monthly"), fx.stations(spark, sf_dir))


@query
def stream_moved_stations(spark, sf_dir):
    """Partials of a stream during which stations move and the station table is published anew."""
    base = new_folder(spark)

    def known() -> DataFrame:
        return snapshots.read(spark, STATION_HISTORY, f"{base}/stations")

    part = F.call_function("div", F.greatest(fx.month_number(), F.lit(0)), F.lit(fx.PART_MONTHS)).cast("int")
    moved = fx.station_history(spark, sf_dir)
    half = fx.MOVE_MONTH // fx.PART_MONTHS
    for some, parts in ((moved.filter("ValidFrom is null"), range(half)), (moved, range(half, fx.PARTS))):
        snapshots.publish(some, f"{base}/stations")
        records = _records(spark, sf_dir, base, part, parts)
        _run(records, base, start_ingest, stations=known, path=f"{base}/partials")
    return tables.read_partials(spark, f"{base}/partials").drop("stream", "batch_id")


@query
def stream_progress(spark, sf_dir):
    base = new_folder(spark)
    log = follow(spark, f"{base}/progress")
    try:
        _run(_by_day(spark, sf_dir, base), base, start_daily_ingest, log, path=f"{base}/daily")
    finally:
        spark.streams.removeListener(log)
    return tables.read_progress(spark, f"{base}/progress").drop("duration_ms")


# Evaluation of a fixed predictor


def _fixed_regression(spark, sf_dir) -> DataFrame:
    return features.with_split(fx.weather(spark, sf_dir)).select(
        "FIPS_code", "split", F.col("AvgTmax").alias("prediction"), F.col("AvgPrcp").alias("label")
    )


@query
def rmse_overall(spark, sf_dir):
    return evaluate.rmse_by(_fixed_regression(spark, sf_dir)).select(F.round("rmse", 6).alias("rmse"))


@query
def rmse_by_country(spark, sf_dir):
    errors = evaluate.rmse_by(_fixed_regression(spark, sf_dir), "split", "FIPS_code")
    return errors.withColumn("rmse", F.round("rmse", 6))


@query
def rmse_train_test(spark, sf_dir):
    return evaluate.rmse_train_test(_fixed_regression(spark, sf_dir)).select(
        "FIPS_code", F.round("train", 6).alias("train"), F.round("test", 6).alias("test")
    )


@query
def error_by_country(spark, sf_dir):
    quarter = F.call_function("div", F.col("Month") - 1, F.lit(3)) + 1
    guesses = features.with_season(fx.weather(spark, sf_dir)).select(
        "FIPS_code", quarter.alias("prediction"), F.col("Season").alias("label")
    )
    return evaluate.error_by_country(guesses).select(
        "FIPS_code",
        F.round("accuracy", 6).alias("accuracy"),
        F.round("test_error", 6).alias("test_error"),
    )


# Features

ROW = ["StationId", "Year", "Month"]


@query
def season_label(spark, sf_dir):
    return features.with_season(fx.weather(spark, sf_dir)).select(
        *ROW, "FIPS_code", "Season", season_name().alias("season_name")
    )


@query
def train_test_split(spark, sf_dir):
    return features.with_split(fx.weather(spark, sf_dir)).select(*ROW, "split")


@query
def incomplete_rows(spark, sf_dir):
    return features.incomplete_rows(fx.weather(spark, sf_dir))


def _elements(df: DataFrame, vector: str, n: int) -> DataFrame:
    array = vector_to_array(vector)
    return df.select(*ROW, *[array[i].alias(f"f{i}") for i in range(n)])


def _with_features(spark, sf_dir) -> DataFrame:
    weather = published_weather(spark, sf_dir)
    return regression.fit_features(weather).transform(weather)


@query
def fips_index(spark, sf_dir):
    return _with_features(spark, sf_dir).select("FIPS_code", "FIPS_index").distinct()


@query
def fips_onehot(spark, sf_dir):
    return _elements(_with_features(spark, sf_dir), "FIPS_vec", 4)


@query
def feature_vector(spark, sf_dir):
    return _elements(_with_features(spark, sf_dir), "features", 11)


@query
def feature_vector_location(spark, sf_dir):
    df = fx.weather(spark, sf_dir)
    for stage in features.location_features():
        df = stage.transform(df)
    return _elements(df, "features", 7)


# Models


@query
def lr_fit(spark, sf_dir):
    """Least squares on one feature, to compare with the closed form."""
    weather = published_weather(spark, sf_dir)
    vectors = features.VectorAssembler(inputCols=["AvgTmax"], outputCol="features").transform(weather)
    model = regression.linear_regression(regParam=0.0, solver="normal").fit(vectors)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))],
        "slope double, intercept double",
    )


@query
def lr_elastic(spark, sf_dir):
    stages, model = regression.fit_linear(published_weather(spark, sf_dir))
    rows = [(i, float(c)) for i, c in enumerate(model.coefficients)]
    return spark.createDataFrame([*rows, (-1, float(model.intercept))], "feature int, weight double")


@query
def lr_predictions(spark, sf_dir):
    return regression.linear_predictions(published_weather(spark, sf_dir))


@query
def lr_rmse(spark, sf_dir):
    return evaluate.rmse_by(regression.linear_predictions(published_weather(spark, sf_dir)), "split")


@query
def lr_rmse_train_test(spark, sf_dir):
    return evaluate.rmse_train_test(regression.linear_predictions(published_weather(spark, sf_dir)))


@query
def lr_ablation(spark, sf_dir):
    return regression.ablation(published_weather(spark, sf_dir))


@query
def model_sums(spark, sf_dir):
    """The sums that all linear models are solved from, by country, fold and split."""
    found = gram.sums(published_weather(spark, sf_dir))
    return found.select(*gram.PARTS, "n_rows", "n", *[F.round(c, 3).alias(c) for c in found.columns if c.startswith(("s_", "p_"))])


@query
def cv_metrics(spark, sf_dir):
    """Errors of all settings and folds, solved from one aggregation."""
    return gram.cross_validate(published_weather(spark, sf_dir))


@query
def cv_library_metrics(spark, sf_dir):
    """Errors of the library's fits, which end after `maxIter` steps."""
    return regression.cross_validate(published_weather(spark, sf_dir))


@query
def cv_optimality(spark, sf_dir):
    """How far the fits are from the optimum's conditions, to six decimals."""
    metrics = gram.cross_validate(published_weather(spark, sf_dir))
    return metrics.select(*gram.GRID, "fold", F.round("residual", 6).alias("residual"))


@query
def cv_best(spark, sf_dir):
    return regression.best_setting(gram.cross_validate(published_weather(spark, sf_dir)))


@query
def cv_single_feature(spark, sf_dir):
    """Slopes of one feature in every fold and setting, to compare with the closed form."""
    weather = published_weather(spark, sf_dir)
    known = gram.Sums(gram.sums(weather))
    at = [known.names.index("AvgTmax")]
    rows = []
    for fold, reg, elastic in product(range(3), gram.GRID["regParam"], gram.GRID["elasticNetParam"]):
        train, validation = known.part(other_than=fold), known.part(fold=fold)
        model = gram.solve(train, known.names, at, reg, elastic)
        rows.append((fold, reg, elastic, round(float(model.weights[0]), 6), round(gram.error(validation, at, model), 4)))
    return spark.createDataFrame(rows, "fold int, regParam double, elasticNetParam double, slope double, rmse double")


@query
def cv_refit_predictions(spark, sf_dir):
    """Predictions of the best setting's model, fitted on all rows."""
    weather = published_weather(spark, sf_dir)
    best = regression.best_setting(gram.cross_validate(weather)).first()
    return gram.predict(weather, gram.fit(weather, best["regParam"], best["elasticNetParam"]))


@query
def cv_refit_complete(spark, sf_dir):
    """Which rows the refitted model has predictions for."""
    return cv_refit_predictions(spark, sf_dir).select(*ROW, F.col("prediction").isNotNull().cast("int").alias("predicted"))


# One feature, for which the elastic net has a closed form.
ELASTIC = {"maxIter": 100, "regParam": 0.5, "elasticNetParam": 0.8, "solver": "l-bfgs", "tol": 1e-12}


def _one_feature(weather: DataFrame):
    rows = features.VectorAssembler(inputCols=["AvgTmax"], outputCol="features").transform(features.with_split(weather))
    return regression.linear_regression(**ELASTIC).fit(rows.filter("split = 'train'")), rows


@query
def lr_elastic_one(spark, sf_dir):
    model, _ = _one_feature(published_weather(spark, sf_dir))
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 3))], "slope double, intercept double"
    )


@query
def lr_elastic_one_rmse(spark, sf_dir):
    model, rows = _one_feature(published_weather(spark, sf_dir))
    errors = evaluate.rmse_by(model.transform(rows).withColumn("label", F.col("AvgPrcp")), "split")
    return errors.withColumn("rmse", F.round("rmse", 3))


def _complete(weather: DataFrame) -> DataFrame:
    return classification.labelled_rows(weather, "Season", COUNTRIES).filter("split = 'train'")


@query
def rf_best_split(spark, sf_dir):
    """The best first split of every country's training rows by season."""
    return splits.best_splits(_complete(published_weather(spark, sf_dir)), "Season", SEASON_NAMES)


@query
def rf_feature_splits(spark, sf_dir):
    """Running class counts over the values of every feature of every country."""
    rows = _complete(published_weather(spark, sf_dir))
    sums = splits.running_sums(splits.class_counts(rows, "Season", SEASON_NAMES), SEASON_NAMES)
    return sums.select(*splits.GROUP, "value", "next", *[c for c in sums.columns if c.startswith(("l_", "t_"))])


@query
def rf_label_given_away(spark, sf_dir):
    """With the label among the features, as the models of the time had it, a forest cannot miss."""
    weather = published_weather(spark, sf_dir)
    predictions = classification.forest_predictions(weather, "Season", include_label=True)
    errors = evaluate.error_by_country(predictions.filter("prediction is not null"))
    return errors.select("FIPS_code", (F.col("test_error") < 0.1).cast("int").alias("given_away"))


@query
def rf_tested_rows(spark, sf_dir):
    """Rows that the season forests were tested on, and which of them they could use."""
    predictions = classification.forest_predictions(published_weather(spark, sf_dir), "Season")
    return predictions.select(*ROW, "label", F.col("prediction").isNotNull().cast("int").alias("predicted"))


@query
def rf_month_error(spark, sf_dir):
    weather = published_weather(spark, sf_dir)
    return evaluate.error_by_country(classification.forest_predictions(weather, "Month").filter("prediction is not null"))


@query
def rf_season_error(spark, sf_dir):
    weather = published_weather(spark, sf_dir)
    return evaluate.error_by_country(classification.forest_predictions(weather, "Season").filter("prediction is not null"))


@query
def predictions_sample(spark, sf_dir):
    weather = published_weather(spark, sf_dir)
    predictions = classification.forest_predictions(weather, "Season", with_features=True)
    return preview(predictions, "FIPS_code", "StationId", "Year", "Month")
