import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from meteorill.operators import classification, evaluate, features, regression
from meteorill.operators.preview import preview
from meteorill.schemas import WEATHER


def test_split_is_stable_on_any_partitioning(weather, rows):
    one = features.with_split(weather.coalesce(1))
    many = features.with_split(weather.repartition(7))
    columns = ["StationId", "Year", "Month", "split"]
    assert rows(one, *columns) == rows(many, *columns)
    share = one.agg(F.avg((F.col("split") == "train").cast("double"))).first()[0]
    assert 0.6 < share < 0.8


def test_more_buckets_than_hash_values_are_refused():
    with pytest.raises(ValueError):
        features.row_bucket(1 << 17)


def test_missing_features_are_counted_and_skipped(weather, rows):
    counted = features.incomplete_rows(weather).agg(F.sum("n_rows"), F.sum("n_incomplete")).first()
    vectors = regression.fit_features(weather).transform(weather)
    assert counted[0] == weather.count() and counted[1] > 0
    assert vectors.count() == counted[0] - counted[1]


def test_one_feature_matches_closed_form(weather):
    vectors = VectorAssembler(inputCols=["AvgTmax"], outputCol="features").transform(weather)
    model = regression.linear_regression(regParam=0.0, solver="normal").fit(vectors)
    slope, intercept = weather.agg(
        F.regr_slope("AvgPrcp", "AvgTmax"), F.regr_intercept("AvgPrcp", "AvgTmax")
    ).first()
    assert model.coefficients[0] == pytest.approx(slope)
    assert model.intercept == pytest.approx(intercept)


def test_rmse_equals_the_evaluator(weather):
    predictions = regression.linear_predictions(weather)
    known = predictions.filter("prediction is not null")
    whole = RegressionEvaluator(metricName="rmse").evaluate(known)
    assert evaluate.rmse_by(predictions).first().rmse == pytest.approx(whole)
    wide = {r.FIPS_code: r for r in evaluate.rmse_train_test(predictions).collect()}
    for row in evaluate.rmse_by(predictions, "split", "FIPS_code").collect():
        assert wide[row.FIPS_code][row.split] == pytest.approx(row.rmse)


def test_settings_reach_the_model(weather):
    _, model = regression.fit_linear(weather)
    assert (model.getMaxIter(), model.getRegParam(), model.getElasticNetParam()) == (1, 1.0, 0.8)


def test_ablation_drops_two_features(weather):
    with_all, _ = regression.fit_linear(weather, True)
    without, _ = regression.fit_linear(weather, False)
    assert len(with_all.stages[-1].getInputCols()) - len(without.stages[-1].getInputCols()) == 2
    assert regression.ablation(weather).select("features").distinct().count() == 2


def test_cross_validation_equals_the_library_one(weather):
    grid = {"maxIter": [1, 10], "regParam": [0.1], "elasticNetParam": [0.0, 0.8]}
    mine = regression.average_metrics(regression.cross_validate(weather, grid)).collect()
    got = {(r.maxIter, r.regParam, r.elasticNetParam): r.avg_rmse for r in mine}

    data = regression.fit_features(weather).transform(regression.with_fold(weather, 3))
    lr = regression.linear_regression()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(lr.getParam(name), values)
    settings = builder.build()
    model = CrossValidator(
        estimator=lr, estimatorParamMaps=settings, numFolds=3, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol="AvgPrcp", metricName="rmse"),
    ).fit(data)
    for setting, metric in zip(settings, model.avgMetrics, strict=True):
        key = tuple(float(setting[lr.getParam(name)]) for name in grid)
        assert got[key] == pytest.approx(metric)


def test_rows_that_lack_a_feature_keep_their_place(weather):
    missing = features.incomplete_rows(weather).agg(F.sum("n_incomplete")).first()[0]
    predictions = regression.linear_predictions(weather)
    assert predictions.count() == weather.count()
    assert predictions.filter("prediction is null").count() == missing > 0
    forest = classification.forest_predictions(weather, "Season", ["GM"], with_features=True)
    tested = classification.labelled_rows(weather, "Season", ["GM"]).filter("split = 'test'")
    assert forest.count() == tested.count()
    assert forest.filter("(prediction is null) <> (features is null)").count() == 0


def test_models_of_each_fold_and_refit(weather):
    grid = {"maxIter": [5], "regParam": [0.1, 1.0], "elasticNetParam": [0.0]}
    metrics, models = regression.cross_validate(weather, grid, keep_models=True)
    assert [len(m) for m in models] == [2, 2, 2] and metrics.count() == 6
    stages, model = regression.refit(weather, metrics, list(grid))
    best = regression.best_setting(metrics, list(grid)).first()
    data = stages.transform(weather)
    direct = regression.linear_regression(maxIter=5, regParam=best.regParam, elasticNetParam=0.0).fit(data)
    assert list(model.coefficients) == pytest.approx(list(direct.coefficients))
    assert regression.predict(weather, stages, model).count() == weather.count()


def test_best_is_the_lowest(spark):
    metrics = spark.createDataFrame(
        [(1.0, 0.1, 0.0, 0, 5.0), (1.0, 0.1, 0.0, 1, 3.0), (5.0, 0.1, 0.0, 0, 2.0), (5.0, 0.1, 0.0, 1, 5.0)],
        "maxIter double, regParam double, elasticNetParam double, fold int, rmse double",
    )
    best = regression.best_setting(metrics).collect()
    assert len(best) == 1 and (best[0].maxIter, best[0].avg_rmse) == (5.0, 3.5)


def test_error_equals_the_evaluator(weather):
    rows = classification.labelled_rows(weather, "Season", ["GM"])
    model = classification.fit_forests(rows, "Season")["GM"]
    predictions = model.transform(rows.filter("split = 'test'"))
    accuracy = MulticlassClassificationEvaluator(
        labelCol="indexedLabel", predictionCol="prediction", metricName="accuracy"
    ).evaluate(predictions)
    mine = evaluate.error_by_country(
        classification.forest_predictions(weather, "Season", ["GM"])
    ).collect()
    assert len(mine) == 1
    assert mine[0].accuracy == pytest.approx(accuracy)
    assert mine[0].test_error == pytest.approx(1 - accuracy)


def test_label_among_the_features_gives_it_away(weather):
    def error(include_label):
        predictions = classification.forest_predictions(
            weather, "Season", ["GM", "BR"], include_label=include_label
        )
        return predictions.agg(F.avg((F.col("prediction") != F.col("label")).cast("int"))).first()[0]

    assert error(True) < 0.05 < error(False)


def test_forests_are_repeatable(weather, rows):
    first = classification.forest_predictions(weather, "Month", ["GM"])
    second = classification.forest_predictions(weather, "Month", ["GM"])
    assert rows(first) == rows(second)


def some_weather(spark, codes, months, n=30):
    data = [
        (f"{c}{i}", months[i % len(months)], 1990 + i, 1.0 * i, 2.0 * i, 3.0 * (i % 7), c, 1.0 * i, 2.0, 3.0)
        for c in codes
        for i in range(n)
    ]
    return spark.createDataFrame(data, WEATHER)


def test_absent_country_and_single_label(spark):
    df = some_weather(spark, ["GM"], [1, 2]).union(some_weather(spark, ["CH"], [3]))
    predictions = classification.forest_predictions(df, "Month")
    errors = {r.FIPS_code: r.test_error for r in evaluate.error_by_country(predictions).collect()}
    assert set(errors) == {"GM", "CH"}
    assert errors["CH"] == 0.0


def test_country_without_training_rows(spark):
    df = some_weather(spark, ["GM"], [1, 2]).filter("false")
    assert classification.forest_predictions(df, "Month").count() == 0


def test_sample_is_ordered(weather):
    predictions = classification.forest_predictions(weather, "Month", ["GM", "CH"])
    sample = preview(predictions, "FIPS_code", "StationId", "Year", "Month").collect()
    keys = [(r.FIPS_code, r.StationId, r.Year, r.Month) for r in sample]
    assert len(keys) == 5 and keys == sorted(keys)


def test_perfect_prediction_and_missing_split(spark):
    df = spark.createDataFrame(
        [("CH", "train", 1.0, 1.0), ("GM", "test", 2.0, 5.0)],
        "FIPS_code string, split string, prediction double, label double",
    )
    got = {r.FIPS_code: (r.train, r.test) for r in evaluate.rmse_train_test(df).collect()}
    assert got == {"CH": (0.0, None), "GM": (None, 3.0)}
    assert math.isclose(evaluate.rmse_by(df).first().rmse, math.sqrt(4.5))
