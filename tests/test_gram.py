"""Models from sums against the library's fits and against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meteorill.operators import evaluate, features, gram, regression
from meteorill.schemas import WEATHER


@pytest.mark.parametrize("reg, elastic", [(0.0, 0.0), (0.1, 0.0), (1.0, 0.5), (0.5, 0.8), (20.0, 0.8)])
def test_equal_the_library_at_convergence(weather, reg, elastic):
    model = gram.fit(weather, reg, elastic)
    vectors = regression.fit_features(weather).transform(weather)
    direct = regression.linear_regression(regParam=reg, elasticNetParam=elastic, maxIter=5000, tol=1e-14).fit(vectors)
    assert model.weights.tolist() == pytest.approx(direct.coefficients.toArray().tolist(), rel=1e-4, abs=1e-5)
    assert model.uncentred_intercept() == pytest.approx(direct.intercept, rel=1e-4)
    assert model.residual < 1e-9


def test_errors_are_those_of_the_predictions(weather):
    metrics = gram.cross_validate(weather, {"maxIter": [1, 5], "regParam": [0.5], "elasticNetParam": [0.8]}).collect()
    assert len(metrics) == 6 and all(m.residual < 1e-6 for m in metrics)
    folded = regression.with_fold(weather, 3)
    for fold in range(3):
        known = gram.Sums(gram.sums(weather))
        model = gram.solve(known.part(other_than=fold), known.names, known.columns(), 0.5, 0.8)
        predictions = gram.predict(folded.filter(F.col("fold") == fold), model)
        expected = evaluate.rmse_by(predictions.filter("prediction is not null")).first().rmse
        assert [m.rmse for m in metrics if m.fold == fold] == pytest.approx([expected] * 2)


def test_one_scan_and_no_vectors(weather):
    plan = gram.sums(weather)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_sum" in plan and "Python" not in plan


def test_ablation_equals_models_fitted_alone(weather):
    got = {(r.features, r.split, r.FIPS_code): r.rmse for r in gram.ablation(weather, 0.1, 0.0).collect()}
    for name, with_temperature in (("all", True), ("no_temperature", False)):
        predictions = regression.linear_predictions(weather, with_temperature, regParam=0.1, elasticNetParam=0.0, maxIter=100)
        for r in evaluate.rmse_by(predictions, "split", "FIPS_code").collect():
            assert got[name, r.split, r.FIPS_code] == pytest.approx(r.rmse, rel=1e-6)


def test_predictions_keep_every_row(weather):
    predictions = gram.predict(weather, gram.fit(weather, 0.1, 0.5, "train"))
    missing = features.incomplete_rows(weather).agg(F.sum("n_incomplete")).first()[0]
    assert predictions.count() == weather.count()
    assert predictions.filter("prediction is null").count() == missing


def test_optimality_sees_a_wrong_weight():
    matrix, target = np.array([[1.0, 0.2], [0.2, 1.0]]), np.array([0.6, 0.05])
    right = gram.solve(gram.Part(100.0, np.zeros(3), 100 * np.block([[matrix, target[:, None]], [target[None], np.ones((1, 1))]])), ["a", "b"], [0, 1], 0.1, 0.5)
    assert right.residual < 1e-12
    assert gram.optimality(matrix, target, right.weights + np.array([0.1, 0]), 0.05, 0.05) > 0.05


def test_constant_features_one_country_and_no_rows(spark):
    rows = [(f"GM{i}", 1 + i % 12, 2000, float(i), float(i % 5), 3.0 * i + 1, "GM", 1.0, 2.0, 3.0) for i in range(60)]
    model = gram.fit(spark.createDataFrame(rows, WEATHER), 0.0, 0.0)
    by_name = dict(zip(model.names, model.weights, strict=True))
    assert by_name["AvgTmax"] == pytest.approx(3.0) and by_name["Year"] == by_name["ELEVATION"] == 0.0
    with pytest.raises(ValueError, match="no complete rows"):
        gram.fit(spark.createDataFrame([], WEATHER), 0.0, 0.0)
    assert gram.cross_validate(spark.createDataFrame([], WEATHER)).count() == 0
