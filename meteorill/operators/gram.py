"""Linear models from sums: one pass over the rows serves every split, fold, setting and set of features.

What least squares, ridge and elastic net need to know of the rows are their number, the sums of the features and the
label, and the sums of their products. Those of country, fold and split add up to those of any part, so one
hash aggregation gives the training and validation parts of all folds. The sums are a few hundred numbers for each
such group; models are solved from them on the driver by coordinate descent, to convergence.

Scalars are taken from a fixed centre, so that squares of years do not swallow their differences. The country enters as
indicators of all but the last country (the most frequent first, ties by code), whose products need no sums
of their own. Rows that lack a scalar or the label take no part, but count for the countries' order.
Features are scaled by their deviation and penalised as the library's normal-equation solver does: the objective is
half the mean squared error in units of the label's variance, plus the penalty over the label's deviation.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations_with_replacement, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteorill.operators.features import REGRESSION_SCALARS, TEMPERATURES, row_bucket, with_split
from meteorill.operators.regression import GRID, LABEL

COLUMNS = [*REGRESSION_SCALARS, LABEL]
CENTRES = {"Month": 6.5, "Year": 2000.0}
PARTS = ["FIPS_code", "fold", "split"]
#: Coordinate descent ends when no weight moves by more.
TOLERANCE, MOST_ROUNDS = 1e-13, 100_000


def sums(weather: DataFrame, folds: int = 3) -> DataFrame:
    """For each country, fold and split: rows, complete rows, and over these the sums and sums of products.

    The number of result rows is that of the groups, whatever the number of rows.
    """
    centred = {c: F.col(c).cast("double") - CENTRES.get(c, 0.0) for c in COLUMNS}
    complete = F.lit(True)
    for column in COLUMNS:
        complete = complete & F.col(column).isNotNull()
    marked = with_split(weather).withColumn("fold", row_bucket(folds)).select(*PARTS, *[F.when(complete, centred[c]).alias(c) for c in COLUMNS])
    found = [F.count(F.lit(1)).alias("n_rows"), F.count(LABEL).alias("n")]
    found += [F.sum(c).alias(f"s_{c}") for c in COLUMNS]
    found += [F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in combinations_with_replacement(COLUMNS, 2)]
    return marked.groupBy(*PARTS).agg(*found)


@dataclass
class Part:
    """Moments of a part of the rows: number, sums and products of [features, label]."""

    n: float
    total: np.ndarray
    squares: np.ndarray

    def __add__(self, other: Part) -> Part:
        return Part(self.n + other.n, self.total + other.total, self.squares + other.squares)


@dataclass
class Model:
    """Weights of the features, centred as in CENTRES, and how far from the optimum they are."""

    names: list[str]
    weights: np.ndarray
    intercept: float
    residual: float

    def uncentred_intercept(self) -> float:
        """The intercept for features as they are in the table."""
        return self.intercept - sum(w * CENTRES.get(c, 0.0) for c, w in zip(self.names, self.weights, strict=True))


class Sums:
    """The collected groups: a few hundred numbers for each country, fold and split."""

    def __init__(self, table: DataFrame) -> None:
        rows = [r.asDict() for r in table.collect() if r["FIPS_code"] is not None]
        seen: dict[str, int] = {}
        for r in rows:
            seen[r["FIPS_code"]] = seen.get(r["FIPS_code"], 0) + r["n_rows"]
        self.codes = sorted(seen, key=lambda c: (-seen[c], c))
        self.names = [*REGRESSION_SCALARS, *[f"FIPS_{c}" for c in self.codes[:-1]]]
        self.groups = [(r["fold"], r["split"], r["FIPS_code"], self._part(r)) for r in rows if r["n"]]

    def _part(self, r: dict) -> Part:
        k, extra = len(COLUMNS) - 1, len(self.codes) - 1
        total = np.zeros(k + extra + 1)
        squares = np.zeros((k + extra + 1, k + extra + 1))
        place = [*range(k), k + extra]
        total[place] = [r[f"s_{c}"] for c in COLUMNS]
        for (i, a), (j, b) in combinations_with_replacement(list(enumerate(COLUMNS)), 2):
            squares[place[i], place[j]] = squares[place[j], place[i]] = r[f"p_{a}_{b}"]
        if (index := self.codes.index(r["FIPS_code"])) < extra:
            at = k + index
            total[at] = squares[at, at] = r["n"]
            squares[at, place] = squares[place, at] = total[place]
        return Part(float(r["n"]), total, squares)

    def part(self, fold: int | None = None, other_than: int | None = None, split: str | None = None, code: str | None = None) -> Part | None:
        """The moments of a fold, of all folds but one, of a split, of a country, or of any of these together."""
        chosen = [
            p
            for f, s, c, p in self.groups
            if (fold is None or f == fold) and f != other_than and (split is None or s == split) and (code is None or c == code)
        ]
        if not chosen:
            return None
        out = chosen[0]
        for p in chosen[1:]:
            out = out + p
        return out

    def columns(self, with_temperature: bool = True) -> list[int]:
        return [i for i, name in enumerate(self.names) if with_temperature or name not in TEMPERATURES]


def solve(part: Part, names: list[str], columns: list[int], reg: float, elastic: float) -> Model:
    """The elastic net of a part's rows over some columns, by coordinate descent on their correlations."""
    picked = [*columns, len(part.total) - 1]
    mean = part.total[picked] / part.n
    centred = part.squares[np.ix_(picked, picked)] - part.n * np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(centred), 0) / part.n)
    label = deviation[-1]
    varies = deviation[:-1] > 0
    weights = np.zeros(len(columns))
    residual = 0.0
    if label > 0 and varies.any():
        scale = np.where(varies, deviation[:-1], 1)
        gram = centred[:-1, :-1] / part.n / np.outer(scale, scale)
        target = centred[:-1, -1] / part.n / scale / label
        sparse, ridge = reg / label * elastic, reg / label * (1 - elastic)
        active = np.flatnonzero(varies)
        for _ in range(MOST_ROUNDS):
            moved = 0.0
            for j in active:
                pull = target[j] - gram[j] @ weights + gram[j, j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - sparse, 0.0) / (gram[j, j] + ridge)
                moved = max(moved, abs(new - weights[j]))
                weights[j] = new
            if moved < TOLERANCE:
                break
        residual = optimality(gram[np.ix_(active, active)], target[active], weights[active], sparse, ridge)
        weights = np.where(varies, weights * label / scale, 0.0)
    return Model([names[c] for c in columns], weights, float(mean[-1] - weights @ mean[:-1]), residual)


def optimality(gram: np.ndarray, target: np.ndarray, weights: np.ndarray, sparse: float, ridge: float) -> float:
    """The largest violation of the optimum's conditions: a weight's slope equals its penalty's, and where the weight is
    zero, it is at most that.
    """
    slope = target - gram @ weights - ridge * weights
    off = np.where(weights != 0, np.abs(slope - sparse * np.sign(weights)), np.maximum(np.abs(slope) - sparse, 0))
    return float(off.max(initial=0.0))


def error(part: Part, columns: list[int], model: Model) -> float:
    """Root mean squared error of a model over a part's rows, from the moments alone."""
    w = np.zeros(len(part.total))
    w[columns], w[-1] = -model.weights, 1.0
    squared = w @ part.squares @ w - 2 * model.intercept * (w @ part.total) + part.n * model.intercept**2
    return float(np.sqrt(max(squared, 0.0) / part.n))


def cross_validate(weather: DataFrame, grid: dict[str, list] = GRID, folds: int = 3) -> DataFrame:
    """Validation error and optimality of every setting in every fold, all from one aggregation.

    Settings are solved to convergence, so that `maxIter`, where the grid has it, changes nothing: settings
    that differ in it alone tie. The result has settings x folds rows.
    """
    known = Sums(sums(weather, folds))
    columns, rows = known.columns(), []
    solved: dict[tuple, Model] = {}
    for setting in product(*grid.values()):
        named = dict(zip(grid, setting, strict=True))
        for fold in range(folds):
            train, validation = known.part(other_than=fold), known.part(fold=fold)
            if train is None or validation is None:
                continue
            key = (fold, named["regParam"], named["elasticNetParam"])
            if key not in solved:
                solved[key] = solve(train, known.names, columns, named["regParam"], named["elasticNetParam"])
            rows.append((*map(float, setting), fold, error(validation, columns, solved[key]), solved[key].residual))
    schema = ", ".join([*[f"{name} double" for name in grid], "fold int", "rmse double", "residual double"])
    return weather.sparkSession.createDataFrame(rows, schema)


def fit(weather: DataFrame, reg: float, elastic: float, split: str | None = None) -> Model:
    """One model of all rows, or of a split's."""
    known = Sums(sums(weather))
    part = known.part(split=split)
    if part is None:
        raise ValueError("no complete rows to fit")
    return solve(part, known.names, known.columns(), reg, elastic)


def predict(weather: DataFrame, model: Model) -> DataFrame:
    """Predictions for every row, as an expression; one that lacks a feature keeps its place with a null."""
    value = F.lit(model.uncentred_intercept())
    for name, weight in zip(model.names, model.weights.tolist(), strict=True):
        of_country = F.when(F.col("FIPS_code").isNotNull(), (F.col("FIPS_code") == name.removeprefix("FIPS_")).cast("double"))
        value = value + F.lit(weight) * (F.col(name) if name in REGRESSION_SCALARS else of_country)
    return with_split(weather).select("StationId", "Year", "Month", "FIPS_code", "split", F.col(LABEL).alias("label"), value.alias("prediction"))


def ablation(weather: DataFrame, reg: float, elastic: float, splits: Iterable[str] = ("train", "test")) -> DataFrame:
    """Error by country and split of the model of the training rows, with and without the temperatures; one aggregation."""
    known = Sums(sums(weather))
    rows = []
    for name, with_temperature in (("all", True), ("no_temperature", False)):
        columns = known.columns(with_temperature)
        train = known.part(split="train")
        if train is None:
            continue
        model = solve(train, known.names, columns, reg, elastic)
        for split, code in product(splits, known.codes):
            part = known.part(split=split, code=code)
            if part is not None:
                rows.append((name, split, code, error(part, columns, model)))
    return weather.sparkSession.createDataFrame(rows, "features string, split string, FIPS_code string, rmse double")
