"""Model candidates with their parameter grids.

A candidate is a dict: name, family, grid (list of parameter dicts) and build, a function from
(parameters, training rows) to an unfitted Spark ML estimator on ``features``. Regularization is
scaled so that it means the same as a penalty on the summed loss. A candidate may have fit_all, a
function from (rows, grid) to all models at once.
"""

from __future__ import annotations

from itertools import product

from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from brandlens.contract import SEED
from brandlens.models import ridge as ridge_solver

# Spark's deepest tree; stands for "no depth limit".
UNLIMITED_DEPTH = 30


def grid(**options) -> list[dict]:
    """All combinations, in the order of the lists."""
    return [dict(zip(options, values)) for values in product(*options.values())]


def candidate(name: str, family: str, build, grid: list[dict], fit_all=None) -> dict:
    return {"name": name, "family": family, "build": build, "grid": grid, "fit_all": fit_all}


def domain_candidates(trees: int = 400, max_iter: int = 3000, boosting: bool = True, rounds: int = 300) -> list[dict]:
    """Multiclass; trained with balanced row weights in ``weight``."""
    def logistic(p, n):
        return LogisticRegression(family="multinomial", regParam=1.0 / (p["C"] * n), elasticNetParam=0.0,
                                  standardization=False, maxIter=max_iter, weightCol="weight", labelCol="label")

    def forest(p, n):
        return RandomForestClassifier(numTrees=trees, maxDepth=p["max_depth"] or UNLIMITED_DEPTH,
                                      minInstancesPerNode=p["min_leaf"], featureSubsetStrategy="sqrt", seed=SEED,
                                      weightCol="weight", labelCol="label", cacheNodeIds=True)

    def boosted(p, n):
        trees_ = GBTClassifier(maxIter=rounds, stepSize=p["learning_rate"], maxDepth=p["max_depth"], subsamplingRate=0.9,
                               featureSubsetStrategy="0.9", seed=SEED)
        return OneVsRest(classifier=trees_, labelCol="label")

    found = [
        candidate("LogisticRegression", "linear", logistic, grid(C=[0.3, 1.0, 3.0])),
        candidate("RandomForest", "bagging", forest, grid(max_depth=[None, 20], min_leaf=[1, 2])),
    ]
    if boosting:
        found.append(candidate("GradientBoosting", "boosting", boosted, grid(learning_rate=[0.05, 0.1], max_depth=[4, 6])))
    return found


def founded_candidates(trees: int = 400, max_iter: int = 200, boosting: bool = True, rounds: int = 300) -> list[dict]:
    """Regression on log1p of the year, in ``label``."""
    def ridges(rows, params):
        if len(rows.first()["features"]) > ridge_solver.MOST_COLUMNS:
            return iterated(rows, params)
        return ridge_solver.fit(rows, [p["alpha"] for p in params])

    def iterated(rows, params):
        # Spark's iterative solver divides the penalty by the label's deviation.
        n, deviation = rows.agg(F.count(F.lit(1)), F.stddev_samp("label")).first()
        return [ridge(p, n).setRegParam(p["alpha"] * (deviation or 1.0) / n).fit(rows) for p in params]

    ridges.iterated = iterated

    def ridge(p, n):
        return LinearRegression(regParam=p["alpha"] / n, elasticNetParam=0.0, standardization=False, solver="l-bfgs",
                                maxIter=max_iter, labelCol="label")

    def forest(p, n):
        return RandomForestRegressor(numTrees=trees, maxDepth=p["max_depth"] or UNLIMITED_DEPTH,
                                     minInstancesPerNode=p["min_leaf"], featureSubsetStrategy="all", seed=SEED,
                                     labelCol="label", cacheNodeIds=True)

    def boosted(p, n):
        return GBTRegressor(maxIter=rounds, stepSize=p["learning_rate"], maxDepth=p["max_depth"], subsamplingRate=0.9,
                            featureSubsetStrategy="0.9", seed=SEED, labelCol="label")

    found = [
        candidate("Ridge", "linear", ridge, grid(alpha=[0.3, 1.0, 3.0]), ridges),
        candidate("RandomForest", "bagging", forest, grid(max_depth=[None, 12], min_leaf=[1, 2])),
    ]
    if boosting:
        found.append(candidate("GradientBoosting", "boosting", boosted, grid(learning_rate=[0.05, 0.1], max_depth=[4, 6])))
    return found


def price_candidates(trees: int = 400, max_iter: int = 3000, boosting: bool = True, rounds: int = 300) -> list[dict]:
    """Binary models, one per label, trained with balanced row weights."""
    def logistic(p, n):
        return LogisticRegression(family="binomial", regParam=1.0 / (p["C"] * n), elasticNetParam=0.0,
                                  standardization=False, maxIter=max_iter, weightCol="weight")

    def forest(p, n):
        return RandomForestClassifier(numTrees=trees, maxDepth=p["max_depth"], minInstancesPerNode=p["min_leaf"],
                                      featureSubsetStrategy="sqrt", seed=SEED, weightCol="weight", cacheNodeIds=True)

    def boosted(p, n):
        return GBTClassifier(maxIter=rounds, stepSize=p["learning_rate"], maxDepth=p["max_depth"], subsamplingRate=0.9,
                             featureSubsetStrategy="0.9", seed=SEED)

    found = [
        candidate("LogisticRegression", "linear", logistic, grid(C=[0.3, 1.0, 3.0])),
        candidate("RandomForest", "bagging", forest, grid(max_depth=[12, 20], min_leaf=[1, 2])),
    ]
    if boosting:
        found.append(candidate("GradientBoosting", "boosting", boosted, grid(learning_rate=[0.05, 0.1], max_depth=[4, 6])))
    return found
