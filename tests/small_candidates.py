"""Small candidate lists for tests of the training protocol."""

from brandlens.models import candidates as K


def _light(found, name, point):
    """One candidate of a list with a single grid point."""
    return {**next(c for c in found if c["name"] == name), "grid": [point]}


def light_candidates(max_iter=15, trees=10):
    return {
        "domain": [_light(K.domain_candidates(max_iter=max_iter), "LogisticRegression", {"C": 1.0}),
                   _light(K.domain_candidates(trees), "RandomForest", {"max_depth": 8, "min_leaf": 1})],
        # The exact ridge brings its Gramian to the driver; it has tests of its own.
        "founded": [{**_light(K.founded_candidates(max_iter=max_iter), "Ridge", {"alpha": 1.0}), "fit_all": None},
                    _light(K.founded_candidates(trees), "RandomForest", {"max_depth": 5, "min_leaf": 2})],
        "price_category": [_light(K.price_candidates(max_iter=max_iter), "LogisticRegression", {"C": 1.0})],
    }
