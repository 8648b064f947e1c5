"""All registered queries."""

from brandlens.plans import evaluation, modelling, profiling, runs_and_views, tables_and_functions  # noqa: F401
from brandlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
