"""Drift rules as column expressions.

A rule answers null, never true or false, when either side is missing or NaN:
in SQL a NaN compares as larger than every number and would raise a false alert.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftmon.schemas import AUC_THRESHOLD, RMSE_FACTOR


def known(metric: Column) -> Column:
    return metric.isNotNull() & ~F.isnan(metric)


def auc_drift(test: Column, base: Column, threshold: float = AUC_THRESHOLD) -> Column:
    """Absolute rule: a move in either direction beyond the threshold."""
    return F.when(known(test) & known(base), F.abs(test - base) > F.lit(threshold))


def rmse_drift(test: Column, base: Column, factor: float = RMSE_FACTOR) -> Column:
    """Ratio rule: the error grew beyond `factor` times the baseline."""
    return F.when(known(test) & known(base), test > base * F.lit(factor))
