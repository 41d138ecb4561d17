"""Scores and levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bumpwise.options import ImpactRule, RiskLevels


def standardized(value: Column, mean: Column, stddev: Column) -> Column:
    """z-score; 0.0 where the deviation is unknown (one row) or zero (constant column)."""
    return F.when(stddev.isNull() | (stddev == 0), F.lit(0.0)).otherwise((value - mean) / stddev)


def impact_score(rule: ImpactRule = ImpactRule()) -> Column:
    """Weighted sum of the absolute `nor_*` columns."""
    terms = (F.abs(F.col(f"nor_{name}")) * F.lit(weight) for name, weight in rule.weights)
    return reduce(Column.__add__, terms)


def risk_level(count: Column, levels: RiskLevels = RiskLevels()) -> Column:
    return (
        F.when(count > levels.critical_above, "critical")
        .when(count > levels.warning_above, "warning")
        .otherwise("normal")
    )


def priority_score(total: Column, days: Column) -> Column:
    """Impacts times days, raised by the logarithm of the impacts."""
    return F.round(total * days * (1 + F.ln(F.greatest(total, F.lit(1)))), 2)
