"""Aggregate column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["safe_corr", "first_by"]


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows where both sides are there; null if undefined.

    A side that is constant over those rows leaves it undefined. That is decided by its
    least and greatest value: merged partial variances of a constant are not exactly 0.
    ``corr`` itself raises under ANSI mode there, ``regr_r2`` does not.
    """
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()

    def varies(side: Column) -> Column:
        return F.min(F.when(both, side)) < F.max(F.when(both, side))

    r2, covariance = F.regr_r2(y, x), F.covar_pop(x, y)
    return F.when(varies(x) & varies(y), F.sqrt(r2) * F.signum(covariance) + 0.0)


def first_by(value: Column, order: Column, where: Column | None = None) -> Column:
    """The value with the smallest ``order`` among the rows where ``where`` holds."""
    return F.min_by(value, order if where is None else F.when(where, order))
