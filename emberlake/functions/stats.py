"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both columns are set; null where one is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)).cast("double"), F.when(both, F.col(b)).cast("double")
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))
