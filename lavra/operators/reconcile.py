"""Agreement of own figures with published ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_absolute_errors(
    own: DataFrame,
    official: DataFrame,
    keys: Sequence[str],
    pairs: dict[str, tuple[Column, Column]],
) -> DataFrame:
    """One row: for each name in `pairs`, the mean of |own - official| over matched keys
    where both exist, and the number of such keys."""
    errors = {name: F.abs(a - b) for name, (a, b) in pairs.items()}
    return own.join(official, list(keys), "inner").agg(
        *[F.avg(e).alias(name) for name, e in errors.items()],
        *[F.count(e).alias(f"{name}_keys") for name, e in errors.items()],
    )
