"""Comparison marts: every key of any input, with measures, targets and verdicts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import deviation, target_met


def key_spine(inputs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of all inputs; a NULL counts as one value."""
    sides = [df.select(*keys) for df in inputs]
    return reduce(lambda a, b: a.unionByName(b), sides).distinct()


def verdicts(df: DataFrame, target: str, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add, for each (actual, deviation name, flag name), the distance to the target and
    whether it was met."""
    added = {}
    for actual, distance, met in pairs:
        added[distance] = deviation(F.col(actual), F.col(target))
        added[met] = target_met(F.col(actual), F.col(target))
    return df.withColumns(added)
