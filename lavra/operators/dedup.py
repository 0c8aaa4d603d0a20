"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str | Column],
    ties: Sequence[str] = (),
) -> DataFrame:
    """The first row per key; all other columns (or `ties`) break ties, so it is repeatable.

    A name in `newest_first` sorts descending, and does not break ties again.

    Spark ranks inside every input partition first and ships one row per key and partition,
    so a key with a third of all rows does not pile up in one task.
    """
    named = [c for c in newest_first if isinstance(c, str)]
    ties = list(ties) or [c for c in df.columns if c not in keys and c not in named]
    newest = [F.desc(c) if isinstance(c, str) else c for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*newest, *[F.col(c).asc() for c in ties])
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )
