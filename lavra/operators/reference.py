"""Split rows by whether their key exists in a reference table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN = "_known"

_KEY = "_reference_key"


def enrich(df: DataFrame, dim: DataFrame, key: Column, dim_key: str) -> DataFrame:
    """Rows whose key is known, with the columns of `dim` added (its key column replaces
    nothing and is dropped)."""
    side = dim.withColumnRenamed(dim_key, _KEY)
    return df.withColumn(_KEY, key).join(side, _KEY, "inner").drop(_KEY)


def quarantine(
    df: DataFrame, dim: DataFrame, key: Column, dim_key: str, marks: Mapping[str, Column]
) -> DataFrame:
    """Rows whose key is unknown or NULL, unchanged, plus the `marks` columns."""
    side = dim.select(F.col(dim_key).alias(_KEY))
    rejected = df.withColumn(_KEY, key).join(side, _KEY, "left_anti").drop(_KEY)
    return rejected.withColumns(dict(marks))


def mark(df: DataFrame, dim: DataFrame, key: Column, dim_key: str) -> DataFrame:
    """All rows with the columns of `dim` added, and whether the key is known.

    For large tables whose two halves are both needed: join once, write the result with
    `KNOWN` as folder, and read each half from its own folder.
    """
    side = dim.withColumnRenamed(dim_key, _KEY).withColumn(KNOWN, F.lit(True))
    joined = df.withColumn(_KEY, key).join(side, _KEY, "left").drop(_KEY)
    return joined.withColumn(KNOWN, F.coalesce(KNOWN, F.lit(False)))


def orphan_count(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """One row: how many rows have a key that `dim` lacks.

    Counting per key before the join leaves one row per key to shuffle, hot or not.
    """
    return _unknown(df, dim, key, dim_key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failed_count")
    )


def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str, group: str) -> DataFrame:
    """`orphan_count` per value of `group`; groups without any have no row."""
    unknown = _unknown(df, dim, key, dim_key, group)
    return unknown.groupBy(group).agg(F.sum("n").cast("bigint").alias("failed_count"))


def _unknown(df: DataFrame, dim: DataFrame, key: str, dim_key: str, *group: str) -> DataFrame:
    per_key = df.groupBy(*group, F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("n"))
    side = dim.select(F.col(dim_key).alias(_KEY))
    return per_key.join(side, _KEY, "left_anti")
