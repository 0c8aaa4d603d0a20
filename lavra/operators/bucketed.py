"""Joins in place: inputs written once in buckets by the join key.

A bucket of one input holds the keys of the same bucket of every other, so joins and groupings
on the key read the files as they lie and shuffle nothing. It pays for inputs too large to be
broadcast that are joined more than once: each is shuffled once, when it is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.compare import key_spine
from lavra.operators.joins import SALT_BYTES, salted_lookup, salts_for
from lavra.runtime import measured_bytes, scratch_path
from lavra.sources.log import fresh_name


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """`df` as a table in `buckets` by `keys`, one file each, below the scratch folder.

    The table is dropped from the catalogue by `forget`; its files go with the scratch folder.
    """
    spark, name = df.sparkSession, f"buckets_{fresh_name()}"
    keys = list(keys)
    # Files by the same hash as the buckets: a task writes one bucket's file.
    spread = df.repartition(buckets, *keys)
    (
        spread.write.format("parquet")
        .option("path", scratch_path(spark, name))
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)


# Names of the tables that `forget` drops, by session.
_tables: dict[str, list[str]] = {}


def forget(spark: SparkSession) -> None:
    """Drop the catalogue entries of all bucketed tables; results built from them must have
    been consumed."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def spine_in_buckets(
    sides: Sequence[DataFrame], keys: Sequence[str], buckets: int
) -> tuple[DataFrame, list[DataFrame]]:
    """All distinct keys of `sides`, and the sides, in the same buckets."""
    tables = [in_buckets(side, keys, buckets) for side in sides]
    # The keys of the sides as they came: Spark 4.1 takes a union of tables in buckets for one
    # in the same buckets, reads more partitions, and fails to join them.
    return in_buckets(key_spine(sides, keys), keys, buckets), tables


def bucketed_lookup(left: DataFrame, sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """`left` LEFT JOIN each of `sides` on equal `keys`, all of them in buckets by `keys`.

    A key that owns more than a task should get of its side is no case for one bucket: that
    side is joined by `salted_lookup`. One row per side, its hottest key's, is measured.
    """
    keys = list(keys)
    for side, size in zip(sides, measured_bytes(*sides), strict=True):
        per_key = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        hottest, rows = per_key.agg(F.max("n"), F.sum("n")).first()
        if rows and size / rows * hottest > SALT_BYTES:
            left = salted_lookup(left, side, keys, salts_for(size))
        else:
            left = left.join(side.hint("merge"), keys, "left")
    return left
