"""Exact distinct counts per group, without multiplying the rows.

Several `countDistinct` in one aggregation make Spark send a copy of every row for each of them.
Here each column is counted by itself: columns with few values as bits in bitmaps, which tasks
fill before anything is shuffled; others by aggregating twice, first by value and then by group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import bounded, fits_broadcast, materialize, narrowed

_VALUE, _BIT, _BITS, _GROUP = "_value", "_bit", "_bits", "_group"


def distinct_counts(df: DataFrame, group: str, columns: Mapping[str, str]) -> DataFrame:
    """`group` (NULL is a group) and, per entry (name: column) of `columns`, the number of its
    distinct values; NULL is no value. A row per group of `df`."""
    counted = df.select(group).distinct()
    for name, column in columns.items():
        counted = with_count(counted, group, count_values(df, group, column, name), name)
    return counted


def by_value(
    df: DataFrame,
    group: str,
    column: str,
    name: str,
    rows: str = "_rows",
    least: Mapping[str, str] | None = None,
    most: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group: `name`, the distinct values of `column`, counted by aggregating by value first;
    and in the same pass the number of rows (as `rows`) and the smallest and largest values of
    further columns (`least` and `most`, name: column)."""
    least, most = least or {}, most or {}
    parts = df.groupBy(group, column).agg(
        F.count(F.lit(1)).alias(rows),
        *[F.min(of).alias(as_) for as_, of in least.items()],
        *[F.max(of).alias(as_) for as_, of in most.items()],
    )
    return parts.groupBy(group).agg(
        F.count(column).alias(name),
        F.sum(rows).alias(rows),
        *[F.min(as_).alias(as_) for as_ in least],
        *[F.max(as_).alias(as_) for as_ in most],
    )


def in_bitmaps(df: DataFrame, group: str, column: str, name: str, numbers: DataFrame) -> DataFrame:
    """Per group that has any value: `name`, the distinct values of `column`. `numbers` gives
    each value (`_value`) a number (`_bit`), and is small enough to be sent to every task.

    A task sets a bit per value it sees; bitmaps of 32,768 bits are joined per group.
    """
    known = df.select(group, F.col(column).alias(_VALUE)).join(numbers, _VALUE)
    bitmaps = known.groupBy(group, F.bitmap_bucket_number(_BIT).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_BIT)).alias(_BITS)
    )
    return bitmaps.groupBy(group).agg(F.sum(F.bitmap_count(_BITS)).cast("bigint").alias(name))


def numbered_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values (`_value`) of a column with a number each (`_bit`), written and measured.
    Numbers of one task follow each other, so bitmaps are well filled."""
    values = df.select(F.col(column).alias(_VALUE)).where(F.col(_VALUE).isNotNull()).distinct()
    return materialize(
        values.withColumn(_BIT, F.monotonically_increasing_id()), "numbers", measured=True
    )


def with_count(counted: DataFrame, group: str, found: DataFrame, name: str) -> DataFrame:
    """`counted` with the column `name` of `found` (a row per group); 0 for groups without."""
    side = materialize(found.withColumnRenamed(group, _GROUP), "counts", measured=True)
    joined = counted.join(bounded(side), F.col(group).eqNullSafe(F.col(_GROUP)), "left")
    kept = [c for c in counted.columns if c != name]
    return joined.select(*kept, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name))


def count_values(df: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """Per group: `name`, the distinct values of `column`; in bitmaps if its values were measured
    to fit into every task, else by value. Groups without a value may be missing."""
    numbers = numbered_values(df, column)
    if fits_broadcast(numbers)[0]:
        side = narrowed(F.broadcast(numbers), numbers)
        return in_bitmaps(df, group, column, name, side)
    return by_value(df, group, column, name).select(group, name)
