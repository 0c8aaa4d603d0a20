"""Running totals inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that one window of the second level holds on average, at most.
BUCKET_ROWS = 4096


def with_totals_before(
    rows: DataFrame, group: list[str], draw: str, order: list[str], totals: dict[str, Column]
) -> DataFrame:
    """`rows` plus, per entry of `totals`, the sum of its values over all rows of the same
    `group` that come earlier by `draw` (a 64-bit hash) and then `order`.

    Groups are cut into ranges of the hash, so a group with most of all rows still spreads
    over many windows: sums per range are added up first (one row per range), then each
    range is summed by itself. `rows` is read twice and must not change between. Nulls in
    `group` are a group of their own. Rows equal in `draw` and `order` must be alike.
    """
    count = rows.count()
    bits = max(0, (count // BUCKET_ROWS).bit_length())
    keys = [*group, "_bucket"]
    # The hash's own order: flipping the sign bit makes the unsigned shift keep it.
    flipped = F.col(draw).bitwiseXOR(F.lit(-(1 << 63)))
    cut = F.shiftrightunsigned(flipped, 64 - bits) if bits else F.lit(0).cast("bigint")
    bucketed = rows.withColumn("_bucket", cut)
    sums = bucketed.groupBy(*keys).agg(*[F.sum(v).alias(f"_{k}") for k, v in totals.items()])
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = sums.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        *[F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in totals],
    )
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    inside = Window.partitionBy(*keys).orderBy(draw, *order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    summed = bucketed.withColumns(
        {k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in totals.items()}
    )
    return summed.join(ranges, same).select(
        *rows.columns, *[(F.col(k) + F.col(f"_{k}")).alias(k) for k in totals]
    )
