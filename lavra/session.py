"""Session settings the library expects; every one can be overridden by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Bronze partitions and day partitions are written as UTC text.
    "spark.sql.session.timeZone": "UTC",
    # Joins, rebalancing writes and partition counts are re-planned from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Shuffle input that one task should get, and the most partitions worth their bookkeeping.
TASK_BYTES = 128 * 1024 * 1024
MOST_PARTITIONS = 100_000


def shuffle_partitions(input_bytes: int) -> int:
    """Initial shuffle partitions for inputs of this size.

    Adaptive execution merges partitions but makes no new ones for a window or an
    aggregation, so this is the ceiling of their parallelism.
    """
    return max(200, min(-(-input_bytes // TASK_BYTES), MOST_PARTITIONS))


def build_session(
    app: str = "lavra", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """Session with `SETTINGS`; `extra` keys use `__` for dots (`spark__driver__memory`).

    `input_bytes`, the size of the largest input, sets the shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Partition values hold timestamps as text, so writer and reader must agree on UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")
