"""Append-only snapshots.

A Bronze table is a folder with one `_ingested_at=...` partition per snapshot. Next to it,
`<table>__snapshots` lists the finished snapshots with their row counts, so finding the
newest one reads a few rows and never opens the data.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.times import instant, micros
from lavra.runtime import path_exists
from lavra.session import require_utc
from lavra.sources.files import declared_columns

log = logging.getLogger(__name__)

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"

_SNAPSHOTS = "ingested_at timestamp, source string, row_count bigint"


@dataclass(frozen=True)
class SnapshotSize:
    snapshot_rows: int
    total_rows: int


def stamp(df: DataFrame, ingested_at: dt.datetime, source: str) -> DataFrame:
    """Add the ingest metadata; the time is one literal, equal on every row."""
    return df.withColumns({INGESTED_AT: instant(ingested_at), SOURCE_FILE: F.lit(source)})


def append_snapshot(
    df: DataFrame, path: str, ingested_at: dt.datetime, source: str, schema: T.StructType
) -> SnapshotSize:
    """Append `df` as one snapshot, by column name; the first append creates the table.

    Columns beyond `schema` are kept in the files, after the declared ones.

    The snapshot counts once its row is in the list, so an append that dies half way is
    never read. Repeating it with the same time replaces the unfinished partition.
    """
    spark = df.sparkSession
    require_utc(spark)
    if _finished(spark, path, ingested_at):
        raise ValueError(f"{path} already has a snapshot of {ingested_at}")
    taken = {INGESTED_AT, SOURCE_FILE} & set(df.columns)
    if taken:
        raise ValueError(f"columns have the names of ingest metadata: {sorted(taken)}")
    df = declared_columns(df, schema, source)
    size = Observation("snapshot")
    (
        stamp(df, ingested_at, source)
        .observe(size, F.count(F.lit(1)).alias("row_count"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGESTED_AT)
        .parquet(path)
    )
    rows = size.get["row_count"]
    entry = spark.range(1).select(
        instant(ingested_at).alias("ingested_at"),
        F.lit(source).alias("source"),
        F.lit(rows).cast("bigint").alias("row_count"),
    )
    entry.write.mode("append").parquet(_list_path(path))
    total = snapshots(spark, path).agg(F.sum("row_count").alias("n")).first()["n"]
    log.info("%s: snapshot of %d rows, %d rows in total", path, rows, total)
    return SnapshotSize(rows, total)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The finished snapshots of a table."""
    return spark.read.schema(_SNAPSHOTS).parquet(_list_path(path))


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All snapshots of a table."""
    require_utc(spark)
    meta = [(SOURCE_FILE, T.StringType()), (INGESTED_AT, T.TimestampType())]
    full = T.StructType([*schema.fields, *[T.StructField(*field) for field in meta]])
    return spark.read.schema(full).parquet(path)


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest finished snapshot; the literal time prunes all other partitions."""
    newest = snapshots(spark, path).agg(F.max(F.unix_micros("ingested_at")).alias("at")).first()
    history = read_history(spark, path, schema)
    if newest["at"] is None:
        return history.where(F.lit(False))
    return history.where(F.col(INGESTED_AT) == F.timestamp_micros(F.lit(newest["at"])))


def latest_snapshot(df: DataFrame, column: str = INGESTED_AT) -> DataFrame:
    """Rows of the newest snapshot of any table; no rows if the table is empty.

    The scalar subquery becomes a partition filter when `column` is a partition column.
    """
    return df.where(F.col(column) == df.select(F.max(column)).scalar())


def snapshot_counts(df: DataFrame, column: str = INGESTED_AT) -> DataFrame:
    """Rows per snapshot."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _finished(spark: SparkSession, path: str, ingested_at: dt.datetime) -> bool:
    if not path_exists(spark, _list_path(path)):
        return False
    same = F.unix_micros("ingested_at") == micros(ingested_at)
    return not snapshots(spark, path).where(same).isEmpty()


def _list_path(path: str) -> str:
    return f"{path.rstrip('/')}__snapshots"
