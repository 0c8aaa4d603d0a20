"""Declarative list of sources: what to read, as which type, into which Bronze table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.sources import files


@dataclass(frozen=True)
class Source:
    """One source of a Bronze table.

    `location` is a path, or a table name when `format` is "table".
    """

    table: str
    format: str
    location: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        """Scan the whole source on the executors, whatever its size.

        The source's own columns are compared with the declared ones before anything is
        imposed; a missing or mistyped column raises, and further columns are kept.
        """
        if self.format == "table":
            return self._checked(spark.read.table(self.location))
        if self.format == "csv":
            return files.read_csv(spark, self.location, self.schema)
        if self.format in ("places_json", "places_json_lines"):
            array = self.format == "places_json"
            return files.flatten_places(files.read_places_json(spark, self.location, array))
        if self.format == "json":
            return files.read_json(spark, self.location, self.schema)
        return self._checked(spark.read.format(self.format).load(self.location))

    def _checked(self, df: DataFrame) -> DataFrame:
        return files.declared_columns(df, self.schema, self.location)


def row_counts(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
