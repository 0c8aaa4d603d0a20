"""Text helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run without ASCII white space, the same split as `bytes.split()`.
WORD = r"[^\x20\x09-\x0D]+"


# Bytes that go to a Python task at once; a longer row goes alone.
ARROW_BYTES = 4 << 20
_SPARKS_BOUND = f"{64 << 20}b"


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes, so that Python tasks need the same
    memory whatever the length of the texts. A bound that the session was given stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _SPARKS_BOUND:
        spark.conf.set(key, f"{ARROW_BYTES}b")


# Characters of a plan's text that Spark keeps for its listeners.
PLAN_CHARS = 1 << 17
_SPARKS_CHARS = "2147483632b"


def bound_plan_texts(spark: SparkSession) -> None:
    """Bound the text that Spark keeps of every plan, for plans with large literals. A bound
    that the session was given stays."""
    key = "spark.sql.maxPlanStringLength"
    if spark.conf.get(key) == _SPARKS_CHARS:
        spark.conf.set(key, f"{PLAN_CHARS}b")


def words(text: Column) -> Column:
    """All words of `text`; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, extended until no column of `df` has it (names compare without case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes of `text`; null counts as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
