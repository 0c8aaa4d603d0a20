"""Distinct counts without copies of the rows, against `countDistinct`."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lavra.operators import distinct
from lavra.operators.freshness import FreshnessNames, freshness

SCHEMA = "g bigint, person string, place string, at bigint"


@pytest.fixture
def sample(table):
    draw = random.Random(1)
    values = [
        (
            draw.choice([1, 1, 1, 2, 3, None]),
            draw.choice([None, *map(str, range(200))]),
            draw.choice([None, "hot", "hot", *map(str, range(40))]),
            draw.randrange(99),
        )
        for _ in range(900)
    ]
    return table(SCHEMA, *values, (7, None, None, 5), values[0]).repartition(5)


def expected(sample):
    return sample.groupBy("g").agg(
        F.countDistinct("person").alias("persons"), F.countDistinct("place").alias("places")
    )


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_equals_count_distinct(sample, rows, monkeypatch, limit):
    """Both ways: values that are sent to every task, and values that are too many for it."""
    monkeypatch.setattr("lavra.runtime.BROADCAST_BYTES", limit)
    found = distinct.distinct_counts(sample, "g", {"persons": "person", "places": "place"})
    assert rows(found) == rows(expected(sample))
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_more_values_than_a_bitmap_has_bits(spark):
    df = spark.range(100_000).selectExpr("id % 2 AS g", "CAST(id % 70000 AS STRING) AS v")
    numbers = distinct.numbered_values(df, "v")
    found = distinct.in_bitmaps(df, "g", "v", "n", F.broadcast(numbers)).collect()
    assert {r["g"]: r["n"] for r in found} == {0: 35_000, 1: 35_000}


def test_empty(table, rows):
    empty = table(SCHEMA)
    assert rows(distinct.distinct_counts(empty, "g", {"places": "place"})) == []


def test_freshness_has_no_expand(sample, rows):
    names = FreshnessNames("n", "persons", "places", "first", "last", "share")
    found = freshness(sample, sample, "g", "person", "place", "at", names)
    everyone = sample.where("person IS NOT NULL").select("person").distinct().count()
    plain = (
        sample.groupBy("g")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("person").alias("persons"),
            F.countDistinct("place").alias("places"),
            F.min("at").alias("first"),
            F.max("at").alias("last"),
        )
        .withColumn("share", F.col("persons") / everyone * 100)
    )
    assert rows(found) == rows(plain)
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
