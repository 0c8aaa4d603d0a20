"""One key owns a third of all rows: the work of that key must be split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.functions.text import pad_key
from lavra.operators.dedup import latest_by
from lavra.operators.reference import enrich, quarantine

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
}


@pytest.fixture
def shuffled(spark):
    """Joins go by shuffle, and small test data already counts as skewed."""
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)




def people(spark, n=300_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, numPartitions=8).select(
        F.when(hot, "7").otherwise((F.col("id") % 5000).cast("string")).alias("place"),
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


def places(spark):
    return spark.range(4000).select(
        F.lpad(F.col("id").cast("string"), 7, "0").alias("k"), F.lit("A").alias("uf")
    )


def test_enrich_splits_a_hot_place(spark, shuffled):
    out = enrich(people(spark), places(spark), pad_key(F.col("place"), 7), "k")
    collected = out.groupBy().count()
    assert collected.first()[0] == 100_000 + 200_000 * 4 // 5
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_quarantine_splits_a_hot_unknown_place(spark, shuffled):
    dim = places(spark).where("k <> '0000007'")
    out = quarantine(people(spark), dim, pad_key(F.col("place"), 7), "k", {"why": F.lit("x")})
    assert len(out.collect()) >= 100_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_dedup_ships_one_row_per_key_and_partition(spark):
    hot = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("at")
    )
    out = latest_by(hot, ["key"], [F.desc("at")])
    collected = {r["key"]: r["at"] for r in out.collect()}
    assert collected[-1] == 199_998
    assert len(collected) == 1 + 200_000 - 66_667
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
