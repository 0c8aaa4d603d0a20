"""Joins in place, against joins that shuffle."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lavra.operators import bucketed
from lavra.operators.compare import key_spine

KEYS = ["ano", "place", "rede"]


@pytest.fixture
def sides(table):
    """Three inputs with shared, lone and null keys; one repeats keys, one has a hot key."""
    draw = random.Random(1)

    def make(name, n, hot=0):
        keys = [(draw.choice([2023, 2024, None]), draw.choice([None, *"abcdefgh"]), draw.choice("xy")) for _ in range(n)]
        keys += [(2023, "hot", "x")] * hot
        return table(f"ano bigint, place string, rede string, {name} bigint", *[(*k, i) for i, k in enumerate(keys)])

    return [make("a", 40), make("b", 25), make("c", 30, hot=60)]


def joined(spine, sides):
    for side in sides:
        spine = spine.join(side, KEYS, "left")
    return spine


@pytest.fixture
def without_small_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bucketed.forget(spark)


def test_joins_in_place(spark, sides, rows, without_small_joins):
    expected = rows(joined(key_spine(sides, KEYS), sides))
    spine, tables = bucketed.spine_in_buckets(sides, KEYS, 4)
    found = bucketed.bucketed_lookup(spine, tables, KEYS)
    assert rows(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 3
    bucketed.forget(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


def test_hot_key_is_salted(spark, sides, rows, monkeypatch, without_small_joins):
    """A key that owns more of a side than a task should get is spread."""
    monkeypatch.setattr(bucketed, "SALT_BYTES", 1000)
    expected = rows(joined(key_spine(sides, KEYS), sides))
    spine, tables = bucketed.spine_in_buckets(sides, KEYS, 4)
    assert rows(bucketed.bucketed_lookup(spine, tables, KEYS)) == expected


def test_empty_side(spark, sides, rows, without_small_joins):
    with_empty = [sides[0], sides[1].where(F.lit(False))]
    spine, tables = bucketed.spine_in_buckets(with_empty, KEYS, 4)
    found = bucketed.bucketed_lookup(spine, tables, KEYS)
    assert rows(found) == rows(joined(key_spine(with_empty, KEYS), with_empty))
