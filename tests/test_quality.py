from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lavra.operators import quality
from lavra.operators.quality import QualityFailure, run_suite
from lavra.plans.checks import gold_rules, silver_rules


def result(df, rule, tables=None):
    row = quality.evaluate(df, [rule], tables or {}).first()
    return row["failed_count"], row["status"]


def test_unique_counts_repeats_and_null_keys(table):
    df = table("id string, ano bigint", ("a", 1), ("a", 1), ("b", 1), ("c", None), (None, 1))
    rule = quality.unique("t", "r", ["id", "ano"], ["id"])
    assert result(df, rule) == (2, "FAIL")
    assert result(df.where("id = 'b'"), rule) == (0, "PASS")


def test_unique_uses_text_keys(table):
    # Parts are joined by '-', so these two different keys collide.
    df = table("a string, b string", ("x-y", "z"), ("x", "y-z"))
    assert result(df, quality.unique("t", "r", ["a", "b"]))[0] == 1


def test_null_range_domain_present_volume(table):
    df = table("a bigint, x double", (0, 50.0), (2, None), (None, -1.0), (1, 100.0))
    assert result(df, quality.not_null("t", "r", ["a", "x"])) == (2, "FAIL")
    assert result(df, quality.domain("t", "r", ["a"], [0, 1])) == (1, "FAIL")
    assert result(df, quality.in_range("t", "r", ["x"], 0.0, 100.0)) == (1, "WARN")
    assert result(df, quality.volume("t", "r")) == (4, "WARN")
    assert result(df.limit(0), quality.volume("t", "r")) == (0, "PASS")
    assert result(df, quality.present("t", "r", "a")) == (0, "PASS")
    assert result(df.where("a IS NULL"), quality.present("t", "r", "a")) == (1, "FAIL")


def test_references(table):
    df, dim = table("k string", ("a",), ("z",), (None,), ("z",)), table("d string", ("a",))
    assert result(df, quality.references("t", "r", "k", "dim", "d"), {"dim": dim}) == (3, "FAIL")


def test_all_counters_of_a_table_share_one_scan(spark, folder, table):
    table("id string, v bigint", ("a", 1)).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    rules = [
        quality.unique("t", "u", ["id"]),
        quality.not_null("t", "n", ["id"]),
        quality.domain("t", "d", ["v"], [1]),
    ]
    plan = quality.evaluate(df, rules, {})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_first_critical_violation_in_suite_order_raises_and_all_results_are_kept(
    spark, folder, table, rows
):
    path = f"{folder}/history"
    tables = {"a": table("x bigint", (None,)), "b": table("x bigint", (None,), (1,))}
    rules = [
        quality.volume("a", "volume a"),
        quality.not_null("b", "nulls b", ["x"]),
        quality.not_null("a", "nulls a", ["x"]),
        quality.present("b", "present b", "x"),
    ]
    with pytest.raises(QualityFailure, match="nulls b"):
        run_suite(spark, "silver", tables, rules, path)
    history = quality.read_history(spark, path)
    assert rows(history, "layer", "check_name", "failed_count", "status", "critical") == [
        ("silver", "nulls a", 1, "FAIL", True),
        ("silver", "nulls b", 1, "FAIL", True),
        ("silver", "present b", 0, "PASS", True),
        ("silver", "volume a", 1, "WARN", False),
    ]
    assert history.select("run_id").distinct().count() == 1
    assert history.select("executed_at").distinct().count() == 1


def test_warnings_do_not_raise(spark, folder, table):
    tables = {"a": table("x bigint", (1,))}
    results = run_suite(spark, "silver", tables, [quality.volume("a", "v")], f"{folder}/h")
    assert [r["status"] for r in results] == ["WARN"]
    assert quality.read_history(spark, f"{folder}/h").count() == 1


def test_results_before_a_broken_check_are_kept(spark, folder, table):
    rules = [quality.volume("a", "v"), quality.not_null("b", "n", ["missing"])]
    tables = {"a": table("x bigint", (1,)), "b": table("x bigint", (1,))}
    with pytest.raises(Exception, match="missing"):
        run_suite(spark, "silver", tables, rules, f"{folder}/h")
    assert quality.read_history(spark, f"{folder}/h").count() == 1


def test_failing_history_does_not_hide_the_verdict(spark, folder, table):
    blocked = f"{folder}/file"
    with open(blocked, "w") as f:
        f.write("not a folder")
    with pytest.raises(QualityFailure):
        tables = {"a": table("x bigint", (None,))}
        run_suite(spark, "silver", tables, [quality.not_null("a", "n", ["x"])], f"{blocked}/h")


def test_nothing_is_written_without_results(spark, folder):
    import os

    assert run_suite(spark, "silver", {}, [], f"{folder}/h") == []
    assert not os.path.exists(f"{folder}/h")


def test_check_once(table):
    df = table("x bigint", (None,), (1,))
    with pytest.raises(QualityFailure):
        quality.check_once(df, quality.not_null("t", "n", ["x"]))
    assert quality.check_once(df, quality.volume("t", "v")) == 2


def test_trend_reads_recent_days_only(spark, folder, table, rows):
    path = f"{folder}/h"
    found = table(
        "check_name string, failed_count bigint, status string, critical boolean",
        ("c", 1, "FAIL", True),
        ("other", 2, "FAIL", True),
    )
    now = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)
    for days in (0, 10, 30, 31):
        executed = now - dt.timedelta(days=days)
        quality.append_history(quality.in_history_schema(found, f"r{days}", executed, "silver"), path)
    at = F.lit("2024-03-01 12:00:00").cast("timestamp")
    shown = quality.trend(quality.read_history(spark, path), "c", at)
    assert [str(r["dia"]) for r in shown.collect()] == ["2024-03-01", "2024-02-20", "2024-01-31"]
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(executed_date" in plan


def test_suites_have_all_checks_in_order(spark):
    silver, gold = silver_rules(), gold_rules()
    assert len(silver) == 18 and len(gold) == 8
    assert len({r.name for r in silver + gold}) == 26
    assert [r.critical for r in silver] == [True] * 11 + [False] * 4 + [True] * 2 + [False]
    assert [r.critical for r in gold] == [True] * 6 + [False, True]
