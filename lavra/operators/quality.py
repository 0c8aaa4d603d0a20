"""Declarative checks, evaluated with one scan per table, and their history."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import blank_if_null, key_text
from lavra.functions.times import day, days_before, instant, utc_now
from lavra.operators.reference import orphan_count

log = logging.getLogger(__name__)

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
SUM, LEAST = "sum", "least"

RESULTS = (
    "run_id string, executed_at timestamp, layer string, check_name string, "
    "failed_count bigint, status string, critical boolean"
)


class QualityFailure(ValueError):
    """A critical check found violations."""


@dataclass(frozen=True)
class Rule:
    """One check on one table: `failed` aggregates the table to a number of violations.

    A rule with `reference` = (table, key there) counts rows whose `key` is missing there.
    `merge` says how the violations of parts of a table combine: by `SUM`, also if the rule is
    about `distinct` columns, provided that one of them tells the part; by `LEAST`, for rules
    that one part can satisfy; or not at all (None).
    """

    table: str
    name: str
    failed: Column | None = None
    critical: bool = True
    key: str = ""
    reference: tuple[str, str] | None = None
    merge: str | None = SUM
    distinct: tuple[str, ...] = ()

    def adds_up_by(self, column: str) -> bool:
        """Whether counts of the partitions by `column` give the count of the table."""
        return self.merge is not None and (not self.distinct or column in self.distinct)

    def total(self, counts: Sequence[int]) -> int:
        """The violations of a table from those of its parts; of no rows if there are none."""
        return min(counts, default=1) if self.merge == LEAST else sum(counts)


def unique(table: str, name: str, columns: Sequence[str], blank: Sequence[str] = ()) -> Rule:
    """Rows minus distinct keys. Columns in `blank` treat NULL as empty text; a NULL in any
    other column makes the key NULL, which counts as a violation."""
    key = key_text(*[blank_if_null(F.col(c)) if c in blank else F.col(c) for c in columns])
    failed = F.count(F.lit(1)) - F.countDistinct(key)
    return Rule(table, name, failed, distinct=tuple(columns))


def not_null(table: str, name: str, columns: Sequence[str]) -> Rule:
    return Rule(table, name, F.count_if(_any(F.col(c).isNull() for c in columns)))


def references(table: str, name: str, key: str, reference: str, reference_key: str) -> Rule:
    return Rule(table, name, key=key, reference=(reference, reference_key))


def volume(table: str, name: str) -> Rule:
    """Rows present; never critical."""
    return Rule(table, name, F.count(F.lit(1)), critical=False)


def domain(table: str, name: str, columns: Sequence[str], values: Sequence) -> Rule:
    """Values outside `values`; NULL is not counted."""
    return Rule(table, name, F.count_if(_any(~F.col(c).isin(list(values)) for c in columns)))


def in_range(
    table: str, name: str, columns: Sequence[str], low: float, high: float, critical: bool = False
) -> Rule:
    """Values outside [low, high]; NULL is not counted."""
    outside = _any((F.col(c) < low) | (F.col(c) > high) for c in columns)
    return Rule(table, name, F.count_if(outside), critical)


def present(table: str, name: str, column: str) -> Rule:
    """Violated once if no row has a value in `column`."""
    return Rule(table, name, F.when(F.count(column) == 0, 1).otherwise(0), merge=LEAST)


def status_of(failed: int, critical: bool) -> str:
    if failed == 0:
        return PASS
    return FAIL if critical else WARN


def evaluate(df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (check_name, failed_count, status, critical), one per rule on the table `df`.

    All counters share one scan; a reference rule adds one scan of its key column.
    """
    results = []
    counters = [rule for rule in rules if rule.reference is None]
    if counters:
        cells = [
            F.struct(
                F.lit(rule.name).alias("check_name"),
                F.col(f"_{i}").alias("failed_count"),
                F.lit(rule.critical).alias("critical"),
            )
            for i, rule in enumerate(counters)
        ]
        counted = df.agg(
            *[rule.failed.cast("bigint").alias(f"_{i}") for i, rule in enumerate(counters)]
        )
        results.append(counted.select(F.inline(F.array(*cells))))
    for rule in rules:
        if rule.reference is not None:
            other, other_key = rule.reference
            orphans = orphan_count(df, tables[other], rule.key, other_key)
            results.append(
                orphans.select(
                    F.lit(rule.name).alias("check_name"),
                    "failed_count",
                    F.lit(rule.critical).alias("critical"),
                )
            )
    merged = reduce(lambda a, b: a.unionByName(b), results)
    violated = F.col("failed_count") > 0
    status = F.when(~violated, PASS).when(F.col("critical"), FAIL).otherwise(WARN)
    return merged.select("check_name", "failed_count", status.alias("status"), "critical")


def evaluate_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Results of a whole suite over several tables."""
    names = list(dict.fromkeys(rule.table for rule in rules))
    parts = [
        evaluate(tables[name], [r for r in rules if r.table == name], tables) for name in names
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_suite(
    spark: SparkSession,
    layer: str,
    tables: Mapping[str, DataFrame],
    rules: Sequence[Rule],
    history: str | None = None,
    count: Callable[[str, list[Rule]], list[Row]] | None = None,
) -> list[Row]:
    """Evaluate all rules, then raise the first critical violation in suite order. `count` gives
    the results of one table's rules; without it the table is evaluated.

    Everything evaluated so far goes to `history` on every way out, under one run id and time;
    a history that cannot be written is logged and does not hide the verdict. The driver
    receives one row per rule.
    """
    place = {rule.name: i for i, rule in enumerate(rules)}
    started, found = utc_now(), []
    try:
        for name in dict.fromkeys(rule.table for rule in rules):
            own = [rule for rule in rules if rule.table == name]
            found += count(name, own) if count else evaluate(tables[name], own, tables).collect()
        found.sort(key=lambda row: place[row["check_name"]])
        gate(found)
    finally:
        if found and history is not None:
            _record(spark, found, str(uuid.uuid4()), started, layer, history)
    return found


def _record(
    spark: SparkSession, found: Sequence[Row], run_id: str, at: dt.datetime, layer: str, path: str
) -> None:
    table = spark.createDataFrame(
        [tuple(row) for row in found],
        "check_name string, failed_count bigint, status string, critical boolean",
    )
    try:
        append_history(in_history_schema(table, run_id, at, layer), path)
    except Exception:
        log.exception("the results of run %s are missing in %s", run_id, path)


def gate(results: Sequence[Row]) -> None:
    """Log warnings; raise on the first critical violation."""
    failures = []
    for row in results:
        text = f"check [{row['check_name']}]: {row['failed_count']} violations"
        if row["status"] == FAIL:
            log.error(text)
            failures.append(text)
        elif row["status"] == WARN:
            log.warning(text)
        else:
            log.info(text)
    if failures:
        raise QualityFailure(failures[0])


def check_once(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame] | None = None) -> int:
    """One check without history; raises if it is critical and violated."""
    row = evaluate(df, [rule], tables or {}).first()
    gate([row])
    return row["failed_count"]


def in_history_schema(
    results: DataFrame, run_id: str, executed_at: dt.datetime, layer: str
) -> DataFrame:
    return results.select(
        F.lit(run_id).alias("run_id"),
        instant(executed_at).alias("executed_at"),
        F.lit(layer).alias("layer"),
        "check_name",
        "failed_count",
        "status",
        "critical",
    )


def append_history(results: DataFrame, path: str) -> None:
    """Append to the history, one folder per day; the first append creates it."""
    (
        results.withColumn("executed_date", day(F.col("executed_at")))
        .sortWithinPartitions("executed_date", "layer", "check_name")
        .write.mode("append")
        .partitionBy("executed_date")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{RESULTS}, executed_date date").parquet(path)


def trend(history: DataFrame, check_name: str, now: Column, days: int = 30) -> DataFrame:
    """Results of one check in the last `days`, newest day first.

    The bound on the day column prunes the folders of older days. Sorting by the time itself
    also sorts the days, and spreads a busy day over many sort partitions.
    """
    since = days_before(now, days)
    recent = history.where((F.col("executed_at") >= since) & (F.col("check_name") == check_name))
    if "executed_date" in history.columns:
        recent = recent.where(F.col("executed_date") >= day(since))
    return recent.orderBy(F.desc("executed_at")).select(
        day(F.col("executed_at")).alias("dia"), "status", "failed_count"
    )


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)
