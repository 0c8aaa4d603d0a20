"""Checks whose counts are kept per partition, so that a run scans only what has changed.

A version of a table that shares folders with the one before it (`LayerStore.stage_changed`)
shares their counts as well: violations of a folder's rows are counted once, for all versions
that hold the folder. Counts of partitions add up where a rule says so; the other rules are
evaluated on the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lavra.operators.quality import Rule, evaluate, status_of
from lavra.operators.reference import orphans
from lavra.sources.log import CommitLog
from lavra.sources.tables import StagedTable, partition_name

_PARTITION = "_partition"


def _fold(state: dict, change: dict, number: int) -> dict:
    """Counts by table, folder and rule. A change has all folders of a table that still count."""
    return {**state, **change}


@dataclass(frozen=True)
class CheckStates:
    """The counts below `path`."""

    spark: SparkSession
    path: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path.rstrip('/')}/_log", _fold, {})

    def evaluate(
        self, staged: StagedTable, rules: Sequence[Rule], tables: Mapping[str, DataFrame]
    ) -> list[Row]:
        """What `quality.evaluate` gives for the rules of one table, as rows.

        Reads the folders for which some rule has no count yet, and whole tables for rules that
        cannot be added up. Counts of a rule with a reference hold as long as the reference has
        the same keys.
        """
        folders = {value: folder for value, (_, folder) in staged.folders().items()}
        if staged.parts is None:
            return evaluate(staged.read(self.spark), rules, tables).collect()
        # Every folder is a partition of one and the same column.
        column = staged.column
        added = [rule for rule in rules if rule.adds_up_by(column)]
        keys = {rule.name: self._key(rule, tables) for rule in added}
        known = self.log.read().state.get(staged.table, {})
        counts = {folder: dict(known.get(folder, {})) for folder in folders.values()}
        missing = {
            value: folder
            for value, folder in folders.items()
            if any(key not in counts[folder] for key in keys.values())
        }
        if missing:
            for value, found in self._count(staged, column, missing, added, tables).items():
                counts[missing[value]].update({keys[name]: n for name, n in found.items()})
        live = {
            folder: {key: n for key, n in of.items() if key in keys.values()}
            for folder, of in counts.items()
        }
        if live != known:
            self.log.update(lambda seen: {staged.table: live})
        rows = [
            _row(rule, rule.total([of[keys[rule.name]] for of in live.values()])) for rule in added
        ]
        whole = [rule for rule in rules if rule.name not in keys]
        if whole:
            rows += evaluate(staged.read(self.spark), whole, tables).collect()
        return rows

    def _count(
        self,
        staged: StagedTable,
        column: str,
        missing: Mapping[str, str],
        rules: Sequence[Rule],
        tables: Mapping[str, DataFrame],
    ) -> dict[str, dict[str, int]]:
        """Violations by partition and rule, in one scan of the missing folders for all counters
        and one per rule with a reference. A row per partition reaches the driver."""
        parts = tuple(part for part in staged.parts if part[1] in missing.values())
        df = replace(staged, parts=parts, bytes=None).read(self.spark)
        df = df.withColumn(_PARTITION, partition_name(column))
        found: dict[str, dict[str, int]] = {value: {} for value in missing}
        counters = [rule for rule in rules if rule.reference is None]
        if counters:
            failed = [rule.failed.cast("bigint").alias(f"_{i}") for i, rule in enumerate(counters)]
            for row in df.groupBy(_PARTITION).agg(*failed).collect():
                for i, rule in enumerate(counters):
                    found[row[_PARTITION]][rule.name] = row[f"_{i}"]
        for rule in rules:
            if rule.reference is None:
                continue
            other, other_key = rule.reference
            lost = orphans(df, tables[other], rule.key, other_key, _PARTITION)
            n = {row[_PARTITION]: row["failed_count"] for row in lost.collect()}
            for value in missing:
                found[value][rule.name] = n.get(value, 0)
        # A folder without rows counts as nothing.
        return {
            value: {rule.name: of.get(rule.name, rule.total([])) for rule in rules}
            for value, of in found.items()
        }

    def _key(self, rule: Rule, tables: Mapping[str, DataFrame]) -> str:
        if rule.reference is None:
            return rule.name
        other, other_key = rule.reference
        hashed = F.xxhash64(F.col(other_key)).cast("decimal(38,0)")
        state = tables[other].select(other_key).distinct().agg(
            F.count(F.lit(1)).alias("n"), F.sum(hashed).cast("string").alias("sum")
        ).first()
        return f"{rule.name} in {state['n']}:{state['sum']}"


def _row(rule: Rule, failed: int) -> Row:
    return Row(
        check_name=rule.name,
        failed_count=failed,
        status=status_of(failed, rule.critical),
        critical=rule.critical,
    )
