"""Replaceable layer tables.

A new version of a table is written beside the old one and becomes current when the layer's log
names it. One entry publishes all tables of a layer, so readers see either the old or the new set
and never a half-written table, and of two builds that began from one state only one can publish.
A version may share folders with the one before it, for partitions whose rows are the same.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.runtime import child_paths, observe_size, path_exists, remove, with_size
from lavra.sources.log import CommitConflict, CommitLog, Version, fresh_name

# Published versions of a table that the log remembers.
MOST_KEPT = 32
# How Spark names the folder of a null.
_NULL = "__HIVE_DEFAULT_PARTITION__"
_OLD_VERSIONS = "table_name string, path string, schema string, published_ns bigint, bytes bigint"


def _fold(state: dict, change: dict, number: int) -> dict:
    """The current tables, and per table the versions that were current, newest first."""
    tables = {**state["tables"], **change["tables"]}
    history = dict(state["history"])
    for name, entry in change["tables"].items():
        history[name] = [entry, *history.get(name, ())][:MOST_KEPT]
    return {"tables": tables, "history": history}


_EMPTY: dict[str, Any] = {"tables": {}, "history": {}}


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk: folders by `partition`, row order by `cluster`."""

    partition: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()


def write_layout(df: DataFrame, path: str, layout: Layout) -> None:
    """Write `df` partitioned, with rows of equal cluster values close together.

    The rebalance hint shuffles on the folders and the first cluster column, so a file holds
    few of their values. It then merges small shuffle blocks and splits large ones: one value
    with a third of all rows is written by many tasks. The order inside each file makes the
    Parquet statistics selective on the other cluster columns as well.
    """
    spread = [*layout.partition, *layout.cluster[:1]]
    df = df.hint("rebalance", *[F.col(name) for name in spread])
    order = [*layout.partition, *layout.cluster]
    if order:
        df = df.sortWithinPartitions(*order)
    df.write.mode("errorifexists").partitionBy(*layout.partition).parquet(path)


class LayerStore:
    """Versioned tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def version(self, layer: str) -> int:
        """The number of the layer's last publication, for `publish(after=...)`."""
        return self._seen(layer).number

    def stage(self, df: DataFrame, layer: str, table: str, layout: Layout) -> "StagedTable":
        """Write a new version that nobody reads yet."""
        path = f"{self.path(layer, table)}/v-{fresh_name()}"
        observed, size = observe_size(df)
        write_layout(observed, path, layout)
        return StagedTable(table, path, df.schema, size())

    def stage_changed(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        layout: Layout,
        ignoring: Sequence[str] = (),
    ) -> "StagedTable":
        """Like `stage`, but writes only the partitions whose rows differ from the current
        version's, and shares the folders of the others with it.

        Rows are compared by count and by two sums of hashes over all columns but `ignoring`
        (processing times, say); columns left out keep their old values in shared folders.
        `df` is computed twice. The first version, one with other columns, and one after a
        version that was staged without comparing are written whole.
        """
        (column,) = layout.partition
        digests = _digests(df, column, ignoring)
        path = f"{self.path(layer, table)}/v-{fresh_name()}"
        current = self._seen(layer).state["tables"].get(table)
        old = StagedTable.of(table, current) if current else None
        shared: dict[str, tuple[str, str]] = {}
        if old and old.digests and old.schema == df.schema:
            folders = old.folders()
            same = {value for value, digest in digests.items() if old.digests.get(value) == digest}
            shared = {value: folders[value] for value in same if value in folders}
        changed = [value for value in digests if value not in shared]
        observed, size = observe_size(df.where(partition_name(column).isin(changed)))
        write_layout(observed, path, layout)
        parts = [*shared.values(), *_partition_folders(self.spark, path, column).values()]
        written = size() if changed else 0
        # Shared folders are parts of the old version and no larger than it.
        known = None if written is None or (shared and old.bytes is None) else written
        total = known if known is None or not shared else known + old.bytes
        return StagedTable(table, path, df.schema, total, tuple(parts), digests)

    def publish(
        self, layer: str, staged: Sequence["StagedTable"], after: int | None = None
    ) -> int:
        """Make all `staged` versions current in one commit, and return its number.

        With `after`, the number of the publication that the build began from, this raises
        `CommitConflict` if there has been another one since; nothing is published then.
        """

        def change(_: Version) -> dict:
            seen = self._seen(layer)
            if after is not None and seen.number != after:
                raise CommitConflict(f"{layer} was published by somebody else meanwhile")
            # The first entry takes over what an older layout has published.
            before = {} if seen.number else seen.state["tables"]
            return {"tables": {**before, **{s.table: s.entry() for s in staged}}}

        return self._log(layer).update(change).number

    def discard(self, staged: Sequence["StagedTable"]) -> None:
        """Remove versions that were staged and will not be published; folders that they share
        with published versions stay."""
        for version in staged:
            remove(self.spark, version.path)

    def remove_unlisted(self, layer: str, keep: int = 1) -> list[str]:
        """Remove all versions of a layer's tables but the `keep` last published ones, and
        return their paths. Folders that a kept version shares stay. Readers of an older
        version, and builds that have not published yet, must have ended. Run it as a step of
        its own."""
        if not 1 <= keep <= MOST_KEPT:
            raise ValueError(f"the current version stays, and at most {MOST_KEPT} are remembered")
        history = self._seen(layer).state["history"]
        stays, shared = set(), set()
        for table, entries in history.items():
            for version in (StagedTable.of(table, entry) for entry in entries[:keep]):
                stays.add(version.path)
                shared |= {folder for _, folder in version.parts or ()}
        gone = []
        for table in child_paths(self.spark, f"{self.root}/{layer}"):
            if table.rsplit("/", 1)[-1] in ("versions", "_log"):
                continue
            for version in child_paths(self.spark, table):
                if version in stays or not version.rsplit("/", 1)[-1].startswith("v-"):
                    continue
                used = [path for path in shared if path.startswith(f"{version}/")]
                unused = [p for p in child_paths(self.spark, version) if p not in used] if used else [version]
                for path in unused:
                    remove(self.spark, path)
                gone += [path for path in unused if path == version or "=" in path.rsplit("/", 1)[-1]]
        return gone

    def current(self, layer: str) -> Mapping[str, DataFrame]:
        """The published tables of a layer."""
        tables = self._seen(layer).state["tables"]
        return {
            name: StagedTable.of(name, entry).read(self.spark) for name, entry in tables.items()
        }

    def _log(self, layer: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{layer}/_log", _fold, _EMPTY)

    def _seen(self, layer: str) -> Version:
        seen = self._log(layer).read()
        old = f"{self.root}/{layer}/versions"
        if seen.number or not path_exists(self.spark, old):
            return seen
        # An older layout appended a row per table and publication to a list.
        state = _EMPTY
        rows = self.spark.read.schema(_OLD_VERSIONS).json(old).orderBy("published_ns").collect()
        for row in rows:
            entry = {"path": row["path"], "schema": json.loads(row["schema"]), "bytes": row["bytes"]}
            state = _fold(state, {"tables": {row["table_name"]: entry}}, 0)
        return Version(0, state)


def partition_name(column: str) -> Column:
    """A partition value as its folder's name has it; values are years or other plain text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(_NULL))


def _digests(df: DataFrame, column: str, ignoring: Sequence[str]) -> dict[str, str]:
    """Per partition value (as Spark names its folder) a text that tells its rows; equal for
    equal rows in any order. One row per partition reaches the driver."""
    compared = [F.col(c) for c in df.columns if c not in ignoring]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *compared).cast("decimal(38,0)")).cast("string")
        for seed in (0, 1)
    ]
    digest = F.concat_ws(":", F.count(F.lit(1)), *sums).alias("digest")
    rows = df.groupBy(partition_name(column).alias("name")).agg(digest).collect()
    return {row["name"]: row["digest"] for row in rows}


def _partition_folders(spark: SparkSession, path: str, column: str) -> dict[str, tuple[str, str]]:
    """(version path, folder) per partition value below a version that was just written."""
    return {
        folder.rsplit("/", 1)[-1].split("=", 1)[1]: (path, folder)
        for folder in child_paths(spark, path)
        if folder.rsplit("/", 1)[-1].startswith(f"{column}=")
    }


@dataclass(frozen=True)
class StagedTable:
    """A version below `path`, or, if it shares folders, the `parts` (version path, folder)."""

    table: str
    path: str
    schema: T.StructType
    bytes: int | None = None
    parts: tuple[tuple[str, str], ...] | None = None
    digests: Mapping[str, str] | None = None

    def entry(self) -> dict:
        """What the log keeps of it."""
        return {
            "path": self.path,
            "schema": json.loads(self.schema.json()),
            "bytes": self.bytes,
            "parts": self.parts,
            "digests": self.digests,
        }

    @classmethod
    def of(cls, table: str, entry: dict) -> "StagedTable":
        parts = entry.get("parts")
        return cls(
            table,
            entry["path"],
            T.StructType.fromJson(entry["schema"]),
            entry["bytes"],
            None if parts is None else tuple(tuple(part) for part in parts),
            entry.get("digests"),
        )

    @property
    def column(self) -> str:
        """The partition column of a version that has parts."""
        return self.parts[0][1].rsplit("/", 1)[-1].split("=", 1)[0] if self.parts else ""

    def folders(self) -> dict[str, tuple[str, str]]:
        """(version path, folder) per partition value."""
        return {folder.rsplit("=", 1)[1]: (base, folder) for base, folder in self.parts or ()}

    def read(self, spark: SparkSession) -> DataFrame:
        """Read in the declared column order; a version without rows is empty, not an error."""
        if self.parts is None:
            rows = spark.read.schema(self.schema).parquet(self.path)
            return with_size(rows.select(*self.schema.names), self.bytes)
        # One scan per version that folders come from: at most one per partition.
        scans = []
        for base in sorted({base for base, _ in self.parts}):
            folders = [folder for of, folder in self.parts if of == base]
            scan = spark.read.schema(self.schema).option("basePath", base).parquet(*folders)
            scans.append(scan.select(*self.schema.names))
        if not scans:
            return spark.createDataFrame([], self.schema)
        return with_size(reduce(DataFrame.unionByName, scans), self.bytes)
