"""The newest row per key, kept up to date from the rows that are new.

Rows lie in buckets by a hash of their key, a folder each. A merge ranks the new rows, reads the
buckets that hold their keys, ranks again and writes those buckets anew; one log entry replaces
them. Other buckets, and all rows that were merged before, are not read. Since the newest of the
newest is the newest of all, the state equals a ranking of everything that ever came, and rows
that come twice change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.operators.dedup import latest_by
from lavra.runtime import child_paths, remove, staging
from lavra.sources.log import CommitLog, Version, fresh_name

BUCKET = "_bucket"
_MERGE = "_merge"


def _fold(state: dict, change: dict, number: int) -> dict:
    replaced = [state["paths"][b] for b in change["paths"] if b in state["paths"]]
    dropped = [path for path in state["dropped"] if path not in change.get("erased", ())]
    return {
        "buckets": change.get("buckets", state["buckets"]),
        "position": change.get("position", state["position"]),
        "paths": {**state["paths"], **change["paths"]},
        "dropped": dropped + replaced,
    }


_EMPTY = {"buckets": None, "position": None, "paths": {}, "dropped": []}


@dataclass(frozen=True)
class LatestState:
    """Rows of `schema`, one per `keys`: the first by `newest` (descending) and then by all other
    columns, as `latest_by` ranks them. `buckets` counts for a state that does not exist yet:
    as many as make a bucket's rows fit a task's memory."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    newest: tuple[str, ...]
    buckets: int = 64

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path.rstrip('/')}/_log", _fold, _EMPTY)

    def position(self, seen: Version | None = None) -> int | None:
        """What the last merge was told of how far its source was read; None before the first."""
        return (seen or self.log.read()).state["position"]

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._read(self.log.read().state["paths"].values()).drop(BUCKET)

    def merge(self, rows: DataFrame | None, position: int, seen: Version | None = None) -> list[int]:
        """Take in `rows` (None: there are none) and remember `position`; returns the buckets
        written. Raises `CommitConflict` if somebody else has merged since `seen`."""
        seen = seen or self.log.read()
        buckets = seen.state["buckets"] or self.buckets
        if rows is None:
            if seen.state["position"] != position:
                self.log.commit(seen, {"buckets": buckets, "position": position, "paths": {}})
            return []
        name = f"{_MERGE}={fresh_name()}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
        newest = self._latest(rows.select(*self.schema.names)).withColumn(BUCKET, bucket)
        with staging(newest, "latest", [BUCKET]) as fresh:
            # Not more rows than there are buckets.
            touched = sorted(row[0] for row in fresh.select(BUCKET).distinct().collect())
            known = [path for b, path in seen.state["paths"].items() if int(b) in set(touched)]
            whole = self._latest(fresh.unionByName(self._read(known)), BUCKET)
            spread = whole.hint("rebalance", F.col(BUCKET))
            spread.write.partitionBy(BUCKET).parquet(f"{self.path.rstrip('/')}/{name}")
        paths = {
            path.rsplit("=", 1)[1]: path
            for path in child_paths(self.spark, f"{self.path.rstrip('/')}/{name}")
            if path.rsplit("/", 1)[-1].startswith(f"{BUCKET}=")
        }
        self.log.commit(seen, {"buckets": buckets, "position": position, "paths": paths})
        return touched

    def remove_replaced(self) -> int:
        """Remove the folders of buckets that later merges have replaced; their number. Readers
        that began before those merges must have ended."""
        dropped = self.log.read().state["dropped"]
        for path in dropped:
            remove(self.spark, path)
        if dropped:
            self.log.update(lambda seen: {"paths": {}, "erased": dropped})
        self.log.trim()
        return len(dropped)

    def _latest(self, rows: DataFrame, *more: str) -> DataFrame:
        ties = [c for c in self.schema.names if c not in self.keys and c not in self.newest]
        return latest_by(rows, [*self.keys, *more], list(self.newest), ties)

    def _read(self, paths: Sequence[str]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], full)
        base = self.path.rstrip("/")
        scan = self.spark.read.schema(full).option("basePath", base).parquet(*paths)
        return scan.select(*full.names)
