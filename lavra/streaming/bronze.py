"""The Bronze event table: immutable parts, and a log that says which of them are the table.

An append writes a folder of its own, with a folder per arrival day inside, and one log entry
then makes these parts the table's. A compaction rewrites the parts of closed days into few
large ones, and one entry replaces exactly the parts it has read: an event that arrives
meanwhile, or later with an old arrival day, is in another part and stays. Readers take the
parts that the log names and never look for files.

Each part keeps the numbers of the first and last commit whose events it holds, so a reader
that remembers a commit finds all that came after it, compacted or not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.runtime import child_paths, file_times, path_exists, remove
from lavra.session import require_utc
from lavra.sources.ledger import INGESTED_AT, SOURCE_FILE
from lavra.sources.log import CommitLog, Version, fresh_name
from lavra.streaming.ingest import OncePerBatch, Sink

DAY = "_arrival_day"
_COMMIT = "_commit"
_LOG = "_log"
# What an older layout put behind the path for its list of merged days.
_OLD_LIST = "__merged_days"


@dataclass(frozen=True)
class Part:
    """Files of one arrival day, or of any days (`day` is None) if they lie in no day folder.

    `base` is the folder whose subfolders name the day; `path` is what is read.
    """

    path: str
    base: str
    day: str | None
    first: int
    last: int


def _fold(state: dict, change: dict, number: int) -> dict:
    """The live parts after a commit, and per writer the newest batch that it has written."""
    gone = set(change.get("remove", ()))
    live = [part for part in state["parts"] if part["path"] not in gone]
    added = [{"first": number, "last": number, **part} for part in change.get("add", ())]
    batches = {**state["batches"], **change.get("batches", {})}
    dropped = [path for path in state["dropped"] if path not in change.get("erased", ())]
    dropped += [path for path in change.get("remove", ())]
    return {"parts": live + added, "batches": batches, "dropped": dropped}


_EMPTY = {"parts": [], "batches": {}, "dropped": []}


@dataclass(frozen=True)
class EventTable:
    """Events of `schema` with the ingest metadata, below `path`."""

    spark: SparkSession
    path: str
    schema: T.StructType

    @property
    def root(self) -> str:
        return self.path.rstrip("/")

    @property
    def columns(self) -> T.StructType:
        meta = [(INGESTED_AT, T.TimestampType()), (SOURCE_FILE, T.StringType())]
        return T.StructType([*self.schema.fields, *[T.StructField(*field) for field in meta]])

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{_LOG}", _fold, _EMPTY)

    def create(self) -> Version:
        """Make the table if it has no log yet, and return its newest version. Events that an
        older layout left below `path` become parts where they lie."""

        def first(seen: Version) -> dict | None:
            return None if seen.number else {"kind": "create", "add": self._found_parts()}

        return self.log.update(first)

    def append(self, df: DataFrame, writer: str | None = None, batch: int | None = None) -> bool:
        """Add the rows of `df` in one commit, by the day of their arrival time.

        With `writer` and `batch` the append happens once: if this writer has committed the
        batch or a later one, nothing is written and the result is False. Batches of a writer
        come in ascending order. Without them every call adds its rows.
        """
        require_utc(self.spark)
        if self._has(self.create(), writer, batch):
            return False
        name = f"{_COMMIT}={fresh_name()}"
        dated = df.withColumn(DAY, F.date_format(INGESTED_AT, "yyyy-MM-dd"))
        dated.write.partitionBy(DAY).parquet(f"{self.root}/{name}")
        added = self._parts_of(name)

        def change(seen: Version) -> dict | None:
            if self._has(seen, writer, batch):
                return None
            batches = {} if writer is None else {writer: batch}
            return {"kind": "append", "add": added, "batches": batches}

        seen = self.log.update(change)
        if added and added[0]["path"] not in {part["path"] for part in seen.state["parts"]}:
            # The same batch, written at the same time by somebody else, was first.
            if self._has(seen, writer, batch):
                remove(self.spark, f"{self.root}/{name}")
                return False
        return True

    def has(self, writer: str, batch: int) -> bool:
        """Whether `append` would leave out this batch of the writer."""
        return self._has(self.log.read(), writer, batch)

    def sink(self) -> Sink:
        """Every call appends; the first creates the table."""

        def append(df: DataFrame) -> None:
            self.append(df)

        return append

    def once_per_batch(self) -> OncePerBatch:
        """A sink that a stream's batch reaches once, however often it is delivered."""
        return OncePerBatch(self.append)

    def read(self, days: Sequence[str] | None = None, after: int | None = None) -> DataFrame:
        """All events, with `_arrival_day`; a filter on it reads only those days' parts.

        `days` leaves out other days' parts before Spark lists them. `after` leaves out parts
        whose events were all there at that commit (see `version`): what is left holds every
        later event, and earlier ones only where a compaction has put both into one part.
        """
        return self._read(_chosen(self._live(self._state()), days, after))

    def read_after(self, after: int | None) -> tuple[DataFrame | None, int]:
        """`read(after=after)`, or None without such parts, and the commit it goes up to."""
        seen = self.log.read()
        parts = _chosen(self._live(self._state(seen)), None, after)
        return self._read(parts) if parts else None, seen.number

    def parts(self) -> list[Part]:
        """The live parts: one per append and day since the last compaction, and one per
        compacted day."""
        return self._live(self._state())

    def version(self) -> int:
        """The number of the newest commit; 0 for a table without a log."""
        return self.log.read().number

    def compact(self, before: dt.date | None = None) -> list[str]:
        """Rewrite the parts of all days before `before` (yesterday, in UTC) that have more than
        one part, or lie in an older layout; returns these days. Batches may go on meanwhile."""
        require_utc(self.spark)
        limit = (before or dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()
        live = self._live(self.create().state)
        # Files of no certain day are rewritten whole, whatever days they turn out to hold.
        loose = [part for part in live if part.day is None]
        closed = [part for part in live if part.day is not None and part.day < limit]
        by_day: dict[str, list[Part]] = {}
        for part in closed:
            by_day.setdefault(part.day, []).append(part)
        chosen = [p for parts in by_day.values() if self._worth(parts) for p in parts] + loose
        if not chosen:
            return []
        name = f"{_COMMIT}={fresh_name()}"
        rows = self._read(chosen).hint("rebalance", F.col(DAY))
        rows.write.partitionBy(DAY).parquet(f"{self.root}/{name}")
        span = {"first": min(p.first for p in chosen), "last": max(p.last for p in chosen)}
        spans = {
            day: {"first": min(p.first for p in of), "last": max(p.last for p in of)}
            for day, of in by_day.items()
        }
        added = [
            {**part, **(span if loose else spans.get(part["day"], span))}
            for part in self._parts_of(name)
        ]
        gone = [part.path for part in chosen]

        def change(seen: Version) -> dict | None:
            live = {part["path"] for part in seen.state["parts"]}
            if not live.issuperset(gone):
                return None
            return {"kind": "compact", "add": added, "remove": gone}

        seen = self.log.update(change)
        if added and added[0]["path"] not in {part["path"] for part in seen.state["parts"]}:
            # Somebody else has compacted the same parts; theirs are the table's.
            remove(self.spark, f"{self.root}/{name}")
            return []
        return sorted({part["day"] for part in added})

    def remove_merged_sources(self) -> list[str]:
        """Remove the parts that compactions have replaced, and return their days, as a step of
        its own: readers that began before the compaction must have ended."""
        dropped = self.log.read().state["dropped"]
        for path in dropped:
            remove(self.spark, path)
        if dropped:
            self.log.update(lambda seen: {"kind": "erase", "erased": dropped})
        self.log.trim()
        return sorted({_day_in(path) or path for path in dropped})

    def remove_unlisted(self) -> list[str]:
        """Remove folders of appends and compactions that never reached the log. No append or
        compaction may run meanwhile."""
        state = self.log.read().state
        used = {p["path"].split(f"{_COMMIT}=")[-1].split("/")[0] for p in state["parts"]}
        used |= {path.split(f"{_COMMIT}=")[-1].split("/")[0] for path in state["dropped"]}
        gone = [
            path
            for path in child_paths(self.spark, self.root)
            if path.rsplit("/", 1)[-1].startswith(f"{_COMMIT}=") and path.split("=")[-1] not in used
        ]
        for path in gone:
            remove(self.spark, path)
        return gone

    # --- inside

    @staticmethod
    def _has(seen: Version, writer: str | None, batch: int | None) -> bool:
        return writer is not None and seen.state["batches"].get(writer, -1) >= batch

    @staticmethod
    def _worth(parts: list[Part]) -> bool:
        return len(parts) > 1 or not _is_logged(parts[0].path)

    def _state(self, seen: Version | None = None) -> dict:
        """The log's state; for a table that has none yet, what lies below its path."""
        seen = seen or self.log.read()
        return seen.state if seen.number else _fold(_EMPTY, {"add": self._found_parts()}, 1)

    @staticmethod
    def _live(state: dict) -> list[Part]:
        return [Part(**part) for part in state["parts"]]

    def _parts_of(self, name: str) -> list[dict]:
        """A part per day folder that an append wrote; none if it had no rows."""
        folders = child_paths(self.spark, f"{self.root}/{name}")
        return [
            {"path": path, "base": self.root, "day": _day_in(path)}
            for path in sorted(folders)
            if _day_in(path)
        ]

    def _read(self, parts: Sequence[Part]) -> DataFrame:
        """One scan per layout: parts share it, however many they are."""
        full = T.StructType([*self.columns.fields, T.StructField(DAY, T.StringType())])
        scans = []
        layouts: dict[tuple[str, bool], list[str]] = {}
        for part in parts:
            if part.day is not None:
                layouts.setdefault((part.base, _is_logged(part.path)), []).append(part.path)
        for (base, _), paths in sorted(layouts.items()):
            scan = self.spark.read.schema(full).option("basePath", base).parquet(*paths)
            scans.append(scan.select(*full.names))
        loose = [part.path for part in parts if part.day is None]
        if loose:
            scan = self.spark.read.schema(self.columns).parquet(*loose)
            scans.append(scan.withColumn(DAY, F.date_format(INGESTED_AT, "yyyy-MM-dd")))
        if not scans:
            return self.spark.createDataFrame([], full)
        return reduce(DataFrame.unionByName, scans)

    def _found_parts(self) -> list[dict]:
        """What an older layout has left: files in the root, folders per day, and days that were
        merged elsewhere.

        Small files of a merged day were removed as a whole or not at all. If one is older than
        the merged files, all events of the day are in its folder, and the merged copy is left
        out; else the folder was emptied after the merge and holds what came later.
        """
        found = [
            {"path": path, "base": self.root, "day": None}
            for path, _ in file_times(self.spark, self.root)
        ]
        folders = {
            _day_in(path): path
            for path in child_paths(self.spark, self.root)
            if path.rsplit("/", 1)[-1].startswith(f"{DAY}=")
        }
        for day, path in sorted(folders.items()):
            found.append({"path": path, "base": self.root, "day": day})
        for day, base in self._old_merged():
            merged = f"{base}/{DAY}={day}"
            made = min((time for _, time in file_times(self.spark, merged)), default=None)
            times = [time for _, time in file_times(self.spark, folders[day])] if day in folders else []
            if made is not None and not any(time < made for time in times):
                found.append({"path": merged, "base": base, "day": day})
        return found

    def _old_merged(self) -> list[tuple[str, str]]:
        listed = f"{self.root}{_OLD_LIST}"
        if not path_exists(self.spark, listed):
            return []
        schema = "day string, path string"
        return sorted(tuple(r) for r in self.spark.read.schema(schema).json(listed).collect())


def _chosen(
    parts: list[Part], days: Sequence[str] | None, after: int | None
) -> list[Part]:
    return [
        part
        for part in parts
        if (after is None or part.last > after)
        and (days is None or part.day is None or part.day in days)
    ]


def _is_logged(path: str) -> bool:
    """Whether a part was written by a commit, and not found where an older layout left it."""
    return f"/{_COMMIT}=" in path


def _day_in(path: str) -> str | None:
    """The day that a path's folder names."""
    name = next((n for n in reversed(path.split("/")) if n.startswith(f"{DAY}=")), None)
    return name.split("=", 1)[1] if name else None
