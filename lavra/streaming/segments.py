"""A message source with offsets and acknowledgement, for topics that lie in files.

A topic is a folder of numbered segments, each a folder of text files with a message per line.
A publication becomes the next segment once all its files are written. A stream reads whole
segments: its offset is the number of the last one. What a stream has finished is written
beside the topic, after Spark has committed it: a batch whose sink failed is not acknowledged
and comes again.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lavra.runtime import child_paths, move_absent
from lavra.sources.log import fresh_name

FORMAT = "message_segments"
_ACKS = "_acks"
# Messages of a batch that a task hands to Spark at once.
_ROWS = 10_000

# The reader runs in Spark's Python processes, which may not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def publish(messages: DataFrame, topic: str) -> int:
    """Add all `messages` (`value`) as the next segment and return its number. One publisher at
    a time; a publication that fails leaves no segment."""
    spark, topic = messages.sparkSession, topic.rstrip("/")
    draft = f"{topic}/_draft-{fresh_name()}"
    messages.select("value").write.text(draft)
    taken = [int(name) for path in child_paths(spark, topic) if (name := path.rsplit("/", 1)[-1]).isdigit()]
    number = max(taken, default=0) + 1
    move_absent(spark, draft, f"{topic}/{number:012d}")
    return number


def acknowledged(topic: str, group: str) -> int:
    """The last segment that the streams of `group` have finished; 0 for none."""
    system, root = fs.FileSystem.from_uri(topic)
    path = f"{root.rstrip('/')}/{_ACKS}/{group}.json"
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return 0
    with system.open_input_stream(path) as file:
        return json.loads(file.read())["segment"]


@dataclass
class _File(InputPartition):
    path: str


class SegmentReader(DataSourceStreamReader):
    """Options: `path` (the topic), `group` (whose acknowledgements are written; none without),
    `maxSegmentsPerTrigger` (for continuous runs; all that is there without it)."""

    def __init__(self, options: dict[str, str]):
        self.topic, self.group = options["path"], options.get("group")
        self.most = int(options.get("maxSegmentsPerTrigger", 0))
        self.told = None

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def latestOffset(self) -> dict:
        last = max((n for n, _ in self._segments()), default=0)
        if self.most:
            # Before the first call, a restarted stream's place is what it has acknowledged.
            before = self.told
            if before is None:
                before = acknowledged(self.topic, self.group) if self.group else 0
            last = min(last, before + self.most)
        self.told = last
        return {"segment": last}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        system, _ = fs.FileSystem.from_uri(self.topic)
        self.told = max(self.told or 0, end["segment"])
        return [
            _File(info.path)
            for number, folder in self._segments()
            if start["segment"] < number <= end["segment"]
            for info in system.get_file_info(fs.FileSelector(folder))
            if info.is_file and not info.base_name.startswith(("_", ".")) and info.size
        ]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.topic)
        lines: list[bytes] = []
        with system.open_input_stream(partition.path) as file:
            rest = b""
            while block := file.read(1 << 20):
                *whole, rest = (rest + block).split(b"\n")
                lines += whole
                if len(lines) >= _ROWS:
                    yield _batch(lines)
                    lines = []
        yield _batch([*lines, rest] if rest else lines)

    def commit(self, end: dict) -> None:
        """Spark has written and committed everything up to `end`."""
        if not self.group:
            return
        system, root = fs.FileSystem.from_uri(self.topic)
        folder = f"{root.rstrip('/')}/{_ACKS}"
        system.create_dir(folder)
        draft = f"{folder}/.{self.group}-{fresh_name()}"
        with system.open_output_stream(draft) as file:
            file.write(json.dumps(end).encode())
        system.move(draft, f"{folder}/{self.group}.json")

    def _segments(self) -> list[tuple[int, str]]:
        system, root = fs.FileSystem.from_uri(self.topic)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted((int(one.base_name), one.path) for one in found if one.base_name.isdigit())


def _batch(lines: list[bytes]) -> pa.RecordBatch:
    texts = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
    return pa.RecordBatch.from_arrays([texts], names=["value"])


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)


def read_segments(
    spark: SparkSession, topic: str, group: str | None = None, most: int | None = None
) -> DataFrame:
    """A stream of the topic's messages in the column `value`, from the first segment on.

    A run that takes what is there and stops (`availableNow`) then also goes on after a batch
    that it had to repeat; this sets `spark.sql.streaming.triggerAvailableNowWrapper.enabled`
    in the session.
    """
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(FORMAT).option("path", topic)
    if group is not None:
        reader = reader.option("group", group)
    if most is not None:
        reader = reader.option("maxSegmentsPerTrigger", most)
    return reader.load()
