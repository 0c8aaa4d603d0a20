"""Streaming append into Bronze."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lavra.runtime import read_text
from lavra.streaming import events

# Writes the rows; False says that they were left out.
Sink = Callable[[DataFrame], bool | None]


@dataclass(frozen=True)
class OncePerBatch:
    """A sink that is told which stream a batch comes from and the batch's number, and that
    leaves out a batch it has: `append(rows, writer, batch)`."""

    append: Callable[[DataFrame, str, int], bool]

    def of(self, writer: str, batch: int) -> Sink:
        return lambda df: self.append(df, writer, batch)


BATCH_OPTIONS = {
    "kafka": {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000000"},
    "files": {"maxBytesPerTrigger": str(10 << 30)},
}
# Spark takes one of these for files.
_FILE_BOUNDS = ("maxfilespertrigger", "maxbytespertrigger")


def read_stream(
    spark: SparkSession, format: str, location: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Messages in the column `value`: from Kafka topics, or text files in tests.

    Unless `options` say otherwise, the first start reads a topic from its earliest offset, so
    nothing published before is skipped, and a micro-batch is bounded by `BATCH_OPTIONS`: in
    messages for a topic, in bytes for files, whose sizes differ more than their number tells.
    The bound only sizes batches: what is left comes in the next ones, and a file beyond it
    comes alone. `maxFilesPerTrigger` bounds the number of files instead.
    """
    defaults = dict(BATCH_OPTIONS["kafka" if format == "kafka" else "files"])
    if any(name.lower() in _FILE_BOUNDS for name in options or {}):
        defaults.pop("maxBytesPerTrigger", None)
    reader = spark.readStream.format(format).options(**{**defaults, **dict(options or {})})
    if format == "kafka":
        return reader.option("subscribe", location).load().select(F.col("value").cast("string"))
    return reader.load(location)


def parquet_sink(path: str) -> Sink:
    """Append to a Parquet table; the first append creates it."""
    return lambda df: df.write.mode("append").parquet(path)


def write_batch(batch: DataFrame, sink: Sink) -> int:
    """Append one micro-batch and return the rows written; an empty batch writes nothing, and
    neither does a sink that has the batch already.

    A failing sink raises. Spark commits the offsets of a batch only after this returns, so
    the whole batch is then delivered again: nothing is lost, duplicates are possible.
    """
    if batch.isEmpty():
        return 0
    written = Observation("written")
    if sink(batch.observe(written, F.count(F.lit(1)).alias("row_count"))) is False:
        return 0
    return written.get["row_count"]


def ingest(
    messages: DataFrame,
    schema: T.StructType,
    source: str,
    sink: Sink | OncePerBatch,
    bad_sink: Sink,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    base64: bool = False,
    written: dict[int, int] | None = None,
) -> StreamingQuery:
    """Decode, coerce and stamp messages, and append good and bad ones to their tables.

    Duplicates stay: Silver keeps the latest event per key. The default trigger drains what
    is available and stops; pass `{"processingTime": ...}` for a continuous run. `base64`
    unwraps messages first. `written` receives the good rows written per batch.

    A batch that was written and then fails before its offsets are committed is delivered
    again. A plain sink then appends it twice; a `OncePerBatch` sink knows it by the identity
    of the checkpoint and the batch's number, and leaves it out.
    """
    if base64:
        messages = events.decode_base64(messages)
    arrived = events.arrive(events.decode(messages, schema), source)

    def append(batch: DataFrame, batch_id: int) -> None:
        # One decoding for both tables; lost blocks are decoded again.
        batch = batch.persist()
        try:
            write_batch(events.bad(batch), bad_sink)
            own = sink
            if isinstance(sink, OncePerBatch):
                own = sink.of(stream_id(batch.sparkSession, checkpoint), batch_id)
            rows = write_batch(events.good(batch), own)
            if written is not None:
                written[batch_id] = rows
        finally:
            batch.unpersist()

    return (
        arrived.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**dict(trigger or {"availableNow": True}))
        .start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What Spark has named the stream of a checkpoint; a new checkpoint is another stream."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def run_bounded(
    query: StreamingQuery,
    max_rows: int,
    max_seconds: float,
    poll_seconds: float = 1.0,
    written: Mapping[int, int] | None = None,
) -> int:
    """Let a query run until it wrote `max_rows`, `max_seconds` passed, or it ended. Returns the
    rows written, or read if `written` (see `ingest`) is not given; a query that failed raises.

    A batch cut off by the stop was not committed and comes again on restart.
    """
    deadline = time.monotonic() + max_seconds
    per_batch: dict[int, int] = {}
    while True:
        active = query.isActive
        if written is None:
            per_batch.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress})
        done = sum(dict(per_batch if written is None else written).values())
        if not active or done >= max_rows or time.monotonic() >= deadline:
            break
        query.awaitTermination(poll_seconds)
    failure = query.exception()
    query.stop()
    if failure is not None:
        raise failure
    return done
