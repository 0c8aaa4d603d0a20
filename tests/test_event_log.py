"""The commit log, the event table on it, and the newest-row state that follows the table."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from lavra.operators.dedup import latest_by
from lavra.plans import runs
from lavra.runtime import create_absent, read_text
from lavra.sources.latest import LatestState
from lavra.sources.log import FULL_EVERY, CommitConflict, CommitLog
from lavra.streaming.bronze import EventTable
from lavra.streaming.ingest import OncePerBatch, ingest, parquet_sink, run_bounded
from lavra.streaming.segments import acknowledged, publish, read_segments

SCHEMA = T.StructType([T.StructField("ano", T.LongType()), T.StructField("id", T.StringType())])
FULL = "ano bigint, id string, _ingested_at timestamp, _source_file string"


def at(day, hour=12):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


@pytest.fixture
def arrived(table):
    """Events with these ids, arrived on a day."""

    def make(ids, day, ano=2024):
        return table(FULL, *[(ano, str(i), at(day), "s") for i in ids])

    return make


@pytest.fixture
def events(spark, folder):
    return EventTable(spark, f"{folder}/t", SCHEMA)


def ids(df):
    return sorted(int(r["id"]) for r in df.collect())


def counter(spark, folder):
    return CommitLog(spark, f"{folder}/log", lambda s, c, n: {"sum": s["sum"] + c["add"], "at": n}, {"sum": 0})


# The log.


def test_one_writer_gets_each_number(spark, folder):
    log = counter(spark, folder)
    assert log.read().number == 0 and not log.exists()
    seen = log.read()
    assert log.commit(seen, {"add": 1}).state == {"sum": 1, "at": 1}
    with pytest.raises(CommitConflict):
        log.commit(seen, {"add": 5})
    assert log.read().state == {"sum": 1, "at": 1}


def test_concurrent_updates_are_all_there(spark, folder):
    log = counter(spark, folder)

    def work():
        for _ in range(8):
            log.update(lambda seen: {"add": 1})

    threads = [threading.Thread(target=work) for _ in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    # Whole states were written on the way, and entries before them may go.
    assert log.read().state == {"sum": 48, "at": 48} and 48 > FULL_EVERY
    for _ in range(2 * FULL_EVERY):
        log.update(lambda seen: {"add": 1})
    log.trim()
    assert len(os.listdir(log.path)) <= 2 * FULL_EVERY + 4
    assert log.read().state["sum"] == 48 + 2 * FULL_EVERY


def test_nothing_to_do_commits_nothing(spark, folder):
    log = counter(spark, folder)
    assert log.update(lambda seen: None).number == 0 and log.read().number == 0


def test_create_absent_never_replaces(spark, folder):
    assert create_absent(spark, f"{folder}/new/x", "é") and not create_absent(spark, f"{folder}/new/x", "b")
    assert read_text(spark, f"{folder}/new/x") == "é" and os.listdir(f"{folder}/new") == ["x"]
    uri = f"file://{folder}/new/y"
    assert create_absent(spark, uri, "1") and not create_absent(spark, uri, "2")


# The event table.


def test_table_is_created_empty(events, rows):
    events.create()
    events.create()
    assert rows(events.read()) == [] and events.version() == 1
    assert events.read().columns == ["ano", "id", "_ingested_at", "_source_file", "_arrival_day"]


def test_events_of_the_first_layout_stay(spark, events, arrived):
    """Files in the table's root, then folders per day, then the log."""
    arrived(range(100), 1).repartition(3).write.parquet(events.path)
    assert ids(events.read()) == list(range(100))
    events.sink()(arrived(range(100, 110), 2))
    assert ids(events.read()) == list(range(110))
    assert events.compact(dt.date(2024, 1, 1)) == ["2024-01-01"]
    assert ids(events.read()) == list(range(110))
    events.remove_merged_sources()
    assert ids(events.read()) == list(range(110)) and len(events.parts()) == 2


def test_events_of_the_second_layout_stay(spark, events, arrived):
    """Day folders, some merged elsewhere, with and without their small files."""
    day = "_arrival_day"

    def small(n, of):
        dated = arrived(n, of).selectExpr("*", f"'2024-01-0{of}' AS {day}")
        dated.write.mode("append").partitionBy(day).parquet(events.path)

    merged = f"{events.path}__merged/v-1"
    small([1, 2], 1)
    small([3, 4], 2)
    for path in (events.path, merged):
        assert path
    spark.read.parquet(events.path).write.partitionBy(day).parquet(merged)
    listed = [("2024-01-01", merged), ("2024-01-02", merged)]
    spark.createDataFrame(listed, "day string, path string").write.json(f"{events.path}__merged_days")
    shutil.rmtree(f"{events.path}/{day}=2024-01-02")
    # Late events: beside the small files of day 1, and where those of day 2 were removed.
    small([5], 1)
    small([6], 2)
    small([7], 3)
    assert ids(events.read()) == [1, 2, 3, 4, 5, 6, 7]
    events.sink()(arrived([8], 3))
    assert events.compact(dt.date(2024, 1, 5)) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    events.remove_merged_sources()
    assert ids(events.read()) == list(range(1, 9)) and len(events.parts()) == 3


def test_late_events_of_a_merged_day_stay(events, arrived):
    for n in range(2):
        events.append(arrived([n], 1))
    assert events.compact(dt.date(2024, 1, 2)) == ["2024-01-01"]
    events.append(arrived(range(2, 9), 1))
    assert ids(events.read()) == list(range(9))
    assert events.remove_merged_sources() == ["2024-01-01"]
    assert ids(events.read()) == list(range(9))
    assert events.compact(dt.date(2024, 1, 2)) == ["2024-01-01"]
    assert events.remove_merged_sources() == ["2024-01-01"] and events.remove_merged_sources() == []
    assert ids(events.read()) == list(range(9)) and len(events.parts()) == 1


def test_append_during_a_compaction(events, arrived, monkeypatch):
    """An event that is committed after the compaction has read stays in its own part."""
    for n in range(3):
        events.append(arrived([n], 1))
    read = EventTable._read

    def late(self, parts):
        monkeypatch.setattr(EventTable, "_read", read)
        events.append(arrived([99], 1))
        return read(self, parts)

    monkeypatch.setattr(EventTable, "_read", late)
    assert events.compact(dt.date(2024, 1, 2)) == ["2024-01-01"]
    events.remove_merged_sources()
    assert ids(events.read()) == [0, 1, 2, 99] and len(events.parts()) == 2


def test_of_two_compactions_one_counts(events, arrived, monkeypatch):
    for n in range(3):
        events.append(arrived([n], 1))
    read = EventTable._read

    def other(self, parts):
        monkeypatch.setattr(EventTable, "_read", read)
        assert events.compact(dt.date(2024, 1, 2)) == ["2024-01-01"]
        return read(self, parts)

    monkeypatch.setattr(EventTable, "_read", other)
    assert events.compact(dt.date(2024, 1, 2)) == []
    events.remove_merged_sources()
    assert ids(events.read()) == [0, 1, 2]


def test_concurrent_appends(events, arrived):
    """Writers share no folder, so none removes what another is writing."""
    frames = [arrived([n], 1 + n % 2) for n in range(6)]
    threads = [threading.Thread(target=events.append, args=(frame,)) for frame in frames]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert ids(events.read()) == list(range(6))


def test_failed_append_is_not_seen(events, arrived, monkeypatch):
    events.append(arrived([1], 1))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "update", lambda *_: (_ for _ in ()).throw(ConnectionError()))
        with pytest.raises(ConnectionError):
            EventTable.append(events, arrived([2], 1))
    # `create` failed first; now one that fails after its files were written.
    commit = CommitLog.commit

    def failing(self, seen, change):
        if change["kind"] == "append":
            raise ConnectionError
        return commit(self, seen, change)

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", failing)
        with pytest.raises(ConnectionError):
            events.append(arrived([3], 1))
    assert ids(events.read()) == [1]
    assert len(events.remove_unlisted()) == 1 and events.remove_unlisted() == []
    assert ids(events.read()) == [1]


def test_batches_are_taken_once(events, arrived, table):
    assert events.append(arrived([1], 1), "w", 0)
    assert not events.append(arrived([1], 1), "w", 0)
    assert events.append(arrived([2], 1), "v", 0)
    assert events.append(table(FULL), "w", 1) and events.has("w", 1) and not events.has("w", 2)
    assert events.append(arrived([3], 1), "w", 5)
    assert not events.append(arrived([1], 1), "w", 1)
    assert ids(events.read()) == [1, 2, 3]
    assert events.compact(dt.date(2024, 1, 2)) and events.has("w", 5)


def test_days_prune(events, arrived):
    for day in (1, 2, 3):
        events.append(arrived([day], day))
    assert ids(events.read(days=["2024-01-02"])) == [2]
    assert len(events.read(days=["2024-01-02"]).inputFiles()) == 1
    version = events.version()
    events.append(arrived([9], 1))
    assert ids(events.read(after=version)) == [9]
    assert events.read_after(events.version())[0] is None


# The newest row per key.


@pytest.fixture
def state(spark, folder, events):
    return LatestState(spark, f"{folder}/state", events.columns, ("id",), ("_ingested_at",), 4)


def refresh(events, state):
    new, position = events.read_after(state.position())
    return state.merge(new, position)


def test_state_equals_a_ranking_of_everything(events, state, arrived, rows, table):
    draw = random.Random(1)
    for day in range(1, 7):
        events.append(arrived([draw.randrange(30) for _ in range(40)], day, ano=draw.randrange(9)))
        # Ties, late arrivals, and a missing key.
        late = [(draw.randrange(9), None if i % 7 == 0 else str(i), at(max(1, day - 3)), "late") for i in range(9)]
        events.append(table(FULL, *late, late[0]))
        refresh(events, state)
        if day % 2 == 0:
            events.compact(dt.date(2024, 1, day))
            events.remove_merged_sources()
            state.remove_replaced()
        whole = latest_by(events.read().drop("_arrival_day"), ["id"], ["_ingested_at"])
        assert rows(state.read()) == rows(whole)


def test_merge_reads_no_old_day_and_few_buckets(spark, events, state, arrived):
    events.append(arrived(range(40), 1))
    assert refresh(events, state) == [0, 1, 2, 3]
    assert refresh(events, state) == []
    old = events.parts()[0].path
    shutil.rmtree(old)
    kept = {b: path for b, path in state.log.read().state["paths"].items()}
    events.append(arrived([7], 2, ano=1))
    (touched,) = refresh(events, state)
    paths = state.log.read().state["paths"]
    assert [b for b in paths if paths[b] != kept[b]] == [str(touched)]
    assert ids(state.read()) == list(range(40))
    assert [r["ano"] for r in state.read().where("id = '7'").collect()] == [1]


def test_merges_of_two_writers_conflict(events, state, arrived):
    events.append(arrived(range(4), 1))
    seen = state.log.read()
    rows, position = events.read_after(state.position(seen))
    state.merge(rows, position, seen)
    with pytest.raises(CommitConflict):
        state.merge(rows, position, seen)
    assert ids(state.read()) == list(range(4))


def test_state_before_any_event(events, state, rows):
    assert rows(state.read()) == [] and state.position() is None
    assert refresh(events, state) == [] and rows(state.read()) == []


def test_silver_reads_new_events_only(spark, folder, table):
    """The state behind the Silver tables, through the run's own configuration."""
    config = runs.Config(folder, buckets=4)
    for offset, place in enumerate(["1", "2"]):
        message = '{"id_aluno": "a", "ano": 2024, "id_municipio": "%s"}' % place
        assert runs.ingest_event(spark, config, message, "bus", "p0", offset)
        assert runs.refresh_stream_state(spark, config)
    assert runs.refresh_stream_state(spark, config) == []
    (row,) = runs.stream_state(spark, config).read().collect()
    assert row["id_municipio"] == "2"
    assert runs.read_stream_table(spark, config).count() == 2


# Messages one by one, and a source that is told what was finished.


def test_event_by_event(spark, folder, rows):
    import base64

    config = runs.Config(folder)
    good, bad = '{"id_aluno": "é", "ano": "2024"}', "no json"
    wrapped = base64.b64encode(good.encode()).decode()
    assert runs.ingest_event(spark, config, good, "bus", "p0", 0)
    assert not runs.ingest_event(spark, config, good, "bus", "p0", 0)
    assert runs.ingest_event(spark, config, wrapped, "bus", "p1", 0, base64=True)
    assert runs.ingest_event(spark, config, bad, "bus", "p0", 1)
    assert not runs.ingest_event(spark, config, bad, "bus", "p0", 1)
    table = runs.read_stream_table(spark, config)
    assert rows(table, "id_aluno", "ano", "_source_file") == [("é", 2024, "bus")] * 2
    assert rows(spark.read.parquet(config.rejected_events), "_message") == [("no json",)]


def test_event_that_cannot_be_written_raises(spark, folder):
    os.makedirs(f"{folder}/bronze")
    with open(f"{folder}/bronze/{runs.STREAM_TABLE}", "w") as file:
        file.write("not a folder")
    with pytest.raises(Exception):
        runs.ingest_event(spark, runs.Config(folder), "{}", "bus", "p0", 0)


def messages(table, values):
    return table("value string", *[('{"id": "%s", "ano": 1}' % v,) for v in values])


@pytest.mark.parametrize("after_writing", [False, True])
def test_failed_batch_is_not_acknowledged(spark, folder, table, events, after_writing):
    """The sink fails before or after its write; the restarted stream delivers the batch again
    and nothing is lost or twice."""
    topic = f"{folder}/topic"
    assert publish(messages(table, range(5)), topic) == 1
    calls = []

    def failing(rows, writer, batch):
        calls.append(batch)
        if after_writing:
            events.append(rows, writer, batch)
        raise ConnectionError("down")

    def start(sink):
        stream = read_segments(spark, topic, "silver")
        return ingest(stream, SCHEMA, "bus", sink, parquet_sink(f"{folder}/bad"), f"{folder}/checkpoint")

    with pytest.raises(StreamingQueryException):
        start(OncePerBatch(failing)).awaitTermination()
    assert calls == [0] and acknowledged(topic, "silver") == 0
    assert publish(messages(table, range(5, 8)), topic) == 2
    start(events.once_per_batch()).awaitTermination()
    assert ids(events.read()) == list(range(8))
    # Spark tells the source of a finished batch when it plans the next one.
    assert acknowledged(topic, "silver") == 1 and acknowledged(topic, "other") == 0
    publish(messages(table, []), topic)
    start(events.once_per_batch()).awaitTermination()
    assert ids(events.read()) == list(range(8)) and acknowledged(topic, "silver") == 2


def test_plain_sink_gets_a_failed_batch_twice(spark, folder, table, events):
    topic, fails = f"{folder}/topic", iter([True])

    def sink(rows):
        events.append(rows)
        if next(fails, False):
            raise ConnectionError("written, but not confirmed")

    publish(messages(table, range(3)), topic)
    for _ in range(2):
        stream = read_segments(spark, topic)
        query = ingest(stream, SCHEMA, "bus", sink, parquet_sink(f"{folder}/bad"), f"{folder}/checkpoint")
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
    assert ids(events.read()) == [0, 0, 1, 1, 2, 2]


def test_segments_bound_batches(spark, folder, table, events):
    topic = f"{folder}/topic"
    for n in range(5):
        publish(messages(table, range(10 * n, 10 * n + 10)).repartition(2), topic)
    written = {}
    query = ingest(
        read_segments(spark, topic, "g", most=2),
        SCHEMA,
        "bus",
        events.once_per_batch(),
        parquet_sink(f"{folder}/bad"),
        f"{folder}/checkpoint",
        {"processingTime": "0 seconds"},
        written=written,
    )
    assert run_bounded(query, 50, 120, 0.2, written) == 50
    assert sorted(written.values()) == [10, 20, 20]
    assert ids(events.read()) == list(range(50))


def test_segment_with_long_odd_and_no_lines(spark, folder, table, rows):
    values = ["x" * 3_000_000, "", "é中", "a\tb"]
    topic = f"{folder}/topic"
    publish(table("value string", *[(v,) for v in values]).coalesce(1), topic)
    publish(table("value string"), topic)
    query = (
        read_segments(spark, topic)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/c")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out")) == sorted((v,) for v in values)
