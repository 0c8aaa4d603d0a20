"""Entry points: load Bronze, build and check Silver and Gold, stream events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lavra.functions.times import utc_now
from lavra.operators.bucketed import forget
from lavra.operators.check_states import CheckStates
from lavra.operators.quality import run_suite
from lavra.operators.reference import KNOWN
from lavra.plans import fixed, gold, silver
from lavra.plans.checks import gold_rules, silver_rules
from lavra.runtime import bounded, narrowed, released, staging
from lavra.sources.catalog import Source
from lavra.sources.files import write_csv
from lavra.sources.ledger import (
    INGESTED_AT,
    SnapshotSize,
    append_snapshot,
    read_latest,
    stamp,
)
from lavra.sources.latest import LatestState
from lavra.sources.tables import LayerStore, Layout, StagedTable
from lavra.streaming import events
from lavra.streaming.bronze import DAY, EventTable
from lavra.streaming.ingest import ingest, parquet_sink, write_batch

SCHEMAS = {
    "ibge_municipios": fixed.PLACES_SCHEMA,
    "meta_alfabetizacao_brasil": fixed.NATION_TARGETS_SCHEMA,
    "meta_alfabetizacao_uf": fixed.STATE_TARGETS_SCHEMA,
    "meta_alfabetizacao_municipio": fixed.PLACE_TARGETS_SCHEMA,
    "avaliacao_alfabetizacao_uf": fixed.STATE_RESULTS_SCHEMA,
    "avaliacao_alfabetizacao_municipio": fixed.PLACE_RESULTS_SCHEMA,
    "dados_alunos": fixed.STUDENT_BATCH_SCHEMA,
    "dados_alunos_streaming": fixed.STUDENT_EVENT_SCHEMA,
}
STREAM_TABLE = "dados_alunos_streaming"


@dataclass(frozen=True)
class Config:
    """Root folder of all layers, on storage every executor reaches; `buckets` of the stream's
    state, see `LatestState`. With `share_years`, years whose rows are as before keep their
    folder, and with it the time at which they were processed. With `mart_buckets`, the place
    mart's inputs are joined in so many buckets."""

    root: str
    buckets: int = 64
    share_years: bool = False
    mart_buckets: int = 0

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    @property
    def rejected_events(self) -> str:
        return self.bronze(f"{STREAM_TABLE}_rejected")

    @property
    def stream_state(self) -> str:
        return f"{self.root}/state/{STREAM_TABLE}"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.root}/checkpoints/{STREAM_TABLE}"

    @property
    def history(self) -> str:
        return f"{self.root}/quality/data_quality_results"


def schema_of(table: str) -> T.StructType:
    """Declared Bronze columns, without the ingest metadata."""
    return T.StructType.fromDDL(SCHEMAS[table])


def source(table: str, format: str, location: str) -> Source:
    """A catalogue entry for one of the known Bronze tables."""
    return Source(table, format, location, schema_of(table))


def published_sources(format: str, location: str) -> list[Source]:
    """The batch sources under their published names; `location` holds `{name}`."""
    return [
        source(table, format, location.format(name=name))
        for name, table in fixed.PUBLISHED_NAMES.items()
    ]


def convert_places(
    spark: SparkSession, json_path: str, csv_path: str, format: str = "places_json"
) -> None:
    """Flatten landed place records into the CSV reference file."""
    places = source("ibge_municipios", format, json_path)
    write_csv(places.read(spark), csv_path, places.schema.names)


def build_bronze(
    spark: SparkSession,
    config: Config,
    sources: Sequence[Source],
    ingested_at: dt.datetime | None = None,
) -> dict[str, SnapshotSize]:
    """Append one snapshot per source; history is kept."""
    at = ingested_at or utc_now()
    return {
        s.table: append_snapshot(
            s.read(spark), config.bronze(s.table), at, s.location, s.schema
        )
        for s in sources
    }


def ensure_stream_table(spark: SparkSession, config: Config) -> None:
    """Create the Bronze event table with its declared columns if it is absent; events of an
    older layout become part of it."""
    event_table(spark, config).create()


def event_table(spark: SparkSession, config: Config) -> EventTable:
    return EventTable(spark, config.bronze(STREAM_TABLE), schema_of(STREAM_TABLE))


def compact_events(spark: SparkSession, config: Config) -> list[str]:
    """Merge the small files of the days that are over; returns the days."""
    return event_table(spark, config).compact()


def clean_stream(spark: SparkSession, config: Config) -> None:
    """Remove what compactions of the event table and merges of its state have replaced. Readers
    that began before those must have ended."""
    event_table(spark, config).remove_merged_sources()
    stream_state(spark, config).remove_replaced()


def stream_bronze(
    spark: SparkSession,
    config: Config,
    messages: DataFrame,
    source_name: str,
    trigger: Mapping[str, object] | None = None,
    base64: bool = False,
    written: dict[int, int] | None = None,
) -> StreamingQuery:
    """Start the append of JSON events to Bronze, at least once; see `ingest`."""
    ensure_stream_table(spark, config)
    return ingest(
        messages,
        schema_of(STREAM_TABLE),
        source_name,
        event_table(spark, config).once_per_batch(),
        parquet_sink(config.rejected_events),
        config.stream_checkpoint,
        trigger,
        base64,
        written,
    )


def ingest_event(
    spark: SparkSession,
    config: Config,
    message: str,
    source_name: str,
    writer: str,
    offset: int,
    base64: bool = False,
) -> bool:
    """Take one message, for callers that are invoked per event. Errors raise, so the bus
    delivers the message again; one that was committed is known by its `writer` (the bus's
    partition, whose offsets ascend) and `offset`, and gives False without a second commit.

    A message that cannot be decoded goes to the rejected table and counts as taken.
    """
    received = spark.createDataFrame([(message,)], f"{events.VALUE} string")
    return ingest_events(spark, config, received, source_name, writer, offset, base64)


def ingest_events(
    spark: SparkSession,
    config: Config,
    messages: DataFrame,
    source_name: str,
    writer: str,
    offset: int,
    base64: bool = False,
) -> bool:
    """Like `ingest_event` for any number of messages (`value`) that were delivered together;
    all of them are committed at once."""
    table = event_table(spark, config)
    if table.has(writer, offset):
        return False
    if base64:
        messages = events.decode_base64(messages)
    with staging(events.decode(messages, table.schema), "delivery") as decoded:
        # One instant for the delivery, in both tables.
        arrived = stamp(decoded, utc_now(), source_name)
        write_batch(events.bad(arrived), parquet_sink(config.rejected_events))
        return table.append(events.good(arrived), writer, offset)


def replay_events(
    spark: SparkSession, table: DataFrame, limit: int, format: str, location: str
) -> None:
    """Send a bounded sample of `table` as JSON messages to a topic or folder."""
    events.write_events(events.replay(table, limit), format, location)


def read_stream_table(spark: SparkSession, config: Config) -> DataFrame:
    return event_table(spark, config).read().drop(DAY)


def stream_state(spark: SparkSession, config: Config) -> LatestState:
    """The newest event per student and year, as a table that grows with the students."""
    columns = event_table(spark, config).columns
    return LatestState(
        spark, config.stream_state, columns, silver.STUDENT_KEYS, (INGESTED_AT,), config.buckets
    )


def refresh_stream_state(spark: SparkSession, config: Config) -> list[int]:
    """Bring the state up to the event table: reads the events that came since the last time,
    and the buckets that hold their students. Returns these buckets."""
    state = stream_state(spark, config)
    seen = state.log.read()
    rows, position = event_table(spark, config).read_after(state.position(seen))
    return state.merge(None if rows is None else rows.drop(DAY), position, seen)


def stage_silver(spark: SparkSession, config: Config) -> list[StagedTable]:
    """Write new versions of all Silver tables, the dimension first."""
    with released(spark):
        return _stage_silver(spark, config)


def _stage_silver(spark: SparkSession, config: Config) -> list[StagedTable]:
    ensure_stream_table(spark, config)
    store = LayerStore(spark, config.root)
    staged: dict[str, StagedTable] = {}

    def bronze(table: str) -> DataFrame:
        return read_latest(spark, config.bronze(table), schema_of(table))

    def stage(table: str, df: DataFrame) -> DataFrame:
        staged[table] = _stage(store, config, df, "silver", table, silver.LAYOUTS[table])
        return staged[table].read(spark)

    places = stage("dim_localidades", silver.places(bronze("ibge_municipios")))
    dim = bounded(narrowed(places.select("id_municipio", "sigla_uf"), places))
    stage(
        "meta_alfabetizacao_brasil", silver.nation_targets(bronze("meta_alfabetizacao_brasil"))
    )
    stage("meta_alfabetizacao_uf", silver.state_targets(bronze("meta_alfabetizacao_uf")))
    stage("avaliacao_alfabetizacao_uf", silver.state_results(bronze("avaliacao_alfabetizacao_uf")))
    for table, plan in (
        ("meta_alfabetizacao_municipio", silver.place_targets),
        ("avaliacao_alfabetizacao_municipio", silver.place_results),
    ):
        raw = bronze(table)
        stage(table, plan(raw, dim))
        stage(f"quarentena_{table}", silver.rejected(raw, dim))
    refresh_stream_state(spark, config)
    for table, latest in (
        ("dados_alunos", silver.latest_students(bronze("dados_alunos"))),
        (STREAM_TABLE, stream_state(spark, config).read()),
    ):
        # Ranked and joined once, written once, each half read from its own folder.
        marked = silver.marked_students(latest, dim)
        with staging(marked, table, [KNOWN]) as written:
            valid, rejected = silver.split_students(written)
            stage(table, valid)
            stage(f"quarentena_{table}", rejected)
    return list(staged.values())


def _stage(
    store: LayerStore, config: Config, df: DataFrame, layer: str, table: str, layout: Layout
) -> StagedTable:
    if config.share_years and layout.partition:
        return store.stage_changed(df, layer, table, layout, [silver.PROCESSED_AT])
    return store.stage(df, layer, table, layout)


def stage_gold(
    spark: SparkSession, config: Config, tables: Mapping[str, DataFrame] | None = None
) -> list[StagedTable]:
    """Write new versions of all marts from the published (or given) Silver tables."""
    with released(spark):
        try:
            return _stage_gold(spark, config, tables)
        finally:
            forget(spark)


def _stage_gold(
    spark: SparkSession, config: Config, tables: Mapping[str, DataFrame] | None
) -> list[StagedTable]:
    store = LayerStore(spark, config.root)
    t = tables or store.current("silver")
    dim = t["dim_localidades"]
    with staging(gold.student_components(t["dados_alunos"]), "components") as parts:
        marts = {
            "mart_comparativo_municipio": gold.place_mart(
                parts,
                t["avaliacao_alfabetizacao_municipio"],
                t["meta_alfabetizacao_municipio"],
                dim,
                config.mart_buckets,
            ),
            "mart_comparativo_uf": gold.state_mart(
                parts, t["avaliacao_alfabetizacao_uf"], t["meta_alfabetizacao_uf"], dim
            ),
            "mart_comparativo_brasil": gold.nation_mart(parts, t["meta_alfabetizacao_brasil"]),
            "mart_frescor_streaming": gold.freshness_mart(t[STREAM_TABLE], t["dados_alunos"]),
        }
        return [
            _stage(store, config, mart, "gold", name, gold.LAYOUTS[name])
            for name, mart in marts.items()
        ]


def build_silver(spark: SparkSession, config: Config) -> None:
    """Build and publish Silver without checking it."""
    _publish(spark, config, "silver", stage_silver, check=False)


def build_gold(spark: SparkSession, config: Config) -> None:
    """Build and publish Gold without checking it."""
    _publish(spark, config, "gold", stage_gold, check=False)


def validate(
    spark: SparkSession,
    config: Config,
    layer: str,
    tables: Mapping[str, DataFrame] | None = None,
) -> list[Row]:
    """Run the suite of a layer on its published (or given) tables and record the results."""
    rules = {"silver": silver_rules, "gold": gold_rules}[layer]()
    t = tables or LayerStore(spark, config.root).current(layer)
    return run_suite(spark, layer, t, rules, config.history)


def run_silver(spark: SparkSession, config: Config) -> list[Row]:
    """Stage, check, publish: a critical violation leaves the old tables in place, and so does
    another publication since the build began (`CommitConflict`)."""
    return _publish(spark, config, "silver", stage_silver)


def run_gold(spark: SparkSession, config: Config) -> list[Row]:
    return _publish(spark, config, "gold", stage_gold)


def _publish(
    spark: SparkSession,
    config: Config,
    layer: str,
    stage: Callable[[SparkSession, Config], list[StagedTable]],
    check: bool = True,
) -> list[Row]:
    store = LayerStore(spark, config.root)
    before = store.version(layer)
    staged = stage(spark, config)
    try:
        results = []
        if check:
            results = _check(spark, config, layer, staged)
        store.publish(layer, staged, before)
    except Exception:
        store.discard(staged)
        raise
    return results


def _check(
    spark: SparkSession, config: Config, layer: str, staged: Sequence[StagedTable]
) -> list[Row]:
    """The suite of a layer on staged tables. With `share_years`, counts of unchanged years are
    taken from the last runs."""
    tables = {s.table: s.read(spark) for s in staged}
    if not config.share_years:
        return validate(spark, config, layer, tables)
    rules = {"silver": silver_rules, "gold": gold_rules}[layer]()
    states, by_name = CheckStates(spark, f"{config.history}_states"), {s.table: s for s in staged}
    return run_suite(
        spark,
        layer,
        tables,
        rules,
        config.history,
        lambda name, own: states.evaluate(by_name[name], own, tables),
    )
