"""The registered queries: every table and operator on the given data.

Each takes the session and a data folder and returns a DataFrame. Doubles that depend on
the order of addition are rounded to six places, after a shift by 1e-8 that moves them off
exact ties; processing times are left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.numbers import deviation, for_year, target_met
from lavra.functions.text import label_codes, trim_ws, upper_code
from lavra.operators import indicator, quality
from lavra.operators.check_states import CheckStates
from lavra.operators.compare import key_spine
from lavra.operators.dedup import latest_by
from lavra.operators.reconcile import mean_absolute_errors
from lavra.operators.reference import enrich, quarantine
from lavra.plans import checks, fixed, gold, runs, silver, standin
from lavra.plans.standin import Tables
from lavra.runtime import bounded, materialize, path_exists, scratch_path
from lavra.sources import catalog, files, ledger
from lavra.sources.latest import LatestState
from lavra.sources.tables import LayerStore, Layout, write_layout
from lavra.streaming import events
from lavra.streaming.bronze import EventTable
from lavra.streaming.ingest import (
    OncePerBatch,
    ingest,
    parquet_sink,
    read_stream,
    run_bounded,
)
from lavra.streaming.segments import acknowledged, publish, read_segments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_TIMES = ("_processed_at", "_quarantined_at")


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register `function` under its own name (a final underscore avoids a clash)."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Tables(spark, folder))

    QUERIES[function.__name__.rstrip("_")] = run
    return function


def rounded(col: Column) -> Column:
    return F.round(col + 1e-8, 6)


def shown(df: DataFrame) -> DataFrame:
    """Without processing times, doubles rounded."""
    return df.select(
        *[
            rounded(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
            if f.name not in _TIMES
        ]
    )


# --- Silver and Gold tables


def _dim(t: Tables) -> DataFrame:
    return silver.places(standin.places(t)).drop("_processed_at")


def _measured(df: DataFrame) -> DataFrame:
    return materialize(df, "table", measured=True)


def _small_dim(t: Tables) -> DataFrame:
    """The dimension as a written table, marked for broadcast if it is small enough."""
    return t.once("small dim", lambda: bounded(_measured(_dim(t))))


def _students(t: Tables) -> DataFrame:
    return silver.students(silver.latest_students(standin.students(t)), _small_dim(t))


def _streamed(t: Tables) -> DataFrame:
    return silver.students(silver.latest_students(standin.events(t)), _small_dim(t))


def _components(t: Tables) -> DataFrame:
    return materialize(gold.student_components(_students(t)), "components")


@query
def dim_localidades(t: Tables) -> DataFrame:
    return shown(_dim(t))


@query
def meta_alfabetizacao_brasil(t: Tables) -> DataFrame:
    return shown(silver.nation_targets(standin.nation_targets(t)))


@query
def meta_alfabetizacao_uf(t: Tables) -> DataFrame:
    return shown(silver.state_targets(standin.state_targets(t)))


@query
def meta_alfabetizacao_municipio(t: Tables) -> DataFrame:
    return shown(silver.place_targets(standin.place_targets(t), _small_dim(t)))


@query
def quarentena_meta_alfabetizacao_municipio(t: Tables) -> DataFrame:
    return shown(silver.rejected(standin.place_targets(t), _small_dim(t)))


@query
def avaliacao_alfabetizacao_uf(t: Tables) -> DataFrame:
    return shown(silver.state_results(standin.state_results(t)))


@query
def avaliacao_alfabetizacao_municipio(t: Tables) -> DataFrame:
    return shown(silver.place_results(standin.place_results(t), _small_dim(t)))


@query
def quarentena_avaliacao_alfabetizacao_municipio(t: Tables) -> DataFrame:
    return shown(silver.rejected(standin.place_results(t), _small_dim(t)))


@query
def dados_alunos(t: Tables) -> DataFrame:
    return shown(_students(t))


@query
def quarentena_dados_alunos(t: Tables) -> DataFrame:
    return shown(
        silver.rejected(silver.latest_students(standin.students(t)), _small_dim(t))
    )


@query
def dados_alunos_streaming(t: Tables) -> DataFrame:
    return shown(_streamed(t))


@query
def quarentena_dados_alunos_streaming(t: Tables) -> DataFrame:
    return shown(silver.rejected(silver.latest_students(standin.events(t)), _small_dim(t)))


@query
def mart_comparativo_municipio(t: Tables) -> DataFrame:
    dim = _small_dim(t)
    return shown(
        gold.place_mart(
            _components(t),
            _measured(silver.place_results(standin.place_results(t), dim)),
            _measured(silver.place_targets(standin.place_targets(t), dim)),
            dim,
        )
    )


@query
def mart_in_buckets(t: Tables) -> DataFrame:
    """The place mart with its inputs in buckets, joined without a shuffle."""
    dim = _small_dim(t)
    return shown(
        gold.place_mart(
            _components(t),
            _measured(silver.place_results(standin.place_results(t), dim)),
            _measured(silver.place_targets(standin.place_targets(t), dim)),
            dim,
            buckets=8,
        )
    )


@query
def mart_comparativo_uf(t: Tables) -> DataFrame:
    return shown(
        gold.state_mart(
            _components(t),
            _measured(silver.state_results(standin.state_results(t))),
            _measured(silver.state_targets(standin.state_targets(t))),
            _dim(t),
        )
    )


@query
def mart_comparativo_brasil(t: Tables) -> DataFrame:
    targets = silver.nation_targets(standin.nation_targets(t))
    return shown(gold.nation_mart(_components(t), _measured(targets)))


@query
def mart_frescor_streaming(t: Tables) -> DataFrame:
    """The arrival time stands in for the processing time, which differs in every run."""
    dim = _small_dim(t)
    latest = silver.latest_students(standin.events(t))
    side = dim.select("id_municipio", "sigla_uf")
    known = enrich(latest, side, silver.place_key(), "id_municipio")
    stream = known.withColumn("_processed_at", F.col("_ingested_at"))
    return shown(gold.freshness_mart(stream, _students(t)))


# --- Sources, sinks, ledger


@query
def scan_sources(t: Tables) -> DataFrame:
    names = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    )
    sources = [
        catalog.Source(n, "parquet", f"{t.folder}/{n}.parquet", t(n).schema) for n in names
    ]
    return catalog.row_counts((s.table, s.read(t.spark)) for s in sources)


@query
def scan_content(t: Tables) -> DataFrame:
    """Every column of every table, read whole: values that are there and their sum."""
    parts = []
    for name, columns in fixed.TEST_TABLES.items():
        table = catalog.Source(name, "parquet", f"{t.folder}/{name}.parquet", t(name).schema)
        df = table.read(t.spark)
        cells = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.count(column).alias("n_values"),
                F.sum(_content(df, column)).alias("content"),
            )
            for column in columns.split()
        ]
        parts.append(df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))
    return reduce(DataFrame.unionByName, parts).withColumn("content", rounded(F.col("content")))


def _content(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        return F.octet_length(column).cast("double")
    if kind.startswith("array"):
        return F.size(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_seconds(F.col(column).cast("timestamp")).cast("double") / 1e6
    return F.col(column).cast("double")


@query
def source_columns(t: Tables) -> DataFrame:
    """A source with a narrower type and a column more than declared, as a snapshot."""
    path, bronze = scratch_path(t.spark, "source"), scratch_path(t.spark, "bronze")
    rows = t("customer").select(
        F.upper("c_name").alias("extra"), "c_name", F.col("c_custkey").cast("int")
    )
    rows.write.parquet(path)
    declared = T.StructType.fromDDL("c_custkey bigint, c_name string")
    read = catalog.Source("customer", "parquet", path, declared).read(t.spark)
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    ledger.append_snapshot(read, bronze, at, "customer", declared)
    return t.spark.read.parquet(bronze).select("c_custkey", "c_name", "extra")


@query
def csv_text_roundtrip(t: Tables) -> DataFrame:
    """Documents with quotes, commas, backslashes, line breaks, outer blanks, empty and no text."""
    path, kind, text = scratch_path(t.spark, "csv"), F.col("doc_id") % 6, F.col("text")
    nasty = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(F.lit('say "hi", '), text, F.lit('\\ and "')))
        .when(kind == 4, F.concat(text, F.lit("\r\nnext, \n\\")))
        .otherwise(text)
    )
    rows = t("documents").select("doc_id", nasty.alias("text"))
    files.write_csv(rows, path, rows.columns)
    read = files.read_csv(t.spark, path, rows.schema, multi_line=True)
    return read.select(
        "doc_id", F.octet_length("text").alias("n_bytes"), F.md5("text").alias("digest")
    )


@query
def csv_roundtrip(t: Tables) -> DataFrame:
    customers = t("customer")
    path = scratch_path(t.spark, "csv")
    files.write_csv(customers, path, customers.columns)
    return files.read_csv(t.spark, path, customers.schema)


@query
def reference_flatten(t: Tables) -> DataFrame:
    """Customers as nested place records, through JSON, flattened, and through CSV."""
    rows = (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    region = F.struct(F.substring("r_name", 1, 2).alias("sigla"), F.col("r_name").alias("nome"))
    state = F.struct(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit("N"), "n_nationkey").alias("sigla"),
        F.col("n_name").alias("nome"),
        region.alias("regiao"),
    )
    middle = F.struct(F.struct(state.alias("UF")).alias("regiao-intermediaria"))
    nested = rows.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.lit(None).cast("string").alias("microrregiao"),
        middle.alias("regiao-imediata"),
    )
    json_path, csv_path = scratch_path(t.spark, "places"), scratch_path(t.spark, "places-csv")
    nested.write.json(json_path)
    runs.convert_places(t.spark, json_path, csv_path, "places_json_lines")
    return runs.source("ibge_municipios", "csv", csv_path).read(t.spark)


@query
def snapshot_append_counts(t: Tables) -> DataFrame:
    """Two snapshots of the orders in one append-only table, counted by snapshot."""
    path = scratch_path(t.spark, "snapshots")
    orders = t("orders")
    for day in (1, 2):
        at = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
        ledger.append_snapshot(orders, path, at, "orders", orders.schema)
    history = ledger.read_history(t.spark, path, orders.schema)
    return ledger.snapshot_counts(history).select(
        F.date_format("_ingested_at", "yyyy-MM-dd").alias("snapshot"), "row_count"
    )


@query
def snapshot_read_latest(t: Tables) -> DataFrame:
    """Finished orders, then all orders: only the newer snapshot is read."""
    path = scratch_path(t.spark, "snapshots")
    orders = t("orders")
    loads = (orders.where(F.col("o_orderstatus") == "F"), orders)
    for day, rows in enumerate(loads, start=1):
        at = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
        ledger.append_snapshot(rows, path, at, "orders", orders.schema)
    latest = ledger.read_latest(t.spark, path, orders.schema)
    return latest.groupBy("o_orderstatus", "_source_file").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.date_format(F.max("_ingested_at"), "yyyy-MM-dd").alias("snapshot"),
    )


@query
def snapshot_latest(t: Tables) -> DataFrame:
    """Days as snapshots: the events of the newest one."""
    daily = t("events").withColumn("snapshot", F.to_date("ts"))
    return ledger.latest_snapshot(daily, "snapshot").drop("snapshot")


@query
def snapshot_latest_partition(t: Tables) -> DataFrame:
    """The same on a table with a folder per snapshot, of which only the newest is read."""
    daily = t("events").withColumn("snapshot", F.to_date("ts"))
    path = scratch_path(t.spark, "daily")
    write_layout(daily, path, Layout(("snapshot",)))
    return ledger.latest_snapshot(t.spark.read.parquet(path), "snapshot").drop("snapshot")


@query
def publish_partitioned(t: Tables) -> DataFrame:
    """Stage order lines by year, publish them, and read the published table."""
    lines = t("lineitem").withColumn("ship_year", F.year("l_shipdate"))
    store = LayerStore(t.spark, scratch_path(t.spark, "store"))
    layout = Layout(("ship_year",), ("l_returnflag", "l_suppkey"))
    store.publish("silver", [store.stage(lines, "silver", "lineitem", layout)])
    published = store.current("silver")["lineitem"]
    return published.groupBy("ship_year", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), rounded(F.sum("l_quantity")).alias("quantity")
    )


@query
def publish_changed_years(t: Tables) -> DataFrame:
    """Order lines by year, published twice; the second version writes the one year that has
    changed and shares the folders of the others."""
    lines = t("lineitem").withColumn("ship_year", F.year("l_shipdate"))
    more = F.when(F.col("ship_year") == 1995, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    store = LayerStore(t.spark, scratch_path(t.spark, "store"))
    layout = Layout(("ship_year",), ("l_returnflag", "l_suppkey"))
    for version in (lines, lines.withColumn("l_quantity", more)):
        staged = store.stage_changed(version, "silver", "lineitem", layout)
        store.publish("silver", [staged], after=store.version("silver"))
    store.remove_unlisted("silver")
    return store.current("silver")["lineitem"].groupBy("ship_year", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), rounded(F.sum("l_quantity")).alias("quantity")
    )


@query
def sample_limit(t: Tables) -> DataFrame:
    """A bounded sample, with the order that makes it repeatable."""
    return t("events").orderBy("event_id").limit(500)


@query
def replay_sample(t: Tables) -> DataFrame:
    """A bounded replay as messages, read back."""
    source = t("events").select("event_id", "user_id", "event_type", "value", "props")
    sent = events.replay(source.orderBy("event_id"), 500)
    return events.good(events.decode(sent, source.schema))


# --- Projections


@query
def label_codes_(t: Tables) -> DataFrame:
    code = F.col("l_orderkey") % 8
    label = label_codes(code, fixed.NETWORK_LABELS, fixed.NETWORK_UNKNOWN)
    return t("lineitem").groupBy(code.alias("code"), label.alias("label")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )


@query
def trim_upper_codes(t: Tables) -> DataFrame:
    """Text with blanks, tabs and no-break spaces at its ends, cleaned again."""
    padded = F.concat(F.lit(" \t "), F.lower("c_mktsegment"), F.lit(" \n "))
    return t("customer").select("c_custkey", padded.alias("raw")).select(
        "c_custkey", trim_ws(F.col("raw")).alias("text"), upper_code(F.col("raw")).alias("code")
    )


@query
def target_for_year(t: Tables) -> DataFrame:
    targets = silver.place_targets(standin.place_targets(t), _small_dim(t))
    picked = for_year(F.col("ano"), fixed.TARGET_YEARS, "meta_{year}")
    return targets.select("ano", "id_municipio", "rede", picked.alias("meta_taxa_alfabetizacao"))


@query
def deviation_flag(t: Tables) -> DataFrame:
    """Order totals against the customer balance, with either side missing at times."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    actual = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    target = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 20)
    return rows.select(
        "o_orderkey",
        rounded(deviation(actual, target)).alias("deviation"),
        target_met(actual, target).alias("met"),
    )


# --- Dedup and reference split


@query
def dedup_latest(t: Tables) -> DataFrame:
    return latest_by(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def reference_valid(t: Tables) -> DataFrame:
    """Order lines of finished orders, with the order's date."""
    finished = t("orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return enrich(lines, finished, F.col("l_orderkey"), "o_orderkey")


@query
def reference_quarantine(t: Tables) -> DataFrame:
    """Order lines without a finished order, with the reason."""
    finished = t("orders").where(F.col("o_orderstatus") == "F")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    marks = {"reason": F.lit("order not finished")}
    return quarantine(lines, finished, F.col("l_orderkey"), "o_orderkey", marks)


@query
def conservation(t: Tables) -> DataFrame:
    """Deduplicated students = valid + rejected, split from one ranking and one join."""
    latest = silver.latest_students(standin.students(t))
    marked = materialize(silver.marked_students(latest, _small_dim(t)), "marked")
    valid, rejected = silver.split_students(marked)
    return catalog.row_counts([("latest", marked), ("valid", valid), ("rejected", rejected)])


# --- Indicators


@query
def indicator_place(t: Tables) -> DataFrame:
    return shown(gold.student_indicators(_components(t), ["id_municipio"]))


@query
def indicator_region(t: Tables) -> DataFrame:
    return shown(gold.student_indicators(_components(t), ["sigla_uf"]))


@query
def indicator_total(t: Tables) -> DataFrame:
    return shown(gold.student_indicators(_components(t), []))


@query
def rollup_member(t: Tables) -> DataFrame:
    """Line sums per brand, plus one extra label made of three brands."""
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    measures = indicator.Measures(
        "l_orderkey", "present", "valid", "success", "l_extendedprice", "l_quantity"
    )
    flagged = rows.withColumns(
        {
            "present": (F.col("l_returnflag") != "R").cast("bigint"),
            "valid": (F.col("l_linestatus") == "F").cast("bigint"),
            "success": (F.col("l_discount") >= 0.05).cast("bigint"),
        }
    )
    parts = indicator.components(flagged, ["l_returnflag", "p_brand"], measures)
    rolled = indicator.roll_up(
        parts, ["l_returnflag"], "p_brand", "Brand#1-3", ["Brand#1", "Brand#2", "Brand#3"]
    )
    return rolled.select(
        "l_returnflag",
        "p_brand",
        "n_persons",
        "n_present",
        "n_valid",
        "n_success",
        rounded(indicator.success_rate()).alias("rate"),
        rounded(indicator.mean_score()).alias("score"),
    )


@query
def key_spine_(t: Tables) -> DataFrame:
    """Distinct (year, nation) of orders, lines and suppliers; NULL is one value."""
    orders = standin._orders(t).select(
        F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("nation")
    )
    lines = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    shipped = lines.select(
        F.year("l_shipdate").alias("year"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")).alias("nation"),
    )
    idle = t("supplier").select(
        F.lit(None).cast("int").alias("year"), F.col("s_nationkey").alias("nation")
    )
    return key_spine([orders, shipped, idle], ["year", "nation"])


@query
def reconcile_mae(t: Tables) -> DataFrame:
    """Own state rates and scores, weighted and not, against the official ones."""
    rolled, members = fixed.NETWORK_ROLLUP, fixed.NETWORK_ROLLUP_MEMBERS
    parts = indicator.roll_up(_components(t), ["ano", "sigla_uf"], "rede", rolled, members)
    own = parts.select(
        "ano",
        "sigla_uf",
        "rede",
        indicator.success_rate().alias("weighted_rate"),
        indicator.plain_rate().alias("plain_rate"),
        indicator.mean_score().alias("weighted_score"),
        indicator.plain_mean_score().alias("plain_score"),
    )
    official = silver.state_results(standin.state_results(t)).select(
        "ano", "sigla_uf", "rede", "taxa_alfabetizacao", "media_portugues"
    )
    rate, score = F.col("taxa_alfabetizacao"), F.col("media_portugues")
    errors = mean_absolute_errors(
        own,
        official,
        ["ano", "sigla_uf", "rede"],
        {
            "mae_rate_weighted": (F.col("weighted_rate"), rate),
            "mae_rate_plain": (F.col("plain_rate"), rate),
            "mae_score_weighted": (F.col("weighted_score"), score),
            "mae_score_plain": (F.col("plain_score"), score),
        },
    )
    return shown(errors)


# --- Quality


def _results(results: DataFrame) -> DataFrame:
    return results.select("check_name", "failed_count", "status", "critical")


@query
def quality_unique(t: Tables) -> DataFrame:
    lines = t("lineitem")
    columns = ["l_orderkey", "l_linenumber"]
    tables = {"lines": lines, "latest": latest_by(lines, columns, ["l_shipdate"])}
    rules = [quality.unique(name, f"{name} unique", columns) for name in tables]
    return _results(quality.evaluate_suite(tables, rules))


_LINE_KEY = ["ship_year", "l_orderkey", "l_linenumber"]


def _line_rules() -> list[quality.Rule]:
    return [
        quality.unique("lines", "lines unique by year", _LINE_KEY),
        quality.unique("lines", "orders unique", ["l_orderkey"]),
        quality.not_null("lines", "key present", _LINE_KEY),
        quality.in_range("lines", "quantity", ["l_quantity"], 0.0, 25.0),
        quality.references("lines", "order finished", "l_orderkey", "finished", "o_orderkey"),
        quality.present("lines", "any line", "l_orderkey"),
        quality.volume("lines", "all lines"),
    ]


@query
def quality_incremental(t: Tables) -> DataFrame:
    """Checks of two versions of a table, one year of which differs: the second run counts that
    year only, but for the rule whose counts do not add up by year."""
    lines = t("lineitem").withColumn("ship_year", F.year("l_shipdate"))
    more = F.when(F.col("ship_year") == 1995, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    tables = {"finished": t("orders").where(F.col("o_orderstatus") == "F")}
    store = LayerStore(t.spark, scratch_path(t.spark, "store"))
    states = CheckStates(t.spark, scratch_path(t.spark, "states"))
    layout = Layout(("ship_year",), ("l_returnflag",))
    for version in (lines, lines.withColumn("l_quantity", more)):
        staged = store.stage_changed(version, "silver", "lines", layout)
        results = states.evaluate(staged, _line_rules(), tables)
        store.publish("silver", [staged])
    return t.spark.createDataFrame(
        [tuple(row) for row in results],
        "check_name string, failed_count bigint, status string, critical boolean",
    )


@query
def quality_abort(t: Tables) -> DataFrame:
    """A critical check is violated: the run raises, and all its results are in the history."""
    path = scratch_path(t.spark, "history")
    rules = [
        quality.in_range("lines", "quantity", ["l_quantity"], 0.0, 25.0),
        quality.unique("lines", "orders unique", ["l_orderkey"]),
        quality.not_null("lines", "key present", ["l_orderkey", "l_linenumber"]),
    ]
    raised = ""
    try:
        quality.run_suite(t.spark, "silver", {"lines": t("lineitem")}, rules, path)
    except quality.QualityFailure as failure:
        raised = str(failure)
    history = quality.read_history(t.spark, path)
    return history.select(
        "layer", "check_name", "failed_count", "status", "critical", F.lit(raised).alias("raised")
    )


@query
def quality_adhoc(t: Tables) -> DataFrame:
    """Single checks without history; a suite without rules writes none."""
    path = scratch_path(t.spark, "history")
    lines = t("lineitem")
    rules = [
        quality.in_range("lines", "quantity", ["l_quantity"], 0.0, 25.0),
        quality.not_null("lines", "key present", ["l_orderkey"]),
        quality.volume("lines", "all lines"),
    ]
    found = [(rule.name, quality.check_once(lines, rule)) for rule in rules]
    quality.run_suite(t.spark, "silver", {"lines": lines}, [], path)
    checked = t.spark.createDataFrame(found, "check_name string, failed_count bigint")
    return checked.withColumn("has_history", F.lit(path_exists(t.spark, path)))


@query
def processing_time(t: Tables) -> DataFrame:
    """All rows that one statement makes have one processing time, valid and rejected ones."""
    raw = standin.place_targets(t)
    made = {
        "valid": silver.place_targets(raw, _small_dim(t)).select("_processed_at"),
        "rejected": silver.rejected(raw, _small_dim(t)).select("_quarantined_at"),
        "students": _students(t).select("_processed_at"),
    }
    counted = [
        materialize(df.toDF("at"), name).agg(
            F.lit(name).alias("table_name"),
            F.count("at").alias("n_rows"),
            F.countDistinct("at").alias("n_times"),
        )
        for name, df in made.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def quality_nulls(t: Tables) -> DataFrame:
    rows = t("orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )
    rules = [
        quality.not_null("orders", "key present", ["o_orderkey"]),
        quality.not_null("orders", "all present", ["o_orderkey", "status", "o_orderpriority"]),
    ]
    return _results(quality.evaluate_suite({"orders": rows}, rules))


@query
def quality_orphans(t: Tables) -> DataFrame:
    tables = {
        "lines": t("lineitem"),
        "finished": t("orders").where(F.col("o_orderstatus") == "F"),
        "orders": t("orders"),
    }
    rules = [
        quality.references("lines", "order finished", "l_orderkey", "finished", "o_orderkey"),
        quality.references("lines", "order known", "l_orderkey", "orders", "o_orderkey"),
    ]
    return _results(quality.evaluate_suite(tables, rules))


@query
def quality_domain(t: Tables) -> DataFrame:
    rules = [
        quality.domain("labels", "flags are 0 or 1", ["quality", "toxic"], [0, 1]),
        quality.domain("labels", "flags are 0", ["quality", "toxic"], [0]),
    ]
    return _results(quality.evaluate_suite({"labels": t("labels")}, rules))


@query
def quality_range(t: Tables) -> DataFrame:
    rows = t("lineitem").select((F.col("l_discount") * 100).alias("percent"), "l_quantity")
    rules = [
        quality.in_range("lines", "percent", ["percent"], 0.0, 100.0),
        quality.in_range("lines", "both", ["percent", "l_quantity"], 1.0, 25.0, critical=True),
    ]
    return _results(quality.evaluate_suite({"lines": rows}, rules))


@query
def quality_present(t: Tables) -> DataFrame:
    indicators = gold.student_indicators(_components(t), ["id_municipio"])
    empty = F.when(F.col("ano") < 0, F.col("ano"))
    rules = [
        quality.present("mart", "students present", "total_alunos_microdados"),
        quality.present("mart", "nothing present", "nothing"),
    ]
    return _results(
        quality.evaluate_suite({"mart": indicators.withColumn("nothing", empty)}, rules)
    )


def _silver_tables(t: Tables) -> dict[str, DataFrame]:
    dim = _small_dim(t)
    tables = {
        "dim_localidades": _dim(t),
        "meta_alfabetizacao_uf": silver.state_targets(standin.state_targets(t)),
        "avaliacao_alfabetizacao_uf": silver.state_results(standin.state_results(t)),
    }
    for name, raw, plan in (
        ("meta_alfabetizacao_municipio", standin.place_targets(t), silver.place_targets),
        ("avaliacao_alfabetizacao_municipio", standin.place_results(t), silver.place_results),
    ):
        raw = materialize(raw, name)
        tables[name] = plan(raw, dim)
        tables[f"quarentena_{name}"] = silver.rejected(raw, dim)
    for name, raw in (
        ("dados_alunos", standin.students(t)),
        ("dados_alunos_streaming", standin.events(t)),
    ):
        marked = materialize(silver.marked_students(silver.latest_students(raw), dim), name)
        tables[name], tables[f"quarentena_{name}"] = silver.split_students(marked)
    return tables


@query
def quality_suite_silver(t: Tables) -> DataFrame:
    return _results(quality.evaluate_suite(_silver_tables(t), checks.silver_rules()))


@query
def quality_suite_gold(t: Tables) -> DataFrame:
    dim = _small_dim(t)
    parts = _components(t)
    place_results = _measured(silver.place_results(standin.place_results(t), dim))
    place_targets = _measured(silver.place_targets(standin.place_targets(t), dim))
    state_results = _measured(silver.state_results(standin.state_results(t)))
    state_targets = _measured(silver.state_targets(standin.state_targets(t)))
    nation_targets = _measured(silver.nation_targets(standin.nation_targets(t)))
    marts = {
        "mart_comparativo_municipio": gold.place_mart(parts, place_results, place_targets, dim),
        "mart_comparativo_uf": gold.state_mart(parts, state_results, state_targets, dim),
        "mart_comparativo_brasil": gold.nation_mart(parts, nation_targets),
    }
    return _results(quality.evaluate_suite(marts, checks.gold_rules()))


@query
def quality_history(t: Tables) -> DataFrame:
    """Two runs of a suite appended to the history, counted by layer and status."""
    path = scratch_path(t.spark, "history")
    rows = t("lineitem")
    suites = {
        "raw": [
            quality.unique("lines", "lines unique", ["l_orderkey", "l_linenumber"]),
            quality.in_range("lines", "quantity", ["l_quantity"], 0.0, 25.0),
        ],
        "checked": [quality.not_null("lines", "keys present", ["l_orderkey", "l_linenumber"])],
    }
    for day, (layer, rules) in enumerate(suites.items(), start=1):
        results = quality.evaluate(rows, rules, {})
        at = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
        quality.append_history(
            quality.in_history_schema(results, f"run-{day}", at, layer), path
        )
    history = quality.read_history(t.spark, path)
    return history.groupBy("run_id", "layer", "status").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.sum("failed_count").alias("failed_count"),
        F.date_format(F.max("executed_date"), "yyyy-MM-dd").alias("executed_day"),
    )


@query
def quality_trend(t: Tables) -> DataFrame:
    """Events as check results: one kind, over the 14 days up to a fixed time."""
    history = t("events").select(
        F.col("ts").alias("executed_at"),
        F.col("event_type").alias("check_name"),
        F.when(F.col("value") > 50, "FAIL").otherwise("PASS").alias("status"),
        F.col("user_id").alias("failed_count"),
    )
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return quality.trend(history, "error", now, days=14).select(
        F.date_format("dia", "yyyy-MM-dd").alias("dia"), "status", "failed_count"
    )


# --- Streaming


def _messages(t: Tables) -> DataFrame:
    """Streamed students as JSON, without the ingest metadata."""
    return events.as_events(standin.events(t).drop("_ingested_at", "_source_file"))


@query
def events_decode(t: Tables) -> DataFrame:
    """Integer and number fields from the JSON text of the events."""
    schema = T.StructType.fromDDL("k bigint, missing double")
    decoded = events.decode(t("events").select(F.col("props").alias("value")), schema)
    return decoded.groupBy("k", "missing", (F.col("_bad_reason").isNull()).alias("good")).agg(
        F.count(F.lit(1)).alias("n_events")
    )


@query
def events_roundtrip(t: Tables) -> DataFrame:
    """Events to JSON to Base64, and back to typed columns."""
    source = t("events").select("event_id", "user_id", "event_type", "value", "props")
    sent = events.encode_base64(events.as_events(source))
    return events.good(events.decode(events.decode_base64(sent), source.schema))


@query
def events_rejected(t: Tables) -> DataFrame:
    """Event kinds in a number field: only NULL and empty text pass."""
    kind = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
    sent = events.as_events(t("events").select("event_id", kind.alias("value")))
    schema = T.StructType.fromDDL("event_id bigint, value double")
    decoded = events.decode(sent, schema)
    return decoded.groupBy(events.REASON).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("sum_event_id")
    )


@query
def events_kept_messages(t: Tables) -> DataFrame:
    """Messages with text after their end, repeated fields, arrays and plain text: the good
    ones with their values, the bad ones as they came."""
    kind, key = F.col("event_id") % 5, F.col("event_id").cast("string")
    message = F.concat(F.lit('{"event_id":'), key, F.lit(',"k":1}'))
    sent = t("events").select(
        F.when(kind == 0, message)
        .when(kind == 1, F.concat(message, F.lit(" trailing")))
        .when(kind == 2, F.concat(F.lit('{"k":2,"event_id":'), key, F.lit(',"k":3} ')))
        .when(kind == 3, F.concat(F.lit("["), message, F.lit("]")))
        .otherwise(F.concat(F.lit("text "), key))
        .alias("value")
    )
    decoded = events.decode(sent, T.StructType.fromDDL("event_id bigint, k bigint"))
    return decoded.select(
        F.when(F.col(events.REASON).isNull(), F.col("event_id")).alias("event_id"),
        F.when(F.col(events.REASON).isNull(), F.col("k")).alias("k"),
        F.when(F.col(events.REASON).isNotNull(), F.col(events.MESSAGE)).alias("message"),
        F.col(events.REASON).alias("reason"),
    )


def _streamed_bronze(
    t: Tables, *deliveries: DataFrame, options: dict[str, str] | None = None
) -> DataFrame:
    """Write messages as text files and stream each delivery into a Bronze table."""
    root = scratch_path(t.spark, "stream")
    schema = T.StructType.fromDDL(fixed.STUDENT_EVENT_SCHEMA)
    for messages in deliveries:
        messages.write.mode("append").text(f"{root}/in")
        stream = read_stream(t.spark, "text", f"{root}/in", options)
        sink, bad_sink = parquet_sink(f"{root}/bronze"), parquet_sink(f"{root}/rejected")
        ingest(stream, schema, "events", sink, bad_sink, f"{root}/checkpoint").awaitTermination()
    meta = f"{ledger.INGESTED_AT} timestamp, {ledger.SOURCE_FILE} string"
    full = f"{fixed.STUDENT_EVENT_SCHEMA}, {meta}"
    return t.spark.read.schema(full).parquet(f"{root}/bronze")


@query
def stream_ingest(t: Tables) -> DataFrame:
    return _streamed_bronze(t, _messages(t)).drop("_ingested_at")


@query
def stream_dedup(t: Tables) -> DataFrame:
    """Every purchase is delivered twice; Silver keeps one row per student, year and school."""
    once = _messages(t)
    twice = once.unionByName(once.where(F.col("value").contains('"purchase"')))
    bronze = _streamed_bronze(t, twice)
    kept = latest_by(
        bronze,
        ["id_aluno", "ano", "id_escola"],
        [F.desc("_ingested_at"), F.desc("proficiencia"), F.desc("caderno")],
    )
    return kept.select("id_aluno", "ano", "id_escola", "caderno", "proficiencia")


@query
def stream_batches(t: Tables) -> DataFrame:
    """One file per micro-batch: several batches append to one table, nothing lost or twice."""
    messages = _messages(t).repartition(4)
    return _streamed_bronze(t, messages, options={"maxFilesPerTrigger": "1"}).drop("_ingested_at")


@query
def stream_latest_wins(t: Tables) -> DataFrame:
    """Half of the students are delivered again later with other values, which win."""
    first = standin.events(t).drop("_ingested_at", "_source_file")
    again = first.where(F.col("id_aluno").cast("bigint") % 2 == 0).withColumns(
        {"caderno": F.col("caderno") + 1000, "peso_aluno": F.lit(9.0)}
    )
    bronze = _streamed_bronze(t, events.as_events(first), events.as_events(again))
    return silver.latest_students(bronze).drop("_ingested_at", "_source_file")


@query
def stream_compacted(t: Tables) -> DataFrame:
    """Several batches into day folders, merged into few files, and read back."""
    root = scratch_path(t.spark, "stream")
    schema = T.StructType.fromDDL(fixed.STUDENT_EVENT_SCHEMA)
    table = EventTable(t.spark, f"{root}/bronze", schema)
    _messages(t).repartition(4).write.text(f"{root}/in")
    stream = read_stream(t.spark, "text", f"{root}/in", {"maxFilesPerTrigger": "2"})
    bad_sink = parquet_sink(f"{root}/rejected")
    ingest(
        stream, schema, "events", table.sink(), bad_sink, f"{root}/checkpoint"
    ).awaitTermination()
    table.compact(dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=2))
    table.remove_merged_sources()
    return table.read().drop("_ingested_at", "_arrival_day")


_EVENT_META = (ledger.INGESTED_AT, ledger.SOURCE_FILE, "_arrival_day")


def _event_table(t: Tables) -> EventTable:
    schema = T.StructType.fromDDL(fixed.STUDENT_EVENT_SCHEMA)
    return EventTable(t.spark, scratch_path(t.spark, "events"), schema)


def _arrived(rows: DataFrame, day: int) -> DataFrame:
    at = dt.datetime(2024, 1, day, 12, tzinfo=dt.timezone.utc)
    return ledger.stamp(rows.drop(*_EVENT_META), at, "events")


def _shares(rows: DataFrame, n: int) -> list[DataFrame]:
    """All rows, in `n` groups by a hash of their values."""
    values = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(n))
    return [rows.where(values == i) for i in range(n)]


@query
def stream_incremental(t: Tables) -> DataFrame:
    """Three deliveries, each merged into the newest event per student: a merge reads the new
    events and what it has, also when a compaction has rewritten the old ones in between."""
    first = materialize(standin.events(t), "deliveries")
    student = F.col("id_aluno").cast("bigint")
    deliveries = [
        first.where(student % 5 != 0),
        first.where(student % 2 == 0).withColumn("caderno", F.col("caderno") + 1000),
        first.where(student % 3 == 0).withColumn("peso_aluno", F.lit(9.0)),
    ]
    table = _event_table(t)
    state = LatestState(
        t.spark,
        scratch_path(t.spark, "state"),
        table.columns,
        silver.STUDENT_KEYS,
        (ledger.INGESTED_AT,),
        buckets=8,
    )
    for day, rows in enumerate(deliveries, start=1):
        for share in _shares(rows, 2):
            table.append(_arrived(share, day))
        new, position = table.read_after(state.position())
        state.merge(new, position)
        table.compact(dt.date(2024, 1, day + 1))
        table.remove_merged_sources()
    state.remove_replaced()
    return state.read().drop(*_EVENT_META)


@query
def stream_late_events(t: Tables) -> DataFrame:
    """Events that lie in the table's root, as an older layout wrote them; events of a day that
    was merged before they came; nothing is lost or twice."""
    old, early, late, other = _shares(materialize(standin.events(t), "shares"), 4)
    table = _event_table(t)
    _arrived(old, 1).write.parquet(table.path)
    table.append(_arrived(early, 1))
    table.compact(dt.date(2024, 1, 3))
    table.append(_arrived(late, 1))
    table.append(_arrived(other, 2))
    table.remove_merged_sources()
    table.compact(dt.date(2024, 1, 3))
    table.remove_merged_sources()
    return table.read().drop(ledger.INGESTED_AT, "_arrival_day")


@query
def stream_once(t: Tables) -> DataFrame:
    """Deliveries that come again with the number of their batch are taken once, also out of
    turn and after others."""
    config = runs.Config(scratch_path(t.spark, "lake"))
    a0, a1, b0, b1 = _shares(materialize(_messages(t), "messages"), 4)
    deliveries = [("a", 0, a0), ("b", 0, b0), ("a", 0, a0), ("a", 1, a1), ("b", 1, b1)]
    for writer, number, messages in [*deliveries, *deliveries[1:3]]:
        runs.ingest_events(t.spark, config, messages, "events", writer, number)
    return runs.read_stream_table(t.spark, config).drop(ledger.INGESTED_AT)


@query
def stream_bounded(t: Tables) -> DataFrame:
    """A run that stops after its first rows, and one that takes the rest; a segment without
    messages and one with bad messages only write nothing."""
    topic, root = scratch_path(t.spark, "topic"), scratch_path(t.spark, "stream")
    table = _event_table(t)
    shares = _shares(materialize(_messages(t), "messages"), 3)
    bad = shares[0].select(F.concat(F.lit("no "), "value").alias("value"))
    for messages in (shares[0], shares[0].limit(0), bad, *shares[1:]):
        publish(messages, topic)

    def run(trigger: dict[str, object] | None, most: int | None, rows: int) -> None:
        written: dict[int, int] = {}
        query = ingest(
            read_segments(t.spark, topic, "silver", most),
            table.schema,
            "events",
            table.once_per_batch(),
            parquet_sink(f"{root}/rejected"),
            f"{root}/checkpoint",
            trigger,
            written=written,
        )
        run_bounded(query, rows, 600, 0.2, written)

    run({"processingTime": "0 seconds"}, 1, 1)
    run(None, None, 1 << 62)
    return table.read().drop(ledger.INGESTED_AT, "_arrival_day")


@query
def stream_redelivery(t: Tables) -> DataFrame:
    """A sink that fails after it has written: the batch is not acknowledged, comes again with
    the restarted stream, and is known; further segments follow."""
    topic, root = scratch_path(t.spark, "topic"), scratch_path(t.spark, "stream")
    table = _event_table(t)
    shares = _shares(materialize(_messages(t), "messages"), 3)
    fails = iter([True])

    def append(rows: DataFrame, writer: str, batch: int) -> bool:
        done = table.append(rows, writer, batch)
        if next(fails, False):
            raise ConnectionError("written, but not confirmed")
        return done

    for share in shares:
        publish(share, topic)
        query = ingest(
            read_segments(t.spark, topic, "silver"),
            table.schema,
            "events",
            OncePerBatch(append),
            parquet_sink(f"{root}/rejected"),
            f"{root}/checkpoint",
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if acknowledged(topic, "silver"):
                raise
    return table.read().drop(ledger.INGESTED_AT, "_arrival_day")
