from __future__ import annotations

import datetime as dt
import glob
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.plans import fixed, runs
from lavra.sources import files, ledger
from lavra.sources.catalog import Source
from lavra.sources.tables import Layout, LayerStore, write_layout

SCHEMA = T.StructType().add("id", "long").add("name", "string")


def at(day):
    return dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)


def test_snapshots_append_and_latest_wins(spark, folder, table, rows):
    path = f"{folder}/t"
    first = ledger.append_snapshot(table("id bigint, name string", (1, "a"), (2, "b")), path, at(1), "s", SCHEMA)
    assert (first.snapshot_rows, first.total_rows) == (2, 2)
    # Columns are matched by name, not by position.
    second = ledger.append_snapshot(table("name string, id bigint", ("c", 3)), path, at(2), "s", SCHEMA)
    assert (second.snapshot_rows, second.total_rows) == (1, 3)
    assert rows(ledger.read_latest(spark, path, SCHEMA), "id", "name", "_source_file") == [(3, "c", "s")]
    assert ledger.read_history(spark, path, SCHEMA).count() == 3
    assert rows(ledger.snapshot_counts(ledger.read_history(spark, path, SCHEMA)), "row_count") == [(1,), (2,)]


def test_latest_prunes_partitions(spark, folder, table):
    path = f"{folder}/t"
    for day in (1, 2):
        ledger.append_snapshot(table("id bigint, name string", (day, "a")), path, at(day), "s", SCHEMA)
    plan = ledger.read_latest(spark, path, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingested_at" in plan
    history = ledger.read_history(spark, path, SCHEMA)
    plan = ledger.latest_snapshot(history)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingested_at" in plan
    assert ledger.latest_snapshot(history).first()["id"] == 2


def test_empty_snapshot_is_the_latest(spark, folder, table):
    path = f"{folder}/t"
    assert ledger.append_snapshot(table("id bigint, name string"), path, at(1), "s", SCHEMA).snapshot_rows == 0
    assert ledger.read_latest(spark, path, SCHEMA).count() == 0
    empty = table("_ingested_at timestamp")
    assert ledger.latest_snapshot(empty).count() == 0


def test_unfinished_snapshot_is_not_read_and_can_be_repeated(spark, folder, table):
    path = f"{folder}/t"
    one = table("id bigint, name string", (1, "a"))
    ledger.append_snapshot(one, path, at(1), "s", SCHEMA)
    # A crash after the data but before the list entry.
    ledger.stamp(table("id bigint, name string", (9, "z")), at(2), "s").write.mode("append").partitionBy(
        "_ingested_at"
    ).parquet(path)
    assert ledger.read_latest(spark, path, SCHEMA).first()["id"] == 1
    ledger.append_snapshot(table("id bigint, name string", (2, "b")), path, at(2), "s", SCHEMA)
    latest = ledger.read_latest(spark, path, SCHEMA)
    assert [r["id"] for r in latest.collect()] == [2]
    assert ledger.read_history(spark, path, SCHEMA).count() == 2
    with pytest.raises(ValueError, match="already"):
        ledger.append_snapshot(one, path, at(2), "s", SCHEMA)


def test_schema_differences_are_refused(folder, table):
    with pytest.raises(ValueError, match="name"):
        ledger.append_snapshot(table("id bigint", (1,)), f"{folder}/t", at(1), "s", SCHEMA)


def test_other_time_zone_is_refused(spark, folder, table):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ledger.append_snapshot(table("id bigint, name string", (1, "a")), f"{folder}/t", at(1), "s", SCHEMA)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_csv_keeps_types_and_reports_bad_text(spark, folder, table, rows):
    path = f"{folder}/c.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("ano,rede,taxa\n2024,Pública,66\n2023,Pública,\n")
    df = files.read_csv(spark, path, "ano bigint, rede string, taxa double")
    assert rows(df) == [(2023, "Pública", None), (2024, "Pública", 66.0)]
    with open(path, "a", encoding="utf-8") as f:
        f.write("x,Pública,1\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="ano is not bigint"):
        files.read_csv(spark, path, "ano bigint, rede string, taxa double").collect()


def test_nested_places(spark, folder, rows):
    state = {"id": 26, "sigla": "PE", "nome": "Pernambuco", "regiao": {"sigla": "NE", "nome": "Nordeste"}}
    nested = {"regiao-intermediaria": {"UF": state}}
    data = [
        {"id": 2605459, "nome": "Ilha", "microrregiao": None, "regiao-imediata": nested},
        {"id": 1, "nome": "Sem caminho"},
    ]
    path = f"{folder}/places.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(data, f, ensure_ascii=False)
    schema = T.StructType.fromDDL(fixed.PLACES_SCHEMA)
    csv_path = f"{folder}/places.csv"
    runs.convert_places(spark, path, csv_path)
    flat = Source("ibge_municipios", "csv", csv_path, schema).read(spark)
    assert flat.schema == schema
    assert rows(flat) == [
        (1, "Sem caminho", None, None, None, None, None),
        (2605459, "Ilha", "PE", "Pernambuco", 26, "NE", "Nordeste"),
    ]


def test_publish_switches_all_tables_at_once(spark, folder, table, rows):
    store = LayerStore(spark, folder)
    layout = Layout(("ano",), ("uf",))
    old = store.stage(table("ano bigint, uf string", (2024, "A")), "silver", "t", layout)
    store.publish("silver", [old])
    new = store.stage(table("ano bigint, uf string", (2025, "B")), "silver", "t", layout)
    assert rows(store.current("silver")["t"], "ano", "uf") == [(2024, "A")]
    empty = store.stage(table("ano bigint, uf string"), "silver", "e", layout)
    store.publish("silver", [new, empty])
    current = store.current("silver")
    assert rows(current["t"], "ano", "uf") == [(2025, "B")]
    assert current["e"].count() == 0
    plan = current["t"].where("ano = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_layout_splits_a_hot_value_and_prunes(spark, folder):
    df = spark.range(0, 400_000, numPartitions=8).select(
        F.lit(2024).alias("ano"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("u"), F.col("id") % 20)).alias("uf"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = f"{folder}/t"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_layout(df, path, Layout(("ano",), ("uf",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(path)
    assert written.count() == 400_000
    hot_files = written.where("uf = 'HOT'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot_files > 1
    assert len(glob.glob(f"{path}/ano=2024/*.parquet")) > 8


NASTY = [
    (1, "say \"hi\", twice"),
    (2, ""),
    (3, None),
    (4, "  blanks  "),
    (5, "a\\b, c\\"),
    (6, "line\nbreak\r\nand \"more\""),
    (7, '"'),
    (8, '""'),
]


def test_csv_round_trip_keeps_every_text(spark, folder, table, rows):
    df = table("id bigint, text string", *NASTY)
    files.write_csv(df, f"{folder}/c", ["id", "text"])
    assert rows(files.read_csv(spark, f"{folder}/c", df.schema, multi_line=True)) == rows(df)


def test_csv_of_another_program(spark, folder, rows):
    import csv

    path = f"{folder}/c.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL)
        writer.writerow(["extra", "id", "text"])
        writer.writerows([["e", "", 'say "hi"'], ["f", "2", "a,b"]])
    df = files.read_csv(spark, path, "id bigint, text string")
    assert df.columns == ["id", "text", "extra"]
    assert rows(df) == [(2, "a,b", "f"), (None, 'say "hi"', "e")]


@pytest.mark.parametrize("line", ["1,a,too many", "1"])
def test_csv_lines_of_another_width_raise(spark, folder, line):
    path = f"{folder}/c.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"id,text\n{line}\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv(spark, path, "id bigint, text string").collect()


def test_sources_that_differ_from_their_schema_raise(spark, folder, table):
    schema = T.StructType.fromDDL("id bigint, rede string")
    table("id bigint, renamed string, extra int", (1, "a", 2)).write.parquet(f"{folder}/renamed")
    table("id string, rede string", ("1", "a")).write.parquet(f"{folder}/mistyped")
    for name, problem in (("renamed", "rede is missing"), ("mistyped", "id is string")):
        with pytest.raises(ValueError, match=problem):
            Source("t", "parquet", f"{folder}/{name}", schema).read(spark)
    with open(f"{folder}/c.csv", "w", encoding="utf-8") as f:
        f.write("id,other\n1,a\n")
    with pytest.raises(ValueError, match="rede"):
        Source("t", "csv", f"{folder}/c.csv", schema).read(spark)
    with open(f"{folder}/j.json", "w", encoding="utf-8") as f:
        f.write('{"id": 1, "rede": "a"}\n{"id": 2, "re')
    with pytest.raises((PySparkException, Py4JJavaError)):
        Source("t", "json", f"{folder}/j.json", schema).read(spark).collect()


def test_json_keeps_extra_fields_and_raises_on_other_types(spark, folder, rows):
    schema = T.StructType.fromDDL("id bigint, rede string")
    with open(f"{folder}/j.json", "w", encoding="utf-8") as f:
        f.write('{"id": 1, "rede": "a"}\n{"id": 2, "more": 5}\n')
    df = Source("t", "json", f"{folder}/j.json", schema).read(spark)
    assert df.columns == ["id", "rede", "more"]
    assert rows(df) == [(1, "a", None), (2, None, "5")]
    with open(f"{folder}/j.json", "a", encoding="utf-8") as f:
        f.write('{"id": "x", "rede": "a"}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        Source("t", "json", f"{folder}/j.json", schema).read(spark).collect()


def test_snapshots_keep_extra_columns(spark, folder, table, rows):
    df = table("extra string, name string, id int", ("x", "a", 1))
    ledger.append_snapshot(df, f"{folder}/t", at(1), "s", SCHEMA)
    kept = spark.read.parquet(f"{folder}/t")
    assert rows(kept, "id", "name", "extra") == [(1, "a", "x")]
    assert rows(ledger.read_latest(spark, f"{folder}/t", SCHEMA), "id", "name") == [(1, "a")]
    with pytest.raises(ValueError, match="metadata"):
        ledger.append_snapshot(
            table("id bigint, name string, _source_file string", (1, "a", "b")), f"{folder}/t", at(2), "s", SCHEMA
        )


def test_broken_place_file_raises(spark, folder):
    path = f"{folder}/places.json"
    with open(path, "w", encoding="utf-8") as f:
        f.write('[{"id": 1, "nome": "a"}, {"id": 2, "no')
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.flatten_places(files.read_places_json(spark, path)).collect()


def test_old_and_unlisted_versions_are_removed_on_request(spark, folder, table, rows):
    store = LayerStore(spark, folder)
    layout = Layout((), ("x",))

    def stage(value):
        return store.stage(table("x int", (value,)), "silver", "t", layout)

    published = []
    for value in range(3):
        published.append(stage(value))
        store.publish("silver", [published[-1]])
    forgotten = stage(9)
    gone = store.remove_unlisted("silver", keep=2)
    assert sorted(gone) == sorted([published[0].path, forgotten.path])
    assert rows(store.current("silver")["t"]) == [(2,)]
    dropped = stage(10)
    store.discard([dropped])
    assert store.remove_unlisted("silver") == [published[1].path]
    assert not glob.glob(f"{dropped.path}*")


def test_scratch_tables_are_removed(spark, table):
    from lavra.runtime import materialize, released, scratch_root

    before = set(glob.glob(f"{scratch_root(spark)}/*"))
    outside = materialize(table("x int", (1,)), "outside")
    with released(spark):
        assert materialize(table("x int", (1,)), "inside").count() == 1
    left = set(glob.glob(f"{scratch_root(spark)}/*")) - before
    assert len(left) == 1 and outside.count() == 1
