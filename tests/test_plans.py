"""The whole pipeline on a small hand-made input."""

from __future__ import annotations

import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lavra.__main__ import main
from lavra.operators.quality import QualityFailure, check_once, read_history
from lavra.plans import fixed, gold, runs, silver
from lavra.plans.checks import gold_rules
from lavra.sources.catalog import Source
from lavra.sources.files import write_csv
from lavra.sources.tables import LayerStore
from lavra.streaming.ingest import read_stream

T1 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
T2 = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
T3 = dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc)


def target(ano, *key, rede="Pública ", taxa=None, metas=None, tail=(90.0,)):
    metas = metas or {}
    return (ano, *key, rede, taxa, *[metas.get(y) for y in fixed.TARGET_YEARS], *tail)


def outcome(ano, place, rede, taxa, serie=2):
    return (ano, place, serie, rede, taxa, 740.0, *[None] * 9)


def student(i, place, rede="3", alf=1, peso=1.0, ano=2024, prof=750.0):
    return (ano, place, " e1", f"s{i}", 1, 2, rede, 1, 1, alf, prof, peso)


PLACES = [
    (1, " Vila ", "pe ", "Pernambuco", 26, "ne", "Nordeste"),
    (2, "Serra", "PE", "Pernambuco", 26, "NE", "Nordeste"),
    (3, "Campo", "RS", "Rio Grande do Sul", 43, "S", "Sul"),
]


@pytest.fixture
def load(spark, folder):
    """Write the eight sources as Parquet and append them as one Bronze snapshot."""
    config = runs.Config(f"{folder}/lake")

    def run(at, students=None):
        students = students or [
            student(1, "1"),
            student(2, "1", alf=0, peso=3.0),
            student(3, "2", rede="2"),
            student(4, "3", rede="1"),
            student(5, "77"),
            student(6, None),
            student(1, "1"),
            student(7, "1", alf=0, peso=None, prof=None),
        ]
        tables = {
            "ibge_municipios": PLACES,
            "meta_alfabetizacao_brasil": [
                target(2024, taxa=59.2, metas={2024: 59.9}),
                target(2023, taxa=55.9, metas={2024: 59.9}),
                target(2025, taxa=66.0, metas={2025: 64.0}),
            ],
            "meta_alfabetizacao_uf": [
                target(2024, " pe", taxa=50.0, metas={2024: 40.0}),
                target(2024, "XX", taxa=50.0),
            ],
            "meta_alfabetizacao_municipio": [
                target(2024, "1", taxa=50.0, metas={2024: 25.0}, tail=(3, 90.0)),
                target(2024, "88", tail=(1, 90.0)),
            ],
            "avaliacao_alfabetizacao_uf": [
                outcome(2024, "PE", 5, 38.0),
                outcome(2024, "RS", 0, 120.0),
            ],
            "avaliacao_alfabetizacao_municipio": [
                outcome(2024, "1", 5, 20.0),
                outcome(2024, "2", 9, 60.0),
                outcome(2024, "99", 5, 1.0),
            ],
            "dados_alunos": students,
        }
        sources = []
        for name, rows in tables.items():
            path = f"{folder}/sources/{at:%d}/{name}"
            spark.createDataFrame(rows, runs.schema_of(name)).write.parquet(path)
            sources.append(Source(name, "parquet", path, runs.schema_of(name)))
        return runs.build_bronze(spark, config, sources, at)

    run.config = config
    return run


@pytest.fixture
def stream(spark, folder, load):
    def run(name, *events):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{name}.txt", "w", encoding="utf-8") as f:
            f.writelines(json.dumps(e) + "\n" for e in events)
        messages = read_stream(spark, "text", f"{folder}/in")
        runs.stream_bronze(spark, load.config, messages, "topic").awaitTermination()

    return run


def event(i, place, ano="2024", **more):
    return {
        "ano": ano, "id_municipio": place, "id_aluno": f"s{i}", "rede": 3, "presenca": "1",
        "preenchimento_caderno": 1, "alfabetizado": 1, **more,
    }


def test_from_sources_to_marts(spark, load, stream, rows):
    config = load.config
    sizes = load(T1)
    assert sizes["dados_alunos"].snapshot_rows == 8
    stream("1", event(1, "1"), event(1, "1"), event(9, "77"))
    results = runs.run_silver(spark, config)
    warned = {r["check_name"]: r["failed_count"] for r in results if r["status"] == "WARN"}
    assert warned == {
        "meta_alfabetizacao_municipio - volume em quarentena": 1,
        "avaliacao_alfabetizacao_municipio - volume em quarentena": 1,
        "dados_alunos - volume em quarentena": 2,
        "dados_alunos_streaming - volume em quarentena": 1,
        "avaliacao_alfabetizacao_uf - taxa_alfabetizacao deve estar entre 0.0 e 100.0": 1,
    }
    t = LayerStore(spark, config.root).current("silver")
    assert len(t) == 12
    assert rows(t["dim_localidades"], "id_municipio", "nome_municipio", "sigla_uf", "sigla_regiao") == [
        ("0000001", "Vila", "PE", "NE"),
        ("0000002", "Serra", "PE", "NE"),
        ("0000003", "Campo", "RS", "S"),
    ]
    assert rows(t["dados_alunos"], "id_aluno", "id_municipio", "sigla_uf", "id_escola", "rede") == [
        ("s1", "0000001", "PE", "e1", "Municipal"),
        ("s2", "0000001", "PE", "e1", "Municipal"),
        ("s3", "0000002", "PE", "e1", "Estadual"),
        ("s4", "0000003", "RS", "e1", "Federal"),
        ("s7", "0000001", "PE", "e1", "Municipal"),
    ]
    rejected = t["quarentena_dados_alunos"]
    assert rows(rejected, "id_aluno", "id_municipio", "_motivo_quarentena") == [
        ("s5", "77", fixed.QUARANTINE_REASON),
        ("s6", None, fixed.QUARANTINE_REASON),
    ]
    assert set(runs.schema_of("dados_alunos").names) < set(rejected.columns)
    assert rows(t["avaliacao_alfabetizacao_municipio"], "id_municipio", "rede") == [
        ("0000001", "Pública"),
        ("0000002", "Desconhecida"),
    ]
    assert t["dados_alunos_streaming"].count() == 1

    runs.run_gold(spark, config)
    g = LayerStore(spark, config.root).current("gold")
    place = g["mart_comparativo_municipio"]
    assert place.columns == [*gold.PLACE_COLUMNS, "_processed_at"]
    shown = [
        "id_municipio", "nome_municipio", "rede", "taxa_alfabetizacao_real", "desvio_meta_real",
        "atingiu_meta_real", "nivel_alfabetizacao", "total_alunos_microdados",
        "taxa_alfabetizacao_microdados", "atingiu_meta_microdados",
    ]
    assert rows(place, *shown) == [
        ("0000001", "Vila", "Municipal", None, None, None, None, 3, 25.0, None),
        ("0000001", "Vila", "Pública", 20.0, -5.0, False, 3, 3, 25.0, True),
        ("0000002", "Serra", "Desconhecida", 60.0, None, None, None, None, None, None),
        ("0000002", "Serra", "Estadual", None, None, None, None, 1, 100.0, None),
        ("0000002", "Serra", "Pública", None, None, None, None, 1, 100.0, None),
        ("0000003", "Campo", "Federal", None, None, None, None, 1, 100.0, None),
    ]
    # A state without a place in the dimension stays here; an unknown place is left out above.
    state = g["mart_comparativo_uf"]
    assert state.columns == [*gold.STATE_COLUMNS, "_processed_at"]
    assert rows(state, "sigla_uf", "nome_uf", "rede", "desvio_meta_real", "taxa_alfabetizacao_microdados") == [
        ("PE", "Pernambuco", "Estadual", None, 100.0),
        ("PE", "Pernambuco", "Municipal", None, 25.0),
        ("PE", "Pernambuco", "Pública", -2.0, 40.0),
        ("RS", "Rio Grande do Sul", "Federal", None, 100.0),
        ("RS", "Rio Grande do Sul", "Total", None, None),
        ("XX", None, "Pública", None, None),
    ]
    nation = g["mart_comparativo_brasil"]
    assert nation.columns == [*gold.NATION_COLUMNS, "_processed_at"]
    assert rows(
        nation.where("rede = 'Pública'"), "ano", F.round("desvio_meta_real", 6), "atingiu_meta_real"
    ) == [(2023, None, None), (2024, -0.7, False), (2025, 2.0, True)]
    fresh = g["mart_frescor_streaming"]
    assert rows(
        fresh, "ano", "eventos_ingeridos", "alunos_distintos", "municipios_cobertos",
        "pct_cobertura_sobre_base_completa",
    ) == [(2024, 1, 1, 1, 20.0)]
    history = read_history(spark, config.history)
    assert history.groupBy("layer").count().orderBy("layer").collect() == [("gold", 8), ("silver", 18)]

    # A critical violation keeps the old tables.
    load(T2, students=[student(1, "1", alf=7)])
    with pytest.raises(QualityFailure, match="0 ou 1"):
        runs.run_silver(spark, config)
    assert LayerStore(spark, config.root).current("silver")["dados_alunos"].count() == 5
    assert rows(read_history(spark, config.history).where("status = 'FAIL'"), "check_name") == [
        ("dados_alunos - presenca e alfabetizado devem ser 0 ou 1",)
    ]

    # The newest snapshot replaces them.
    load(T3, students=[student(8, "3")])
    runs.build_silver(spark, config)
    t = LayerStore(spark, config.root).current("silver")
    assert rows(t["dados_alunos"], "id_aluno") == [("s8",)]


def test_run_that_shares_years(spark, load, stream, rows):
    """The same tables and check results; a second run writes and checks no unchanged year."""
    config = replace(load.config, share_years=True, mart_buckets=4)
    store = LayerStore(spark, config.root)
    times = ["_processed_at", "_quarantined_at", "primeiro_processamento", "ultimo_processamento"]

    def tables():
        return {
            (layer, name): rows(df.drop(*times))
            for layer in ("silver", "gold")
            for name, df in store.current(layer).items()
        }

    def checks():
        history = read_history(spark, config.history)
        last = history.groupBy("layer").agg(F.max("executed_at").alias("executed_at"))
        return rows(history.join(last, ["layer", "executed_at"]), "check_name", "failed_count", "status")

    load(T1)
    stream("1", event(1, "1"), event(9, "77"))
    runs.run_silver(spark, load.config)
    runs.run_gold(spark, load.config)
    expected, results = tables(), checks()
    for again in (False, True):
        runs.run_silver(spark, config)
        runs.run_gold(spark, config)
        assert tables() == expected and checks() == results
        for layer, name in (("silver", "dados_alunos"), ("gold", "mart_comparativo_municipio")):
            entry = store._seen(layer).state["tables"][name]
            assert any(n.startswith("ano=") for n in os.listdir(entry["path"])) != again


def test_two_grades_fan_out_and_fail_the_unique_check(spark, table, rows):
    dim = table(
        "id_municipio string, nome_municipio string, sigla_uf string, nome_uf string, "
        "nome_regiao string",
        ("0000001", "Vila", "PE", "Pernambuco", "Nordeste"),
    )
    grades = [outcome(2024, "1", 5, 20.0), outcome(2024, "1", 5, 21.0, serie=3)]
    results = silver.place_results(
        spark.createDataFrame(grades, runs.schema_of("avaliacao_alfabetizacao_municipio")), dim
    )
    targets = silver.place_targets(
        spark.createDataFrame(
            [target(2024, "1", metas={2024: 20.5}, tail=(3, 90.0))],
            runs.schema_of("meta_alfabetizacao_municipio"),
        ),
        dim,
    )
    students = table(
        "ano bigint, id_municipio string, sigla_uf string, rede string, id_aluno string, "
        "presenca bigint, preenchimento_caderno bigint, alfabetizado bigint, "
        "proficiencia double, peso_aluno double"
    )
    mart = gold.place_mart(gold.student_components(students), results, targets, dim)
    assert rows(mart, "taxa_alfabetizacao_real", "atingiu_meta_real") == [
        (20.0, False),
        (21.0, True),
    ]
    with pytest.raises(QualityFailure, match="unicidade de ano . id_municipio . rede"):
        check_once(mart, gold_rules()[0])


def test_survivor_decides_about_quarantine(table):
    dim = table("id_municipio string, sigla_uf string", ("0000001", "PE"))
    columns = ", ".join([fixed.STUDENT_BATCH_SCHEMA, "_ingested_at bigint", "_source_file string"])
    raw = table(columns, (*student(1, "1"), 1, "s"), (*student(1, "77"), 2, "s"))
    latest = silver.latest_students(raw)
    assert silver.students(latest, dim).count() == 0
    assert silver.rejected(latest, dim).count() == 1
    valid, unknown = silver.split_students(silver.marked_students(latest, dim))
    assert valid.columns == silver.students(latest, dim).columns
    assert unknown.columns == silver.rejected(latest, dim).columns
    assert (valid.count(), unknown.count()) == (0, 1)


def test_raw_keys_that_differ_by_blanks_stay_apart(table, rows):
    dim = table("id_municipio string, sigla_uf string", ("0000001", "PE"))
    columns = ", ".join([fixed.STUDENT_BATCH_SCHEMA, "_ingested_at bigint", "_source_file string"])
    padded = (2024, "1", "e", " s1", 1, 2, "3", 1, 1, 1, 1.0, 1.0, 1, "s")
    raw = table(columns, (*student(1, "1"), 1, "s"), padded)
    both = silver.students(silver.latest_students(raw), dim)
    assert rows(both, "id_aluno") == [("s1",), ("s1",)]


def test_command_line(spark, folder, load):
    load(T1)
    published = {table: name for name, table in fixed.PUBLISHED_NAMES.items()}
    for table, name in published.items():
        history = spark.read.schema(runs.schema_of(table)).parquet(f"{folder}/sources/01/{table}")
        history.write.parquet(f"{folder}/published/{name}")
    dim = spark.createDataFrame(PLACES, runs.schema_of("ibge_municipios"))
    write_csv(dim, f"{folder}/places.csv", dim.columns)
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/1.txt", "w", encoding="utf-8") as f:
        f.write(json.dumps(event(1, "1")) + "\n")

    root = ["--root", f"{folder}/cli"]
    where = ["--format", "parquet", "--location", f"{folder}/published/{{name}}"]
    assert main(["bronze", *root, *where, "--places-csv", f"{folder}/places.csv"]) == 0
    assert main(["stream", *root, "--format", "text", "--location", f"{folder}/in", "--max-messages", "1"]) == 0
    assert main(["silver", *root]) == 0
    assert main(["gold", *root]) == 0
    assert main(["validate", *root, "gold"]) == 0
    store = LayerStore(spark, f"{folder}/cli")
    assert store.current("gold")["mart_comparativo_municipio"].count() == 6
    assert store.current("silver")["dados_alunos_streaming"].count() == 1
    assert main(["silver", "--root", f"{folder}/nothing"]) == 1
    # An event by itself, twice; then only changed years are written.
    late = ["--message", json.dumps(event(2, "1")), "--source", "bus", "--writer", "p0", "--offset", "0"]
    for _ in range(2):
        assert main(["event", *root, *late]) == 0
    assert main(["silver", *root, "--share-years"]) == 0
    assert main(["silver", *root, "--share-years"]) == 0
    for layer in ("bronze", "silver"):
        assert main(["clean", *root, layer]) == 0
    assert store.current("silver")["dados_alunos_streaming"].count() == 2
    assert store.current("silver")["dados_alunos"].count() == 5
