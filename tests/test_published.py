"""Golden values of the published sample files; `LAVRA_SAMPLES` is their path with `{name}`."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lavra.plans import gold, runs, silver

PATTERN = os.environ.get("LAVRA_SAMPLES", "")

pytestmark = pytest.mark.skipif(not PATTERN, reason="no sample files")


@pytest.fixture(scope="module")
def raw(spark):
    sources = {s.table: s for s in runs.published_sources("csv", PATTERN)}
    return lambda table: sources[table].read(spark)


@pytest.fixture
def parts(spark):
    """No students at all."""
    students = silver.students(
        spark.createDataFrame([], runs.schema_of("dados_alunos")),
        spark.createDataFrame([], "id_municipio string, sigla_uf string"),
    )
    return gold.student_components(students)


def test_state_results_by_year_and_label(raw):
    results = silver.state_results(raw("avaliacao_alfabetizacao_uf"))
    found = results.groupBy("ano", "rede").agg(
        F.count("*").alias("n"), F.round(F.sum("taxa_alfabetizacao"), 2).alias("total")
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        (2023, "Estadual", 22, 1273.51),
        (2023, "Municipal", 24, 1296.79),
        (2023, "Pública", 24, 1302.03),
        (2024, "Estadual", 24, 1443.22),
        (2024, "Municipal", 25, 1407.42),
        (2024, "Pública", 25, 1415.3),
        (2024, "Total", 1, 35.96),
    ]


def test_state_mart_without_students(spark, raw, parts):
    dim = spark.createDataFrame(
        [],
        "id_municipio string, nome_municipio string, sigla_uf string, nome_uf string, "
        "nome_regiao string",
    )
    mart = gold.state_mart(
        parts,
        silver.state_results(raw("avaliacao_alfabetizacao_uf")),
        silver.state_targets(raw("meta_alfabetizacao_uf")),
        dim,
    ).cache()
    flag = next(c for c in mart.columns if dict(mart.dtypes)[c] == "boolean" and "real" in c)
    gap = next(c for c in mart.columns if c.startswith("desvio") and "real" in c)
    assert mart.count() == 150
    counts = {r[0]: r[1] for r in mart.groupBy(flag).count().collect()}
    assert counts == {True: 11, False: 13, None: 126}
    (total,) = mart.agg(F.round(F.sum(gap), 2)).first()
    assert total == -33.68


def test_nation_mart(raw, parts):
    mart = gold.nation_mart(parts, silver.nation_targets(raw("meta_alfabetizacao_brasil")))
    assert sorted(r["ano"] for r in mart.collect()) == [2023, 2024, 2025]
