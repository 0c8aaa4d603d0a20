"""The quality suites of both layers, in the order in which they gate."""

from __future__ import annotations

from lavra.operators.quality import (
    Rule,
    domain,
    in_range,
    not_null,
    present,
    references,
    unique,
    volume,
)

_STUDENT_REQUIRED = ["id_aluno", "id_municipio", "ano", "alfabetizado"]
_STUDENT_FLAGS = ["presenca", "alfabetizado"]


def silver_rules() -> list[Rule]:
    # Check names are fixed values: history queries select by them.
    dim, key = "dim_localidades", "id_municipio"
    batch, stream = "dados_alunos", "dados_alunos_streaming"
    results, targets = "avaliacao_alfabetizacao_municipio", "meta_alfabetizacao_municipio"
    person = ["id_aluno", "ano"]
    return [
        unique(dim, "dim_localidades - unicidade de id_municipio", [key]),
        unique(batch, "dados_alunos - unicidade de id_aluno por ano", person, ["id_aluno"]),
        unique(
            stream, "dados_alunos_streaming - unicidade de id_aluno por ano", person, ["id_aluno"]
        ),
        unique(
            "meta_alfabetizacao_uf",
            "meta_alfabetizacao_uf - unicidade de ano + sigla_uf + rede",
            ["ano", "sigla_uf", "rede"],
            ["sigla_uf", "rede"],
        ),
        not_null(
            dim,
            "dim_localidades - nulos em chaves e colunas obrigatórias",
            [key, "sigla_uf", "nome_municipio"],
        ),
        not_null(batch, "dados_alunos - nulos em colunas obrigatórias", _STUDENT_REQUIRED),
        not_null(
            stream, "dados_alunos_streaming - nulos em colunas obrigatórias", _STUDENT_REQUIRED
        ),
        *[
            references(t, f"{t} - id_municipio inexistente em dim_localidades", key, dim, key)
            for t in (batch, stream, results, targets)
        ],
        *[
            volume(f"quarentena_{t}", f"{t} - volume em quarentena")
            for t in (targets, results, batch, stream)
        ],
        domain(
            batch, "dados_alunos - presenca e alfabetizado devem ser 0 ou 1", _STUDENT_FLAGS, [0, 1]
        ),
        domain(
            stream,
            "dados_alunos_streaming - presenca e alfabetizado devem ser 0 ou 1",
            _STUDENT_FLAGS,
            [0, 1],
        ),
        in_range(
            "avaliacao_alfabetizacao_uf",
            "avaliacao_alfabetizacao_uf - taxa_alfabetizacao deve estar entre 0.0 e 100.0",
            ["taxa_alfabetizacao"],
            0.0,
            100.0,
        ),
    ]


def gold_rules() -> list[Rule]:
    # Check names are fixed values: history queries select by them.
    place, state, nation = (
        "mart_comparativo_municipio",
        "mart_comparativo_uf",
        "mart_comparativo_brasil",
    )
    return [
        unique(
            place,
            "mart_comparativo_municipio - unicidade de ano + id_municipio + rede",
            ["ano", "id_municipio", "rede"],
            ["id_municipio", "rede"],
        ),
        unique(
            state,
            "mart_comparativo_uf - unicidade de ano + sigla_uf + rede",
            ["ano", "sigla_uf", "rede"],
            ["sigla_uf", "rede"],
        ),
        unique(
            nation, "mart_comparativo_brasil - unicidade de ano + rede", ["ano", "rede"], ["rede"]
        ),
        not_null(
            place,
            "mart_comparativo_municipio - nulos em colunas obrigatórias",
            ["ano", "id_municipio", "rede"],
        ),
        not_null(
            state,
            "mart_comparativo_uf - nulos em colunas obrigatórias",
            ["ano", "sigla_uf", "rede"],
        ),
        not_null(
            nation, "mart_comparativo_brasil - nulos em colunas obrigatórias", ["ano", "rede"]
        ),
        in_range(
            place,
            "mart_comparativo_municipio - taxas devem estar entre 0.0 e 100.0",
            ["taxa_alfabetizacao_real", "taxa_alfabetizacao_microdados", "meta_taxa_alfabetizacao"],
            0.0,
            100.0,
        ),
        present(
            place,
            "mart_comparativo_municipio - agregados de microdados presentes",
            "total_alunos_microdados",
        ),
    ]
