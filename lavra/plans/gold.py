"""Gold: comparison marts by place, state and nation, and the streaming freshness mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import for_year
from lavra.operators import indicator
from lavra.operators.bucketed import bucketed_lookup, spine_in_buckets
from lavra.operators.compare import key_spine, verdicts
from lavra.operators.freshness import FreshnessNames, freshness
from lavra.operators.joins import lookup_join
from lavra.plans import fixed
from lavra.plans.silver import PROCESSED_AT
from lavra.runtime import bounded, materialize, narrowed
from lavra.sources.tables import Layout

LAYOUTS = {
    "mart_comparativo_municipio": Layout(("ano",), ("sigla_uf", "id_municipio")),
    "mart_comparativo_uf": Layout(("ano",), ("sigla_uf",)),
    "mart_comparativo_brasil": Layout(),
    "mart_frescor_streaming": Layout(),
}

MEASURES = indicator.Measures(
    person="id_aluno",
    present="presenca",
    valid="preenchimento_caderno",
    success="alfabetizado",
    score="proficiencia",
    weight="peso_aluno",
)

_OFFICIAL = ["taxa_alfabetizacao_real", "media_portugues_real"]
_TARGET = ["meta_taxa_alfabetizacao", "taxa_alfabetizacao_base_meta"]
_REAL_VERDICT = ["desvio_meta_real", "atingiu_meta_real"]
_STUDENTS = [
    "total_alunos_microdados",
    "total_presentes_microdados",
    "total_validos_microdados",
    "total_alfabetizados_microdados",
    "taxa_alfabetizacao_microdados",
    "media_proficiencia_microdados",
]
_STUDENT_VERDICT = ["desvio_meta_microdados", "atingiu_meta_microdados"]

PLACE_COLUMNS = [
    "ano",
    "id_municipio",
    "nome_municipio",
    "sigla_uf",
    "nome_uf",
    "nome_regiao",
    "rede",
    *_OFFICIAL,
    *_TARGET,
    "nivel_alfabetizacao",
    *_REAL_VERDICT,
    *_STUDENTS,
    *_STUDENT_VERDICT,
]
STATE_COLUMNS = [
    "ano",
    "sigla_uf",
    "nome_uf",
    "nome_regiao",
    "rede",
    *_OFFICIAL,
    *_TARGET,
    *_REAL_VERDICT,
    *_STUDENTS,
    *_STUDENT_VERDICT,
]
NATION_COLUMNS = [
    "ano",
    "rede",
    "taxa_alfabetizacao_real",
    "meta_taxa_alfabetizacao",
    *_REAL_VERDICT,
    *_STUDENTS,
    *_STUDENT_VERDICT,
]

FRESHNESS_NAMES = FreshnessNames(
    rows="eventos_ingeridos",
    persons="alunos_distintos",
    places="municipios_cobertos",
    first="primeiro_processamento",
    last="ultimo_processamento",
    coverage="pct_cobertura_sobre_base_completa",
)


def student_components(students: DataFrame) -> DataFrame:
    """The one pass over the students; all three marts start from its small result.

    A place lies in one state, so adding the state to the grain adds no rows.
    """
    return indicator.components(students, ["ano", "id_municipio", "sigla_uf", "rede"], MEASURES)


def student_indicators(parts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts, weighted rate and weighted mean score per year, `dims` and network, with the
    rolled-up public network as rows of its own."""
    keys = ["ano", *dims]
    rolled = indicator.roll_up(
        parts, keys, "rede", fixed.NETWORK_ROLLUP, fixed.NETWORK_ROLLUP_MEMBERS
    )
    return rolled.select(
        *keys,
        "rede",
        F.col("n_persons").alias("total_alunos_microdados"),
        F.col("n_present").alias("total_presentes_microdados"),
        F.col("n_valid").alias("total_validos_microdados"),
        F.col("n_success").alias("total_alfabetizados_microdados"),
        indicator.success_rate().alias("taxa_alfabetizacao_microdados"),
        indicator.mean_score().alias("media_proficiencia_microdados"),
    )


def targets_of_year(targets: DataFrame, keys: Sequence[str], *more) -> DataFrame:
    """The target of each row's own year; years without a target column get NULL."""
    target = for_year(F.col("ano"), fixed.TARGET_YEARS, "meta_{year}")
    return targets.select(*keys, target.alias("meta_taxa_alfabetizacao"), *more)


def _official(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    return results.select(
        *keys,
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_real"),
        F.col("media_portugues").alias("media_portugues_real"),
    )


def _judge(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    judged = verdicts(
        joined,
        "meta_taxa_alfabetizacao",
        [
            ("taxa_alfabetizacao_real", *_REAL_VERDICT),
            ("taxa_alfabetizacao_microdados", *_STUDENT_VERDICT),
        ],
    )
    return judged.select(*columns, F.current_timestamp().alias(PROCESSED_AT))


def place_mart(
    parts: DataFrame, results: DataFrame, targets: DataFrame, dim: DataFrame, buckets: int = 0
) -> DataFrame:
    """Per year, place and network; keys of unknown places are left out.

    With `buckets`, results, targets and indicators are written in so many buckets by their key
    and joined in place; without, small ones are broadcast and large ones shuffled.
    """
    keys = ["ano", "id_municipio", "rede"]
    own = _written(student_indicators(parts, ["id_municipio"]))
    target = targets_of_year(
        targets,
        keys,
        F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_base_meta"),
        "nivel_alfabetizacao",
    )
    names = dim.select("id_municipio", "nome_municipio", "sigla_uf", "nome_uf", "nome_regiao")
    if buckets:
        spine, tables = spine_in_buckets([_official(results, keys), target, own], keys, buckets)
        joined = bucketed_lookup(spine, tables, keys)
        return _judge(joined.join(bounded(narrowed(names, dim)), "id_municipio"), PLACE_COLUMNS)
    spine = key_spine([results, targets, own], keys)
    spine = spine.join(bounded(narrowed(names, dim)), "id_municipio")
    sides = [narrowed(_official(results, keys), results), narrowed(target, targets), own]
    return _judge(lookup_join(spine, sides, keys), PLACE_COLUMNS)


def state_mart(
    parts: DataFrame, results: DataFrame, targets: DataFrame, dim: DataFrame
) -> DataFrame:
    """Per year, state and network; states unknown to the dimension stay, without names."""
    keys = ["ano", "sigla_uf", "rede"]
    own = _written(student_indicators(parts, ["sigla_uf"]))
    target = targets_of_year(
        targets, keys, F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_base_meta")
    )
    names = dim.select("sigla_uf", "nome_uf", "nome_regiao").distinct()
    spine = key_spine([results, targets, own], keys)
    spine = lookup_join(spine, [narrowed(names, dim)], ["sigla_uf"])
    sides = [narrowed(_official(results, keys), results), narrowed(target, targets), own]
    return _judge(lookup_join(spine, sides, keys), STATE_COLUMNS)


def nation_mart(parts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per year and network; the actual rate comes with the targets, there is no separate
    result table at this level."""
    keys = ["ano", "rede"]
    own = _written(student_indicators(parts, []))
    target = targets_of_year(
        targets, keys, F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_real")
    )
    spine = key_spine([targets, own], keys)
    return _judge(lookup_join(spine, [narrowed(target, targets), own], keys), NATION_COLUMNS)


def _written(indicators: DataFrame) -> DataFrame:
    """The spine and the join share one computation, measured as it is written."""
    return materialize(indicators, "indicators", measured=True)


def freshness_mart(stream: DataFrame, students: DataFrame) -> DataFrame:
    """Volume and coverage of the streamed sample per year."""
    mart = freshness(
        stream, students, "ano", "id_aluno", "id_municipio", PROCESSED_AT, FRESHNESS_NAMES
    )
    return mart.withColumn(PROCESSED_AT, F.current_timestamp())
