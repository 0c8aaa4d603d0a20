"""Silver: typed, keyed, deduplicated tables, and the rows rejected on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import pad_key
from lavra.operators.conform import Field, numbers_by_year, project
from lavra.operators.dedup import latest_by
from lavra.operators.reference import KNOWN, enrich, mark, quarantine
from lavra.plans import fixed
from lavra.sources.ledger import INGESTED_AT
from lavra.sources.tables import Layout

PROCESSED_AT = "_processed_at"

_PLACE = Field("id_municipio", "key", width=fixed.PLACE_KEY_WIDTH)
_STATE_OF_PLACE = Field("sigla_uf")
_NETWORK_CODE = Field(
    "rede", "label", labels=fixed.NETWORK_LABELS, default=fixed.NETWORK_UNKNOWN
)
_NETWORK_TEXT = Field("rede", "text")
_YEAR = Field("ano", "whole")
_TARGETS = [
    Field("taxa_alfabetizacao", "number"),
    *numbers_by_year("meta_{year}", "meta_alfabetizacao_{year}", fixed.TARGET_YEARS),
]
_PARTICIPATION = Field("percentual_participacao", "number")
_RESULTS = [
    Field("serie", "whole"),
    _NETWORK_CODE,
    Field("taxa_alfabetizacao", "number"),
    Field("media_portugues", "number"),
    *[Field(f"proporcao_aluno_nivel_{n}", "number") for n in fixed.LEVELS],
]

PLACES = [
    _PLACE,
    Field("nome_municipio", "text"),
    Field("sigla_uf", "code"),
    Field("nome_uf", "text"),
    Field("id_uf", "whole"),
    Field("sigla_regiao", "code"),
    Field("nome_regiao", "text"),
]
NATION_TARGETS = [_YEAR, _NETWORK_TEXT, *_TARGETS, _PARTICIPATION]
STATE_TARGETS = [_YEAR, Field("sigla_uf", "code"), _NETWORK_TEXT, *_TARGETS, _PARTICIPATION]
PLACE_TARGETS = [
    _YEAR,
    _PLACE,
    _STATE_OF_PLACE,
    _NETWORK_TEXT,
    *_TARGETS,
    Field("nivel_alfabetizacao", "whole"),
    _PARTICIPATION,
]
STATE_RESULTS = [_YEAR, Field("sigla_uf", "code"), *_RESULTS]
PLACE_RESULTS = [_YEAR, _PLACE, _STATE_OF_PLACE, *_RESULTS]
STUDENTS = [
    _YEAR,
    _PLACE,
    _STATE_OF_PLACE,
    Field("id_escola", "text"),
    Field("id_aluno", "text"),
    Field("caderno", "whole"),
    Field("serie", "whole"),
    _NETWORK_CODE,
    Field("presenca", "whole"),
    Field("preenchimento_caderno", "whole"),
    Field("alfabetizado", "whole"),
    Field("proficiencia", "number"),
    Field("peso_aluno", "number"),
]

LAYOUTS = {
    "dim_localidades": Layout(cluster=("sigla_uf",)),
    "meta_alfabetizacao_brasil": Layout(),
    "meta_alfabetizacao_uf": Layout(cluster=("sigla_uf",)),
    "meta_alfabetizacao_municipio": Layout(cluster=("sigla_uf", "id_municipio")),
    "quarentena_meta_alfabetizacao_municipio": Layout(),
    "avaliacao_alfabetizacao_uf": Layout(("ano",), ("sigla_uf",)),
    "avaliacao_alfabetizacao_municipio": Layout(("ano",), ("sigla_uf", "id_municipio")),
    "quarentena_avaliacao_alfabetizacao_municipio": Layout(),
    "dados_alunos": Layout(("ano",), ("sigla_uf", "id_municipio")),
    "quarentena_dados_alunos": Layout(),
    "dados_alunos_streaming": Layout(("ano",), ("sigla_uf", "id_municipio")),
    "quarentena_dados_alunos_streaming": Layout(),
}


# Raw columns that name a student in a year.
STUDENT_KEYS = ("id_aluno", "ano")


def _processed(df: DataFrame) -> DataFrame:
    return df.withColumn(PROCESSED_AT, F.current_timestamp())


def places(bronze: DataFrame) -> DataFrame:
    return _processed(project(bronze, PLACES))


def nation_targets(bronze: DataFrame) -> DataFrame:
    return _processed(project(bronze, NATION_TARGETS))


def state_targets(bronze: DataFrame) -> DataFrame:
    return _processed(project(bronze, STATE_TARGETS))


def state_results(bronze: DataFrame) -> DataFrame:
    return _processed(project(bronze, STATE_RESULTS))


def place_targets(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    return _processed(project(_known(bronze, dim), PLACE_TARGETS))


def place_results(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    return _processed(project(_known(bronze, dim), PLACE_RESULTS))


def latest_students(bronze: DataFrame) -> DataFrame:
    """One raw row per student and year, keyed on the raw values.

    Valid and rejected students both come from this ranking, so none is in both or lost.
    """
    return latest_by(bronze, STUDENT_KEYS, [INGESTED_AT])


def students(latest: DataFrame, dim: DataFrame) -> DataFrame:
    """Students of known places; a student whose latest row is rejected is not here."""
    return _processed(project(_known(latest, dim), STUDENTS))


def rejected(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    """Raw rows of unknown places, with the reason and the time."""
    return quarantine(bronze, dim, place_key(), "id_municipio", _rejection())


def marked_students(latest: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest rows with their state and whether their place is known; see `split_students`."""
    return mark(latest, dim.select("id_municipio", "sigla_uf"), place_key(), "id_municipio")


def split_students(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same two tables as `students` and `rejected`, without joining twice."""
    valid = marked.where(F.col(KNOWN)).drop(KNOWN)
    unknown = marked.where(~F.col(KNOWN)).drop(KNOWN, "sigla_uf")
    return _processed(project(valid, STUDENTS)), unknown.withColumns(_rejection())


def place_key() -> Column:
    return pad_key(F.col("id_municipio"), fixed.PLACE_KEY_WIDTH)


def _known(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    side = dim.select("id_municipio", "sigla_uf")
    return enrich(bronze, side, place_key(), "id_municipio")


def _rejection() -> dict[str, Column]:
    return {
        "_motivo_quarentena": F.lit(fixed.QUARANTINE_REASON),
        "_quarantined_at": F.current_timestamp(),
    }
