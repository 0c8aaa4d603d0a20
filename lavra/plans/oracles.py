"""DuckDB statements with the results the registered queries must have.

They compute from the raw tables in one statement each, by the plain definition: metrics by
direct aggregation of the students, the public network as a second pass over its members.
"""

from __future__ import annotations

from lavra.plans import fixed

_YEARS = fixed.TARGET_YEARS


def _label(code: str) -> str:
    pairs = ", ".join(f"{k}: '{v}'" for k, v in fixed.NETWORK_LABELS.items())
    return f"coalesce((MAP {{{pairs}}})[{code}], '{fixed.NETWORK_UNKNOWN}')"


def _trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _place(nation: str, balance: str) -> str:
    return (
        f"CASE WHEN {balance} < 0 THEN NULL WHEN {balance} >= 9000 "
        f"THEN ({nation} + 900)::VARCHAR ELSE {nation}::VARCHAR END"
    )


_TARGET_COLUMNS = ", ".join(
    f"CASE WHEN (n + {y}) % 5 <> 0 THEN (45 + (n + {y}) % 30)::DOUBLE END AS meta_{y}"
    for y in _YEARS
)


def _targets(counted: str, keys: str = "") -> str:
    return f"""
    SELECT g.ano::BIGINT AS ano, {keys} 'Pública' AS rede,
           (40 + n % 20)::DOUBLE AS taxa_alfabetizacao, {_TARGET_COLUMNS},
           (n % 9 + 1)::BIGINT AS nivel_alfabetizacao,
           (80 + n % 20)::DOUBLE AS percentual_participacao
    FROM ({counted}) CROSS JOIN generate_series(2023, 2030) AS g(ano)"""


_LEVEL_COLUMNS = ", ".join(
    f"round(100.0 * count(*) FILTER (o_custkey % 9 = {n}) / count(*) + 1e-8, 6)"
    f" AS proporcao_aluno_nivel_{n}"
    for n in fixed.LEVELS
)


def _results(place: str, joins: str = "") -> str:
    return f"""
    SELECT (year(o_orderdate) + 29)::BIGINT AS ano, {place}, 2::BIGINT AS serie,
           substr(o_orderpriority, 1, 1)::BIGINT AS code,
           100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*) AS taxa_alfabetizacao,
           avg(o_totalprice) / 1000 AS media_portugues, {_LEVEL_COLUMNS}
    FROM orders JOIN customer ON o_custkey = c_custkey {joins}
    GROUP BY ALL"""


def _metrics() -> str:
    return """
    count(id_aluno)::BIGINT AS total_alunos_microdados,
    sum(presenca)::BIGINT AS total_presentes_microdados,
    sum(preenchimento_caderno)::BIGINT AS total_validos_microdados,
    sum(alfabetizado)::BIGINT AS total_alfabetizados_microdados,
    sum(alfabetizado * peso_aluno) / nullif(sum(preenchimento_caderno * peso_aluno), 0) * 100
      AS taxa_alfabetizacao_microdados,
    sum(proficiencia * peso_aluno) / nullif(sum(peso_aluno) FILTER (proficiencia IS NOT NULL), 0)
      AS media_proficiencia_microdados"""


def _indicators(dims: str) -> str:
    """Metrics per year, `dims` (with a trailing comma) and network, plus the public rows."""
    members = ", ".join(f"'{m}'" for m in fixed.NETWORK_ROLLUP_MEMBERS)
    return f"""
    SELECT ano, {dims} rede, {_metrics()} FROM students GROUP BY ALL
    UNION ALL
    SELECT ano, {dims} '{fixed.NETWORK_ROLLUP}' AS rede, {_metrics()}
    FROM students WHERE rede IN ({members}) GROUP BY ALL"""


_RAW_ORDER = (
    "_ingested_at DESC NULLS LAST, id_municipio NULLS FIRST, id_escola NULLS FIRST, "
    "caderno NULLS FIRST, serie NULLS FIRST, rede NULLS FIRST, presenca NULLS FIRST, "
    "preenchimento_caderno NULLS FIRST, alfabetizado NULLS FIRST, "
    "proficiencia NULLS FIRST, peso_aluno NULLS FIRST, _source_file NULLS FIRST"
)


def _latest(raw: str) -> str:
    return f"""
    SELECT * FROM {raw}
    QUALIFY row_number() OVER (PARTITION BY id_aluno, ano ORDER BY {_RAW_ORDER}) = 1"""


def _clean_students(latest: str) -> str:
    return f"""
    SELECT ano, d.id_municipio, sigla_uf, {_trim("id_escola")} AS id_escola,
           {_trim("id_aluno")} AS id_aluno, caderno, serie,
           {_label("rede::BIGINT")} AS rede, presenca, preenchimento_caderno, alfabetizado,
           proficiencia, peso_aluno
    FROM {latest} s JOIN dim d ON lpad(s.id_municipio, 7, '0') = d.id_municipio"""


def _rejected(raw: str) -> str:
    return f"""
    SELECT r.*, '{fixed.QUARANTINE_REASON}' AS _motivo_quarentena
    FROM {raw} r LEFT JOIN dim d ON lpad(r.id_municipio, 7, '0') = d.id_municipio
    WHERE d.id_municipio IS NULL"""


# Named pieces; a statement is preceded by the pieces it needs.
_PIECES: dict[str, tuple[str, tuple[str, ...]]] = {
    "dim": (
        """
    SELECT lpad(n_nationkey::VARCHAR, 7, '0') AS id_municipio, n_name AS nome_municipio,
           upper(substr(r_name, 1, 2)) AS sigla_uf, r_name AS nome_uf,
           r_regionkey::BIGINT AS id_uf, upper(substr(r_name, 1, 1)) AS sigla_regiao,
           r_name AS nome_regiao
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
        (),
    ),
    "raw_students": (
        f"""
    SELECT (year(l_shipdate) + 29)::BIGINT AS ano,
           {_place("s_nationkey", "s_acctbal")} AS id_municipio,
           ' ' || l_suppkey || chr(9) AS id_escola,
           l_orderkey || '-' || l_linenumber AS id_aluno, l_linenumber::BIGINT AS caderno,
           2::BIGINT AS serie, (1 + l_orderkey % 4)::VARCHAR AS rede,
           present::BIGINT AS presenca, valid::BIGINT AS preenchimento_caderno,
           (valid AND l_discount >= 0.05)::BIGINT AS alfabetizado,
           CASE WHEN valid THEN l_extendedprice END AS proficiencia,
           CASE WHEN present THEN l_quantity END AS peso_aluno,
           l_shipdate AS _ingested_at, 'lineitem' AS _source_file
    FROM (SELECT *, l_returnflag <> 'R' AS present,
                 l_returnflag <> 'R' AND l_linestatus = 'F' AS valid FROM lineitem)
    JOIN supplier ON l_suppkey = s_suppkey""",
        (),
    ),
    "latest_students": (_latest("raw_students"), ("raw_students",)),
    "students": (_clean_students("latest_students"), ("latest_students", "dim")),
    "raw_events": (
        """
    SELECT (2023 + day(ts) // 16)::BIGINT AS ano, (user_id % 30)::VARCHAR AS id_municipio,
           event_type AS id_escola, user_id::VARCHAR AS id_aluno,
           (props::JSON ->> '$.k')::BIGINT AS caderno, 2::BIGINT AS serie,
           user_id % 8 AS rede, (event_type <> 'error')::BIGINT AS presenca,
           valid::BIGINT AS preenchimento_caderno,
           (valid AND value > 50)::BIGINT AS alfabetizado,
           CASE WHEN valid THEN value END AS proficiencia,
           CASE WHEN event_type <> 'error' THEN (1 + user_id % 3)::DOUBLE END AS peso_aluno,
           ts AS _ingested_at, 'events' AS _source_file
    FROM (SELECT *, event_type IN ('view', 'click', 'purchase') AS valid FROM events)""",
        (),
    ),
    "latest_events": (_latest("raw_events"), ("raw_events",)),
    "streamed": (_clean_students("latest_events"), ("latest_events", "dim")),
    "raw_place_results": (
        _results(f"{_place('c_nationkey', 'c_acctbal')} AS id_municipio"),
        (),
    ),
    "place_results": (
        f"""
    SELECT r.* REPLACE (d.id_municipio AS id_municipio) , sigla_uf, {_label("code")} AS rede
    FROM raw_place_results r JOIN dim d ON lpad(r.id_municipio, 7, '0') = d.id_municipio""",
        ("raw_place_results", "dim"),
    ),
    "state_results": (
        f"""
    SELECT *, {_label("code")} AS rede FROM ({
            _results(
                "upper(substr(r_name, 1, 2)) AS sigla_uf",
                "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
            )
        })""",
        (),
    ),
    "raw_place_targets": (
        _targets(
            f"SELECT {_place('c_nationkey', 'c_acctbal')} AS id_municipio, count(*) AS n "
            "FROM customer GROUP BY ALL",
            "id_municipio,",
        ),
        (),
    ),
    "place_targets": (
        """
    SELECT r.* REPLACE (d.id_municipio AS id_municipio), sigla_uf
    FROM raw_place_targets r JOIN dim d ON lpad(r.id_municipio, 7, '0') = d.id_municipio""",
        ("raw_place_targets", "dim"),
    ),
    "state_targets": (
        "SELECT * EXCLUDE (nivel_alfabetizacao) FROM ("
        + _targets(
            "SELECT upper(substr(r_name, 1, 2)) AS sigla_uf, count(*) AS n FROM customer "
            "JOIN nation ON c_nationkey = n_nationkey "
            "JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
            "sigla_uf,",
        )
        + ")",
        (),
    ),
    "nation_targets": (
        "SELECT * EXCLUDE (nivel_alfabetizacao) FROM ("
        + _targets("SELECT count(*) AS n FROM customer")
        + ")",
        (),
    ),
    "place_indicators": (_indicators("id_municipio,"), ("students",)),
    "state_indicators": (_indicators("sigla_uf,"), ("students",)),
    "nation_indicators": (_indicators(""), ("students",)),
}


def _with(needed: tuple[str, ...], statement: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _PIECES[name][1]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        visit(name)
    if not ordered:
        return statement
    pieces = ", ".join(f"{name} AS ({_PIECES[name][0]})" for name in ordered)
    return f"WITH {pieces} {statement}"


# --- marts

_PICK = "CASE ano " + " ".join(f"WHEN {y} THEN meta_{y}" for y in _YEARS) + " END"


def _mart(level: str, keys: str, place_columns: str, place_join: str) -> str:
    """A comparison mart; `keys` are the join keys besides year and network."""
    using = f"k.ano = {{0}}.ano AND k.rede = {{0}}.rede" + "".join(
        f" AND k.{k} = {{0}}.{k}" for k in keys.split()
    )
    listed = ", ".join(["ano", *keys.split(), "rede"])
    official = level != "nation"
    inputs = [f"{level}_targets", f"{level}_indicators"]
    inputs += [f"{level}_results"] if official else []
    spine = " UNION ".join(f"SELECT {listed} FROM {i}" for i in inputs)
    actual = "o.taxa_alfabetizacao" if official else "m.taxa_alfabetizacao"
    columns = [
        ", ".join(f"k.{c}" for c in listed.split(", ")),
        place_columns,
        f"round({actual} + 1e-8, 6) AS taxa_alfabetizacao_real",
        "round(o.media_portugues + 1e-8, 6) AS media_portugues_real" if official else "",
        "m.target AS meta_taxa_alfabetizacao",
        "m.taxa_alfabetizacao AS taxa_alfabetizacao_base_meta" if official else "",
        "m.nivel_alfabetizacao" if level == "place" else "",
        f"round({actual} - m.target + 1e-8, 6) AS desvio_meta_real",
        f"{actual} >= m.target AS atingiu_meta_real",
        "s.total_alunos_microdados, s.total_presentes_microdados, s.total_validos_microdados, "
        "s.total_alfabetizados_microdados",
        "round(s.taxa_alfabetizacao_microdados + 1e-8, 6) AS taxa_alfabetizacao_microdados",
        "round(s.media_proficiencia_microdados + 1e-8, 6) AS media_proficiencia_microdados",
        "round(s.taxa_alfabetizacao_microdados - m.target + 1e-8, 6) AS desvio_meta_microdados",
        "s.taxa_alfabetizacao_microdados >= m.target AS atingiu_meta_microdados",
    ]
    results = f"LEFT JOIN {level}_results o ON {using.format('o')}" if official else ""
    return f"""
    SELECT {", ".join(c for c in columns if c)}
    FROM ({spine}) k {place_join} {results}
    LEFT JOIN (SELECT *, {_PICK} AS target FROM {level}_targets) m ON {using.format("m")}
    LEFT JOIN {level}_indicators s ON {using.format("s")}"""


_PLACE_MART = _mart(
    "place",
    "id_municipio",
    "d.nome_municipio, d.sigla_uf, d.nome_uf, d.nome_regiao",
    "JOIN dim d ON k.id_municipio = d.id_municipio",
)
_STATE_MART = _mart(
    "state",
    "sigla_uf",
    "d.nome_uf, d.nome_regiao",
    "LEFT JOIN (SELECT DISTINCT sigla_uf, nome_uf, nome_regiao FROM dim) d "
    "ON k.sigla_uf = d.sigla_uf",
)
_NATION_MART = _mart("nation", "", "", "")
_PLACE_NEEDS = ("place_results", "place_targets", "place_indicators", "dim")
_STATE_NEEDS = ("state_results", "state_targets", "state_indicators", "dim")
_NATION_NEEDS = ("nation_targets", "nation_indicators")


def _result_columns(place: str) -> str:
    levels = ", ".join(f"proporcao_aluno_nivel_{n}" for n in fixed.LEVELS)
    return (
        f"ano, {place}, serie, rede, round(taxa_alfabetizacao + 1e-8, 6) AS taxa_alfabetizacao, "
        f"round(media_portugues + 1e-8, 6) AS media_portugues, {levels}"
    )


def _raw_target_names(source: str) -> str:
    """Target rows as they arrive: untrimmed label, source names, fractional level."""
    renamed = ", ".join(f"meta_{y} AS meta_alfabetizacao_{y}" for y in _YEARS)
    return f"""
    SELECT ano::INTEGER AS ano, id_municipio, ' Pública' || chr(9) AS rede, taxa_alfabetizacao,
           {renamed}, nivel_alfabetizacao - 0.5::DOUBLE AS nivel_alfabetizacao,
           percentual_participacao, _motivo_quarentena
    FROM ({_rejected(source)})"""


def _raw_result_names(source: str) -> str:
    return f"""
    SELECT * EXCLUDE (code) REPLACE (round(taxa_alfabetizacao + 1e-8, 6) AS taxa_alfabetizacao,
           round(media_portugues + 1e-8, 6) AS media_portugues), code AS rede
    FROM ({_rejected(source)})"""


# --- quality


def _check(name: str, failed: str, critical: bool = True) -> str:
    bad = "FAIL" if critical else "WARN"
    return f"""
    SELECT '{name}' AS check_name, failed::BIGINT AS failed_count,
           CASE WHEN failed = 0 THEN 'PASS' ELSE '{bad}' END AS status,
           {str(critical).lower()} AS critical
    FROM ({failed})"""


def _union(*statements: str) -> str:
    return " UNION ALL ".join(statements)


def _repeats(table: str, key: str) -> str:
    return f"SELECT count(*) - count(DISTINCT {key}) AS failed FROM {table}"


def _count(table: str, condition: str = "true") -> str:
    return f"SELECT count(*) AS failed FROM {table} WHERE {condition}"


def _unknown(table: str) -> str:
    return (
        f"SELECT count(*) AS failed FROM {table} t "
        "WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.id_municipio = t.id_municipio)"
    )


def _silver_suite() -> str:
    person = "(coalesce(id_aluno, '') || '-' || ano)"
    required = "id_aluno IS NULL OR id_municipio IS NULL OR ano IS NULL OR alfabetizado IS NULL"
    flags = "presenca NOT IN (0, 1) OR alfabetizado NOT IN (0, 1)"
    known = {
        "dados_alunos": "students",
        "dados_alunos_streaming": "streamed",
        "avaliacao_alfabetizacao_municipio": "place_results",
        "meta_alfabetizacao_municipio": "place_targets",
    }
    raw = {
        "meta_alfabetizacao_municipio": "raw_place_targets",
        "avaliacao_alfabetizacao_municipio": "raw_place_results",
        "dados_alunos": "latest_students",
        "dados_alunos_streaming": "latest_events",
    }
    checks = [
        _check("dim_localidades - unicidade de id_municipio", _repeats("dim", "id_municipio")),
        _check(
            "meta_alfabetizacao_uf - unicidade de ano + sigla_uf + rede",
            _repeats("state_targets", "(ano || '-' || sigla_uf || '-' || rede)"),
        ),
        _check(
            "dim_localidades - nulos em chaves e colunas obrigatórias",
            _count("dim", "id_municipio IS NULL OR sigla_uf IS NULL OR nome_municipio IS NULL"),
        ),
        _check(
            "avaliacao_alfabetizacao_uf - taxa_alfabetizacao deve estar entre 0.0 e 100.0",
            _count("state_results", "taxa_alfabetizacao NOT BETWEEN 0 AND 100"),
            critical=False,
        ),
    ]
    for name in ("dados_alunos", "dados_alunos_streaming"):
        checks += [
            _check(f"{name} - unicidade de id_aluno por ano", _repeats(known[name], person)),
            _check(f"{name} - nulos em colunas obrigatórias", _count(known[name], required)),
            _check(
                f"{name} - presenca e alfabetizado devem ser 0 ou 1", _count(known[name], flags)
            ),
        ]
    for name, table in known.items():
        checks.append(
            _check(f"{name} - id_municipio inexistente em dim_localidades", _unknown(table))
        )
    for name, table in raw.items():
        checks.append(
            _check(
                f"{name} - volume em quarentena",
                f"SELECT count(*) AS failed FROM ({_rejected(table)})",
                critical=False,
            )
        )
    places = ("place_results", "place_targets", "state_results", "state_targets")
    return _with(("students", "streamed", *places), _union(*checks))


def _gold_suite() -> str:
    place, state, nation = "place_mart", "state_mart", "nation_mart"
    place_key = "(ano || '-' || coalesce(id_municipio, '') || '-' || coalesce(rede, ''))"
    rates = ("taxa_alfabetizacao_real", "taxa_alfabetizacao_microdados", "meta_taxa_alfabetizacao")
    outside = " OR ".join(f"{r} NOT BETWEEN 0 AND 100" for r in rates)
    checks = _union(
        _check(
            "mart_comparativo_municipio - unicidade de ano + id_municipio + rede",
            _repeats(place, place_key),
        ),
        _check(
            "mart_comparativo_uf - unicidade de ano + sigla_uf + rede",
            _repeats(state, "(ano || '-' || coalesce(sigla_uf, '') || '-' || coalesce(rede, ''))"),
        ),
        _check(
            "mart_comparativo_brasil - unicidade de ano + rede",
            _repeats(nation, "(ano || '-' || coalesce(rede, ''))"),
        ),
        _check(
            "mart_comparativo_municipio - nulos em colunas obrigatórias",
            _count(place, "ano IS NULL OR id_municipio IS NULL OR rede IS NULL"),
        ),
        _check(
            "mart_comparativo_uf - nulos em colunas obrigatórias",
            _count(state, "ano IS NULL OR sigla_uf IS NULL OR rede IS NULL"),
        ),
        _check(
            "mart_comparativo_brasil - nulos em colunas obrigatórias",
            _count(nation, "ano IS NULL OR rede IS NULL"),
        ),
        _check(
            "mart_comparativo_municipio - taxas devem estar entre 0.0 e 100.0",
            _count(place, outside),
            critical=False,
        ),
        _check(
            "mart_comparativo_municipio - agregados de microdados presentes",
            f"SELECT (count(total_alunos_microdados) = 0)::BIGINT AS failed FROM {place}",
        ),
    )
    marts = ", ".join(
        f"{name} AS ({statement})"
        for name, statement in ((place, _PLACE_MART), (state, _STATE_MART), (nation, _NATION_MART))
    )
    needs = tuple(dict.fromkeys(_PLACE_NEEDS + _STATE_NEEDS + _NATION_NEEDS))
    return _with(needs, "").rstrip() + f", {marts} {checks}"


_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_STREAM_COLUMNS = (
    "ano, id_municipio, id_escola, id_aluno, caderno, serie, rede, presenca, "
    "preenchimento_caderno, alfabetizado, proficiencia, peso_aluno"
)

_INDICATOR_COLUMNS = (
    "* REPLACE (round(taxa_alfabetizacao_microdados + 1e-8, 6) AS taxa_alfabetizacao_microdados, "
    "round(media_proficiencia_microdados + 1e-8, 6) AS media_proficiencia_microdados)"
)

_LINE_METRICS = """
    count(l_orderkey)::BIGINT AS n_persons,
    sum((l_returnflag <> 'R')::BIGINT)::BIGINT AS n_present,
    sum((l_linestatus = 'F')::BIGINT)::BIGINT AS n_valid,
    sum((l_discount >= 0.05)::BIGINT)::BIGINT AS n_success,
    round(sum((l_discount >= 0.05)::BIGINT * l_quantity)
          / nullif(sum((l_linestatus = 'F')::BIGINT * l_quantity), 0) * 100 + 1e-8, 6) AS rate,
    round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0) + 1e-8, 6) AS score"""

_LINE_ORDER = (
    "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)


def _content(column: str) -> str:
    """What `scan_content` adds up: by the columns' names, their types being known."""
    if column in ("ts", "o_orderdate", "l_shipdate"):
        return f"floor(epoch({column})) / 1e6"
    if column == "embedding":
        return f"len({column})::DOUBLE"
    if column in _TEXT_COLUMNS:
        return f"strlen({column})::DOUBLE"
    return f"{column}::DOUBLE"


_TEXT_COLUMNS = frozenset(
    "r_name n_name c_name c_mktsegment s_name p_name p_brand p_type o_orderstatus "
    "o_orderpriority l_returnflag l_linestatus event_type props text lang source url html role".split()
)


def oracle_sql() -> dict[str, str]:
    silver = {
        "dim_localidades": _with(("dim",), "SELECT * FROM dim"),
        "meta_alfabetizacao_brasil": _with(("nation_targets",), "SELECT * FROM nation_targets"),
        "meta_alfabetizacao_uf": _with(("state_targets",), "SELECT * FROM state_targets"),
        "meta_alfabetizacao_municipio": _with(("place_targets",), "SELECT * FROM place_targets"),
        "quarentena_meta_alfabetizacao_municipio": _with(
            ("raw_place_targets", "dim"), _raw_target_names("raw_place_targets")
        ),
        "avaliacao_alfabetizacao_uf": _with(
            ("state_results",), f"SELECT {_result_columns('sigla_uf')} FROM state_results"
        ),
        "avaliacao_alfabetizacao_municipio": _with(
            ("place_results",),
            f"SELECT {_result_columns('id_municipio, sigla_uf')} FROM place_results",
        ),
        "quarentena_avaliacao_alfabetizacao_municipio": _with(
            ("raw_place_results", "dim"), _raw_result_names("raw_place_results")
        ),
        "dados_alunos": _with(("students",), "SELECT * FROM students"),
        "quarentena_dados_alunos": _with(
            ("latest_students", "dim"), _rejected("latest_students")
        ),
        "dados_alunos_streaming": _with(("streamed",), "SELECT * FROM streamed"),
        "quarentena_dados_alunos_streaming": _with(
            ("latest_events", "dim"), _rejected("latest_events")
        ),
    }
    marts = {
        "mart_comparativo_municipio": _with(_PLACE_NEEDS, _PLACE_MART),
        "mart_in_buckets": _with(_PLACE_NEEDS, _PLACE_MART),
        "mart_comparativo_uf": _with(_STATE_NEEDS, _STATE_MART),
        "mart_comparativo_brasil": _with(_NATION_NEEDS, _NATION_MART),
        "mart_frescor_streaming": _with(
            ("latest_events", "students", "dim"),
            """
    SELECT ano, count(*)::BIGINT AS eventos_ingeridos,
           count(DISTINCT id_aluno)::BIGINT AS alunos_distintos,
           count(DISTINCT e.id_municipio)::BIGINT AS municipios_cobertos,
           min(_ingested_at) AS primeiro_processamento, max(_ingested_at) AS ultimo_processamento,
           round(count(DISTINCT id_aluno)
                 / nullif((SELECT count(DISTINCT id_aluno) FROM students), 0) * 100 + 1e-8, 6)
             AS pct_cobertura_sobre_base_completa
    FROM latest_events e JOIN dim d ON lpad(e.id_municipio, 7, '0') = d.id_municipio
    GROUP BY ano""",
        ),
    }
    sources = {
        "scan_sources": _union(
            *[
                f"SELECT '{t}' AS table_name, count(*)::BIGINT AS row_count FROM {t}"
                for t in _TABLES
            ]
        ),
        "scan_content": _union(
            *[
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"count({column})::BIGINT AS n_values, "
                f"round(sum({_content(column)}) + 1e-8, 6) AS content FROM {table}"
                for table, columns in fixed.TEST_TABLES.items()
                for column in columns.split()
            ]
        ),
        "source_columns": "SELECT c_custkey, c_name, upper(c_name) AS extra FROM customer",
        "csv_text_roundtrip": """
    SELECT doc_id, strlen(text)::INTEGER AS n_bytes, md5(text) AS digest FROM (
      SELECT doc_id, CASE doc_id % 6
        WHEN 0 THEN '' WHEN 1 THEN '  ' || text || ' ' WHEN 2 THEN NULL
        WHEN 3 THEN 'say "hi", ' || text || '\\ and "'
        WHEN 4 THEN text || chr(13) || chr(10) || 'next, ' || chr(10) || '\\'
        ELSE text END AS text FROM documents)""",
        "csv_roundtrip": "SELECT * FROM customer",
        "reference_flatten": """
    SELECT c_custkey AS id_municipio, c_name AS nome_municipio, 'N' || n_nationkey AS sigla_uf,
           n_name AS nome_uf, n_nationkey::BIGINT AS id_uf,
           substr(r_name, 1, 2) AS sigla_regiao, r_name AS nome_regiao
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
        "snapshot_append_counts": """
    SELECT snapshot, count(*)::BIGINT AS row_count
    FROM (SELECT '2024-01-01' AS snapshot FROM orders
          UNION ALL SELECT '2024-01-02' FROM orders) GROUP BY snapshot""",
        "snapshot_read_latest": """
    SELECT o_orderstatus, 'orders' AS _source_file, count(*)::BIGINT AS row_count,
           '2024-01-02' AS snapshot
    FROM orders GROUP BY o_orderstatus""",
        "snapshot_latest": """
    SELECT * FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)""",
        "snapshot_latest_partition": """
    SELECT * FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)""",
        "replay_sample": """
    SELECT event_id, user_id, event_type, value, props FROM events ORDER BY event_id LIMIT 500""",
        "publish_partitioned": """
    SELECT year(l_shipdate)::INTEGER AS ship_year, l_returnflag, count(*)::BIGINT AS n_lines,
           round(sum(l_quantity) + 1e-8, 6) AS quantity
    FROM lineitem GROUP BY ALL""",
        "publish_changed_years": """
    SELECT year(l_shipdate)::INTEGER AS ship_year, l_returnflag, count(*)::BIGINT AS n_lines,
           round(sum(l_quantity + (year(l_shipdate) = 1995)::INTEGER) + 1e-8, 6) AS quantity
    FROM lineitem GROUP BY ALL""",
        "sample_limit": "SELECT * FROM events ORDER BY event_id LIMIT 500",
    }
    projections = {
        "label_codes": f"""
    SELECT l_orderkey % 8 AS code, {_label("l_orderkey % 8")} AS label,
           count(*)::BIGINT AS n_lines FROM lineitem GROUP BY ALL""",
        "trim_upper_codes": """
    SELECT c_custkey, lower(c_mktsegment) AS text, c_mktsegment AS code FROM customer""",
        "target_for_year": _with(
            ("place_targets",),
            f"SELECT ano, id_municipio, rede, {_PICK} AS meta_taxa_alfabetizacao "
            "FROM place_targets",
        ),
        "deviation_flag": """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P' AND c_acctbal >= 0
                THEN round(o_totalprice - c_acctbal * 20 + 1e-8, 6) END AS deviation,
           CASE WHEN o_orderstatus <> 'P' AND c_acctbal >= 0
                THEN o_totalprice >= c_acctbal * 20 END AS met
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    }
    splits = {
        "dedup_latest": f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""",
        "reference_valid": """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, o_orderdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
        "reference_quarantine": """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, 'order not finished' AS reason
    FROM lineitem WHERE NOT EXISTS (
      SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
        "conservation": _with(
            ("latest_students", "students"),
            f"""
    SELECT 'latest' AS table_name, count(*)::BIGINT AS row_count FROM latest_students
    UNION ALL SELECT 'valid', count(*) FROM students
    UNION ALL SELECT 'rejected', count(*) FROM ({_rejected("latest_students")})""",
        ),
    }
    indicators = {
        "indicator_place": _with(
            ("place_indicators",), f"SELECT {_INDICATOR_COLUMNS} FROM place_indicators"
        ),
        "indicator_region": _with(
            ("state_indicators",), f"SELECT {_INDICATOR_COLUMNS} FROM state_indicators"
        ),
        "indicator_total": _with(
            ("nation_indicators",), f"SELECT {_INDICATOR_COLUMNS} FROM nation_indicators"
        ),
        "rollup_member": f"""
    SELECT l_returnflag, p_brand, {_LINE_METRICS}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
    UNION ALL
    SELECT l_returnflag, 'Brand#1-3', {_LINE_METRICS}
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY ALL""",
        "key_spine": """
    SELECT year(o_orderdate)::INTEGER AS year, c_nationkey AS nation
    FROM orders JOIN customer ON o_custkey = c_custkey
    UNION
    SELECT year(l_shipdate)::INTEGER, CASE WHEN s_acctbal >= 0 THEN s_nationkey END
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    UNION
    SELECT NULL, s_nationkey FROM supplier""",
        "reconcile_mae": _with(
            ("students", "state_indicators", "state_results"),
            f"""
    , plain AS (
      SELECT ano, sigla_uf, rede, sum(alfabetizado) / nullif(sum(preenchimento_caderno), 0) * 100
               AS rate, avg(proficiencia) AS score
      FROM (SELECT * FROM students
            UNION ALL SELECT * REPLACE ('{fixed.NETWORK_ROLLUP}' AS rede) FROM students
            WHERE rede IN {fixed.NETWORK_ROLLUP_MEMBERS})
      GROUP BY ALL),
    gaps AS (
      SELECT abs(s.taxa_alfabetizacao_microdados - o.taxa_alfabetizacao) AS a,
             abs(p.rate - o.taxa_alfabetizacao) AS b,
             abs(s.media_proficiencia_microdados - o.media_portugues) AS c,
             abs(p.score - o.media_portugues) AS d
      FROM state_indicators s JOIN plain p USING (ano, sigla_uf, rede)
      JOIN state_results o USING (ano, sigla_uf, rede))
    SELECT round(avg(a) + 1e-8, 6) AS mae_rate_weighted,
           round(avg(b) + 1e-8, 6) AS mae_rate_plain,
           round(avg(c) + 1e-8, 6) AS mae_score_weighted,
           round(avg(d) + 1e-8, 6) AS mae_score_plain,
           count(a)::BIGINT AS mae_rate_weighted_keys, count(b)::BIGINT AS mae_rate_plain_keys,
           count(c)::BIGINT AS mae_score_weighted_keys, count(d)::BIGINT AS mae_score_plain_keys
    FROM gaps""",
        ),
    }
    line_key = "(l_orderkey || '-' || l_linenumber)"
    percent = "l_discount * 100 < 0 OR l_discount * 100 > 100"
    both = (
        "l_discount * 100 < 1 OR l_discount * 100 > 100 OR l_quantity < 1 OR l_quantity > 25"
    )
    quality = {
        "quality_unique": _union(
            _check("lines unique", _repeats("lineitem", line_key)),
            _check("latest unique", "SELECT 0 AS failed"),
        ),
        "quality_incremental": f"""
    WITH lines AS (
      SELECT * REPLACE (l_quantity + (year(l_shipdate) = 1995)::INTEGER AS l_quantity)
      FROM lineitem) {
            _union(
                _check(
                    "lines unique by year",
                    _repeats("lines", "(year(l_shipdate), l_orderkey, l_linenumber)"),
                ),
                _check("orders unique", _repeats("lines", "l_orderkey")),
                _check(
                    "key present",
                    _count(
                        "lines",
                        "l_shipdate IS NULL OR l_orderkey IS NULL OR l_linenumber IS NULL",
                    ),
                ),
                _check(
                    "quantity", _count("lines", "l_quantity < 0 OR l_quantity > 25"), False
                ),
                _check(
                    "order finished",
                    "SELECT count(*) AS failed FROM lines WHERE NOT EXISTS (SELECT 1 FROM orders "
                    "WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')",
                ),
                _check("any line", "SELECT (count(*) = 0)::BIGINT AS failed FROM lines"),
                _check("all lines", "SELECT count(*) AS failed FROM lines", False),
            )
        }""",
        "quality_abort": f"""
    SELECT 'silver' AS layer, *,
           'check [orders unique]: ' || max(failed_count) FILTER (check_name = 'orders unique')
             OVER () || ' violations' AS raised
    FROM ({
            _union(
                _check(
                    "quantity", _count("lineitem", "l_quantity < 0 OR l_quantity > 25"), False
                ),
                _check("orders unique", _repeats("lineitem", "l_orderkey")),
                _check(
                    "key present",
                    _count("lineitem", "l_orderkey IS NULL OR l_linenumber IS NULL"),
                ),
            )
        })""",
        "quality_adhoc": """
    SELECT 'quantity' AS check_name, false AS has_history,
           count(*) FILTER (l_quantity < 0 OR l_quantity > 25) AS failed_count FROM lineitem
    UNION ALL SELECT 'key present', false, count(*) FILTER (l_orderkey IS NULL) FROM lineitem
    UNION ALL SELECT 'all lines', false, count(*) FROM lineitem""",
        "processing_time": _with(
            ("place_targets", "raw_place_targets", "students", "dim"),
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*)::BIGINT AS n_rows, "
                f"least(count(*), 1)::BIGINT AS n_times FROM ({rows})"
                for name, rows in (
                    ("valid", "SELECT 1 FROM place_targets"),
                    ("rejected", _raw_target_names("raw_place_targets")),
                    ("students", "SELECT 1 FROM students"),
                )
            ),
        ),
        "quality_nulls": _union(
            _check("key present", _count("orders", "o_orderkey IS NULL")),
            _check(
                "all present",
                _count(
                    "orders",
                    "o_orderkey IS NULL OR o_orderpriority IS NULL "
                    "OR nullif(o_orderstatus, 'P') IS NULL",
                ),
            ),
        ),
        "quality_orphans": _union(
            _check(
                "order finished",
                "SELECT count(*) AS failed FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders "
                "WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')",
            ),
            _check(
                "order known",
                "SELECT count(*) AS failed FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders "
                "WHERE o_orderkey = l_orderkey)",
            ),
        ),
        "quality_domain": _union(
            _check(
                "flags are 0 or 1",
                _count("labels", "quality NOT IN (0, 1) OR toxic NOT IN (0, 1)"),
            ),
            _check("flags are 0", _count("labels", "quality <> 0 OR toxic <> 0")),
        ),
        "quality_range": _union(
            _check("percent", _count("lineitem", percent), critical=False),
            _check("both", _count("lineitem", both)),
        ),
        "quality_present": _with(
            ("place_indicators",),
            _union(
                _check(
                    "students present",
                    "SELECT (count(total_alunos_microdados) = 0)::BIGINT AS failed "
                    "FROM place_indicators",
                ),
                _check(
                    "nothing present",
                    "SELECT (count(CASE WHEN ano < 0 THEN ano END) = 0)::BIGINT AS failed "
                    "FROM place_indicators",
                ),
            ),
        ),
        "quality_suite_silver": _silver_suite(),
        "quality_suite_gold": _gold_suite(),
        "quality_history": f"""
    SELECT run_id, layer, status, count(*)::BIGINT AS n_checks,
           sum(failed_count)::BIGINT AS failed_count, executed_day
    FROM (
      SELECT 'run-1' AS run_id, 'raw' AS layer, '2024-01-01' AS executed_day, * FROM ({
            _union(
                _check("lines unique", _repeats("lineitem", line_key)),
                _check(
                    "quantity", _count("lineitem", "l_quantity < 0 OR l_quantity > 25"), False
                ),
            )
        })
      UNION ALL
      SELECT 'run-2', 'checked', '2024-01-02', * FROM ({
            _check(
                "keys present", _count("lineitem", "l_orderkey IS NULL OR l_linenumber IS NULL")
            )
        }))
    GROUP BY ALL""",
        "quality_trend": """
    SELECT strftime(ts, '%Y-%m-%d') AS dia,
           CASE WHEN value > 50 THEN 'FAIL' ELSE 'PASS' END AS status, user_id AS failed_count
    FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-17 00:00:00'""",
    }
    streams = {
        "events_decode": """
    SELECT (props::JSON ->> '$.k')::BIGINT AS k, (props::JSON ->> '$.missing')::DOUBLE AS missing,
           true AS good, count(*)::BIGINT AS n_events
    FROM events GROUP BY ALL""",
        "events_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
        "events_rejected": """
    SELECT CASE WHEN event_type <> 'view' THEN 'value is not double' END AS _bad_reason,
           count(*)::BIGINT AS n_events, sum(event_id)::BIGINT AS sum_event_id
    FROM events GROUP BY ALL""",
        "events_kept_messages": """
    SELECT CASE WHEN kind IN (0, 2) THEN event_id END AS event_id,
           CASE kind WHEN 0 THEN 1 WHEN 2 THEN 3 END::BIGINT AS k,
           CASE kind WHEN 1 THEN message || ' trailing' WHEN 3 THEN '[' || message || ']'
                     WHEN 4 THEN 'text ' || event_id END AS message,
           CASE WHEN kind NOT IN (0, 2) THEN 'not a JSON object' END AS reason
    FROM (SELECT event_id, event_id % 5 AS kind,
                 '{"event_id":' || event_id || ',"k":1}' AS message FROM events)""",
        "stream_batches": _with(
            ("raw_events",), f"SELECT {_STREAM_COLUMNS}, _source_file FROM raw_events"
        ),
        "stream_compacted": _with(
            ("raw_events",), f"SELECT {_STREAM_COLUMNS}, _source_file FROM raw_events"
        ),
        **{
            name: _with(
                ("raw_events",), f"SELECT {_STREAM_COLUMNS}, _source_file FROM raw_events"
            )
            for name in (
                "stream_bounded",
                "stream_late_events",
                "stream_once",
                "stream_redelivery",
            )
        },
        "stream_incremental": _with(
            ("raw_events",),
            f"""
    SELECT {_STREAM_COLUMNS} FROM (
      SELECT {_STREAM_COLUMNS}, 1 AS delivery FROM raw_events WHERE id_aluno::BIGINT % 5 <> 0
      UNION ALL
      SELECT * REPLACE (caderno + 1000 AS caderno), 2 AS delivery
      FROM (SELECT {_STREAM_COLUMNS} FROM raw_events) WHERE id_aluno::BIGINT % 2 = 0
      UNION ALL
      SELECT * REPLACE (9.0::DOUBLE AS peso_aluno), 3 AS delivery
      FROM (SELECT {_STREAM_COLUMNS} FROM raw_events) WHERE id_aluno::BIGINT % 3 = 0)
    QUALIFY row_number() OVER (
      PARTITION BY id_aluno, ano
      ORDER BY delivery DESC, id_municipio NULLS FIRST, id_escola NULLS FIRST,
               caderno NULLS FIRST, serie, rede, presenca, preenchimento_caderno,
               alfabetizado NULLS FIRST, proficiencia NULLS FIRST, peso_aluno NULLS FIRST) = 1""",
        ),
        "stream_latest_wins": _with(
            ("raw_events",),
            f"""
    SELECT {_STREAM_COLUMNS} FROM (
      SELECT {_STREAM_COLUMNS}, 1 AS delivery FROM raw_events UNION ALL
      SELECT * REPLACE (caderno + 1000 AS caderno, 9.0::DOUBLE AS peso_aluno), 2 AS delivery
      FROM (SELECT {_STREAM_COLUMNS} FROM raw_events) WHERE id_aluno::BIGINT % 2 = 0)
    QUALIFY row_number() OVER (
      PARTITION BY id_aluno, ano
      ORDER BY delivery DESC, id_municipio NULLS FIRST, id_escola NULLS FIRST,
               caderno NULLS FIRST, serie, rede, presenca, preenchimento_caderno,
               alfabetizado NULLS FIRST, proficiencia NULLS FIRST, peso_aluno NULLS FIRST) = 1""",
        ),
        "stream_ingest": _with(
            ("raw_events",), f"SELECT {_STREAM_COLUMNS}, _source_file FROM raw_events"
        ),
        "stream_dedup": _with(
            ("raw_events",),
            """
    SELECT id_aluno, ano, id_escola, max(proficiencia) AS proficiencia,
           max(caderno) FILTER (proficiencia IS NOT DISTINCT FROM top) AS caderno
    FROM (SELECT *, max(proficiencia) OVER (PARTITION BY id_aluno, ano, id_escola) AS top
          FROM raw_events)
    GROUP BY id_aluno, ano, id_escola""",
        ),
    }
    return {
        **silver, **marts, **sources, **projections, **splits, **indicators, **quality, **streams
    }
