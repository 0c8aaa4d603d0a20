"""Names, codes and labels of the domain."""

# They must equal the published tables so that existing queries keep working.

NETWORK_LABELS = {
    0: "Total",
    1: "Federal",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Pública",
    6: "Pública",
}
NETWORK_UNKNOWN = "Desconhecida"
NETWORK_ROLLUP = "Pública"
NETWORK_ROLLUP_MEMBERS = ("Estadual", "Municipal")

TARGET_YEARS = (2024, 2025, 2026, 2027, 2028, 2029, 2030)
LEVELS = (0, 1, 2, 3, 4, 5, 6, 7, 8)
PLACE_KEY_WIDTH = 7

QUARANTINE_REASON = "id_municipio não encontrado em dim_localidades"

# Published name of each batch source, and its Bronze table.
PUBLISHED_NAMES = {
    "meta_alfabetizacao_brasil": "meta_alfabetizacao_brasil",
    "meta_alfabetizacao_uf": "meta_alfabetizacao_uf",
    "meta_alfabetizacao_municipio": "meta_alfabetizacao_municipio",
    "uf": "avaliacao_alfabetizacao_uf",
    "municipio": "avaliacao_alfabetizacao_municipio",
    "alunos": "dados_alunos",
}

PLACES_SCHEMA = (
    "id_municipio bigint, nome_municipio string, sigla_uf string, nome_uf string, "
    "id_uf bigint, sigla_regiao string, nome_regiao string"
)

STUDENT_EVENT_SCHEMA = (
    "ano bigint, id_municipio string, id_escola string, id_aluno string, caderno bigint, "
    "serie bigint, rede bigint, presenca bigint, preenchimento_caderno bigint, "
    "alfabetizado bigint, proficiencia double, peso_aluno double"
)

# In the batch load the network code arrives as text.
STUDENT_BATCH_SCHEMA = STUDENT_EVENT_SCHEMA.replace("rede bigint", "rede string")

_TARGET_NUMBERS = (
    "taxa_alfabetizacao double, meta_alfabetizacao_2024 double, "
    "meta_alfabetizacao_2025 double, meta_alfabetizacao_2026 double, "
    "meta_alfabetizacao_2027 double, meta_alfabetizacao_2028 double, "
    "meta_alfabetizacao_2029 double, meta_alfabetizacao_2030 double"
)
NATION_TARGETS_SCHEMA = (
    f"ano bigint, rede string, {_TARGET_NUMBERS}, percentual_participacao double"
)
STATE_TARGETS_SCHEMA = (
    f"ano bigint, sigla_uf string, rede string, {_TARGET_NUMBERS}, "
    "percentual_participacao double"
)
PLACE_TARGETS_SCHEMA = (
    f"ano bigint, id_municipio string, rede string, {_TARGET_NUMBERS}, "
    "nivel_alfabetizacao bigint, percentual_participacao double"
)

_RESULT_NUMBERS = (
    "serie bigint, rede bigint, taxa_alfabetizacao double, media_portugues double, "
    "proporcao_aluno_nivel_0 double, proporcao_aluno_nivel_1 double, "
    "proporcao_aluno_nivel_2 double, proporcao_aluno_nivel_3 double, "
    "proporcao_aluno_nivel_4 double, proporcao_aluno_nivel_5 double, "
    "proporcao_aluno_nivel_6 double, proporcao_aluno_nivel_7 double, "
    "proporcao_aluno_nivel_8 double"
)
STATE_RESULTS_SCHEMA = f"ano bigint, sigla_uf string, {_RESULT_NUMBERS}"
PLACE_RESULTS_SCHEMA = f"ano bigint, id_municipio string, {_RESULT_NUMBERS}"

# Columns of the tables that the registered queries read.
TEST_TABLES = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
