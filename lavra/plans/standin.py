"""Bronze tables of the domain, derived from generic order, customer and event tables.

The registered queries run the real plans on these inputs. Students are order lines, places
are nations, states are regions, official results are orders, events are streamed students.
Some suppliers and customers get a place that is missing or not in the dimension, so every
join and quarantine has rows to reject.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.plans import fixed

# Order years 1995-2001 become the years 2024-2030 for which targets exist.
YEAR_SHIFT = 29


class Tables:
    """Lazy readers for one data folder; each table is opened once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        return self.once(
            name, lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        )

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A DataFrame that several parts of one query share."""
        if name not in self._opened:
            self._opened[name] = build()
        return self._opened[name]


def place_code(nation: str, balance: str) -> Column:
    """Nation as place; no place for a negative balance, an unknown one for a high balance."""
    return (
        F.when(F.col(balance) < 0, F.lit(None))
        .when(F.col(balance) >= 9000, F.col(nation) + 900)
        .otherwise(F.col(nation))
        .cast("string")
    )


def places(t: Tables) -> DataFrame:
    """Untrimmed, lower-case place rows."""
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("id_municipio"),
        F.concat(F.lit(" "), "n_name", F.lit("\t")).alias("nome_municipio"),
        F.concat(F.lower(F.substring("r_name", 1, 2)), F.lit(" ")).alias("sigla_uf"),
        F.concat("r_name", F.lit("  ")).alias("nome_uf"),
        F.col("r_regionkey").cast("bigint").alias("id_uf"),
        F.lower(F.substring("r_name", 1, 1)).alias("sigla_regiao"),
        F.concat(F.lit(" "), "r_name").alias("nome_regiao"),
    )


def students(t: Tables) -> DataFrame:
    """Order lines with their supplier's place; repeated lines are repeated deliveries."""
    present = F.col("l_returnflag") != "R"
    valid = present & (F.col("l_linestatus") == "F")
    success = valid & (F.col("l_discount") >= 0.05)
    return t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.year("l_shipdate") + YEAR_SHIFT).cast("bigint").alias("ano"),
        place_code("s_nationkey", "s_acctbal").alias("id_municipio"),
        F.concat(F.lit(" "), "l_suppkey", F.lit("\t")).alias("id_escola"),
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id_aluno"),
        F.col("l_linenumber").cast("bigint").alias("caderno"),
        F.lit(2).cast("bigint").alias("serie"),
        (F.lit(1) + F.col("l_orderkey") % 4).cast("string").alias("rede"),
        present.cast("bigint").alias("presenca"),
        valid.cast("bigint").alias("preenchimento_caderno"),
        success.cast("bigint").alias("alfabetizado"),
        F.when(valid, F.col("l_extendedprice")).alias("proficiencia"),
        F.when(present, F.col("l_quantity")).alias("peso_aluno"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.lit("lineitem").alias("_source_file"),
    )


def events(t: Tables) -> DataFrame:
    """Events as streamed students; a user's newest event of a year is the valid one."""
    valid = F.col("event_type").isin("view", "click", "purchase")
    present = F.col("event_type") != "error"
    return t("events").select(
        (F.lit(2023) + F.floor(F.day("ts") / 16)).cast("bigint").alias("ano"),
        (F.col("user_id") % 30).cast("string").alias("id_municipio"),
        F.col("event_type").alias("id_escola"),
        F.col("user_id").cast("string").alias("id_aluno"),
        F.get_json_object("props", "$.k").cast("bigint").alias("caderno"),
        F.lit(2).cast("bigint").alias("serie"),
        (F.col("user_id") % 8).cast("bigint").alias("rede"),
        present.cast("bigint").alias("presenca"),
        valid.cast("bigint").alias("preenchimento_caderno"),
        (valid & (F.col("value") > 50)).cast("bigint").alias("alfabetizado"),
        F.when(valid, F.col("value")).alias("proficiencia"),
        F.when(present, (F.lit(1) + F.col("user_id") % 3).cast("double")).alias("peso_aluno"),
        F.col("ts").alias("_ingested_at"),
        F.lit("events").alias("_source_file"),
    )


def _orders(t: Tables) -> DataFrame:
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))


def _with_region(df: DataFrame, t: Tables) -> DataFrame:
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    state = F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 2))).alias("sigla_uf")
    side = nations.select(F.col("n_nationkey").alias("c_nationkey"), state)
    return df.join(side, "c_nationkey")


def _result_measures() -> list[Column]:
    def share(condition: Column) -> Column:
        return 100.0 * F.count_if(condition) / F.count(F.lit(1))

    return [
        share(F.col("o_orderstatus") == "F").alias("taxa_alfabetizacao"),
        (F.avg("o_totalprice") / 1000).alias("media_portugues"),
        *[
            share(F.col("o_custkey") % 9 == n).alias(f"proporcao_aluno_nivel_{n}")
            for n in fixed.LEVELS
        ],
    ]


def _result_keys(place: Column) -> list[Column]:
    return [
        (F.year("o_orderdate") + YEAR_SHIFT).cast("bigint").alias("ano"),
        place,
        F.lit(2).cast("bigint").alias("serie"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("rede"),
    ]


def place_results(t: Tables) -> DataFrame:
    place = place_code("c_nationkey", "c_acctbal").alias("id_municipio")
    return _orders(t).groupBy(*_result_keys(place)).agg(*_result_measures())


def state_results(t: Tables) -> DataFrame:
    keys = _result_keys(F.col("sigla_uf"))
    return _with_region(_orders(t), t).groupBy(*keys).agg(*_result_measures())


def _targets(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Eight yearly rows per key, with numbers that depend on the key's row count `n`."""
    n = F.col("n")
    wide = {
        f"meta_alfabetizacao_{y}": F.when((n + y) % 5 != 0, (45 + (n + y) % 30).cast("double"))
        for y in fixed.TARGET_YEARS
    }
    return counted.withColumn("ano", F.explode(F.sequence(F.lit(2023), F.lit(2030)))).select(
        "ano",
        *keys,
        F.lit(" Pública\t").alias("rede"),
        (40 + n % 20).cast("double").alias("taxa_alfabetizacao"),
        *[value.alias(name) for name, value in wide.items()],
        (n % 9 + 0.5).alias("nivel_alfabetizacao"),
        (80 + n % 20).cast("double").alias("percentual_participacao"),
    )


def place_targets(t: Tables) -> DataFrame:
    place = place_code("c_nationkey", "c_acctbal").alias("id_municipio")
    counted = t("customer").groupBy(place).agg(F.count(F.lit(1)).alias("n"))
    return _targets(counted, ["id_municipio"])


def state_targets(t: Tables) -> DataFrame:
    counted = _with_region(t("customer"), t).groupBy("sigla_uf").agg(
        F.count(F.lit(1)).alias("n")
    )
    return _targets(counted, ["sigla_uf"]).drop("nivel_alfabetizacao")


def nation_targets(t: Tables) -> DataFrame:
    counted = t("customer").agg(F.count(F.lit(1)).alias("n"))
    return _targets(counted, []).drop("nivel_alfabetizacao")
