"""Every registered query against its SQL oracle on the smallest data set."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from lavra.plans.registered import QUERIES

FOLDER = os.environ.get("LAVRA_TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name, extension = os.path.splitext(file)
        if extension == ".parquet":
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    listed = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(listed, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql())


def assert_matches(spark, duck, name, folder):
    df = entry_point.queries()[name](spark, folder)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert_matches(spark, duck, name, FOLDER)


@pytest.mark.parametrize("name", ["dados_alunos", "mart_comparativo_municipio"])
def test_query_without_any_broadcast(spark, duck, name, monkeypatch):
    monkeypatch.setattr("lavra.runtime.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert_matches(spark, duck, name, FOLDER)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """The same tables, with a third of the rows on one order, line, supplier, customer,
    nation and user."""
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    changed = {
        "lineitem": ("l_extendedprice", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"),
        "orders": ("o_orderkey", "o_custkey"),
        "customer": ("c_custkey", "c_nationkey"),
        "events": ("event_id", "user_id"),
    }
    for file in sorted(os.listdir(FOLDER)):
        name, columns = file.split(".")[0], ()
        if name in changed:
            chooser, *keys = changed[name]
            columns = [
                f"CASE WHEN {chooser}::BIGINT % 3 = 0 THEN 1 ELSE {k} END AS {k}" for k in keys
            ]
        replaced = f"REPLACE ({', '.join(columns)})" if columns else ""
        con.execute(f"CREATE TABLE {name} AS SELECT * {replaced} FROM '{FOLDER}/{file}'")
        con.execute(f"COPY {name} TO '{folder}/{file}'")
    return folder, con


@pytest.mark.parametrize(
    "name",
    [
        "dados_alunos",
        "dedup_latest",
        "mart_comparativo_municipio",
        "mart_frescor_streaming",
        "quality_orphans",
        "reference_quarantine",
        "stream_dedup",
    ],
)
def test_query_with_hot_keys(spark, hot, name):
    folder, con = hot
    assert_matches(spark, con, name, folder)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
