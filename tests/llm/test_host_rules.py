from __future__ import annotations

import collections
import os
import re

import duckdb
import pytest

from lavra.llm import host_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_metrics_same_as_plain(docs, prose):
    texts = [None, "", " \n\n ", "one", "a b\na b\n a b\n", "é 漢 #*$%&|<> x" * 3, "w " * 500]
    texts += [prose(1, 30), f"{prose(2, 20)}\n{prose(3, 9)} {prose(2, 20)}", prose(4, 8) * 2]
    texts += [" ".join([prose(5, 9)] * 7), "y" * 100_000, prose(6, 6000) + " " + prose(6, 40)]
    frame = docs(*enumerate(texts), (7, texts[7])).selectExpr("*", "1 AS words", "2 AS lines", "3 AS hashes")
    found = host_rules.with_metrics(frame)
    assert found.count() == len(texts) + 1
    for row in found.collect():
        assert tuple(row[m] for m in host_rules.METRICS) == plain(texts[row["doc_id"]])


def host_corpus(prose):
    good = [(i, prose(i, 40), "en", f"good{i % 4}") for i in range(80)]
    bad = [(100 + i, "too short", "en", "bad") for i in range(30)] + [(140, prose(99, 40), "en", "bad")]
    few = [(200, "short", "en", "new"), (201, prose(98, 40), "en", None), (202, "short", "en", None)]
    return good + bad + few


def test_bad_hosts_fail_and_clean_documents_stay(docs, prose):
    rows = host_corpus(prose)
    frame = docs(*rows, rows[0]).selectExpr("*", "1 AS host", "2 AS n", "3 AS kept_by")
    found = {r["doc_id"]: r for r in host_rules.judge(frame, "source").collect()}
    assert all(found[i]["kept"] for i in range(80))
    assert not any(found[100 + i]["kept"] for i in range(30))
    # A clean document of a host that fails goes with it; one without a host stays.
    assert not found[140]["base_failed"] and not found[140]["kept"]
    assert found[201]["kept"] and not found[202]["kept"]
    # One failure is little evidence: the rate moves towards the mean of all hosts.
    assert found[200]["short_rate"] < found[100]["short_rate"]
    assert found[201]["short_rate"] is None
    assert len(found) == len(rows)


def test_equal_hosts_get_the_mean(docs, prose):
    rows = [(i, prose(i, 40), "en", f"h{i % 3}") for i in range(12)]
    found = host_rules.judge(docs(*rows), "source").collect()
    assert all(r["kept"] and r["short_rate"] == 0 for r in found)


def test_no_rows(docs):
    assert host_rules.judge(docs(), "source").count() == 0
    (row,) = host_rules.judge(docs((None, None)), "source").collect()
    assert (row["n_words"], row["base_failed"], row["kept"]) == (0, True, False)


def test_many_tiny_hosts_do_not_hide_a_large_bad_one(spark):
    """10,000 hosts of one document, of which 5 % fail, and one of 5,000 that all fail."""
    measured = spark.range(15_000).selectExpr(
        "IF(id < 10000, concat('tiny', id), 'bad') AS source",
        "IF(id >= 10000 OR id % 20 = 0, 1L, 40L) AS n_words",
        "200L AS word_chars",
        "0L AS n_symbols",
        "0L AS n_dup_lines",
        "0L AS n_repeat_words",
        "1L AS n_lines",
    )
    found = {r["source"]: r for r in host_rules.host_verdicts(measured, "source").collect()}
    assert len(found) == 10_001
    assert found["bad"]["host_failed"] and found["bad"]["short_rate"] > 0.99
    assert not found["tiny1"]["host_failed"]
    assert not found["tiny20"]["host_failed"]


def test_repeated_lines_are_counted_by_lines(docs, prose):
    """Half of the lines of each document are copies; words repeat in no window of eight."""
    def text(i):
        line = prose(1000 + i, 5)
        return "\n".join(part for k in range(8) for part in (line, prose(100 * i + k, 7)))

    rows = [(i, text(i), "en", "copies") for i in range(40)]
    rows += [(100 + i, prose(i, 60), "en", f"good{i % 3}") for i in range(60)]
    found = {r["doc_id"]: r for r in host_rules.judge(docs(*rows), "source").collect()}
    assert (found[0]["n_dup_lines"], found[0]["n_lines"], found[0]["n_repeat_words"]) == (7, 16, 0)
    assert found[0]["duplicate_lines_rate"] > 0.75 and not found[0]["kept"]
    assert found[100]["kept"] and found[100]["duplicate_lines_rate"] < 0.2


def test_evidence_counts_without_variance_beyond_chance(docs, prose):
    """Rates that vary by chance only: a finite prior, and no host gets just the mean."""
    rows = [(i, "short" if i % 10 == i // 100 else prose(i, 40), "en", f"h{i // 100}") for i in range(300)]
    rows += [(300, prose(300, 40), "en", "h3")]
    rates = {r["source"]: r["short_rate"] for r in host_rules.judge(docs(*rows), "source").collect()}
    mean, prior = 30 / 301, host_rules.MOST_PRIOR
    assert abs(rates["h0"] - (10 + prior * mean) / (100 + prior)) < 1e-9
    assert abs(rates["h3"] - prior * mean / (1 + prior)) < 1e-9


def test_clashing_names(docs, prose):
    rows = host_corpus(prose)
    frame = docs(*rows)
    plain = {r["doc_id"]: r for r in host_rules.judge(frame, "source").collect()}
    clashing = frame.selectExpr("*", "1 AS HOST_FAILED", "2 AS short_rate", "3 AS n_lines", "4 AS host_key")
    found = host_rules.judge(clashing, "source")
    assert "HOST_FAILED" not in found.columns and set(found.columns) == {*host_rules.judge(frame, "source").columns, "host_key"}
    for row in found.collect():
        assert row["host_key"] == 4
        assert all(row[name] == plain[row["doc_id"]][name] for name in (*host_rules.METRICS, "short_rate", "kept"))
    for name in ("n", "short_rate", "kept", "host"):
        named = frame.withColumnRenamed("source", name)
        found = {r["doc_id"]: r["kept"] for r in host_rules.judge(named, name).collect()}
        assert found == {i: r["kept"] for i, r in plain.items()}


@pytest.mark.parametrize("shares", [(60, 0, 0), (30, 30, 30), (0, 0, 0)])
def test_query_matches_oracle_on_unequal_hosts(spark, folder, shares):
    """Some hosts own most documents, in code and SQL alike."""
    source = os.environ.get("LAVRA_TEST_SF_DIR", "/root/testdata/sf0.001")
    con = duckdb.connect()
    chosen = " ".join(
        f"WHEN doc_id % 100 < {sum(shares[: i + 1])} THEN 'hot{i}'" for i in range(len(shares))
    )
    con.execute(
        f"""CREATE TABLE documents AS SELECT * REPLACE (CASE {chosen}
        WHEN doc_id % 17 = 3 THEN NULL WHEN doc_id % 17 = 5 THEN 'one' || doc_id
        ELSE source END AS source) FROM '{source}/documents.parquet'"""
    )
    con.execute(f"COPY documents TO '{folder}/documents.parquet'")
    df = queries.op4_host_rules(spark, folder)
    cursor = con.execute(queries.ORACLE_SQL["op4_host_rules"])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert found == sorted(cursor.fetchall(), key=str)
