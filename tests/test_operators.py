from __future__ import annotations

import itertools
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra.functions.text import pad_key
from lavra.operators import indicator
from lavra.operators.compare import key_spine, verdicts
from lavra.operators.conform import Field, numbers_by_year, project
from lavra.operators.dedup import latest_by
from lavra.operators.freshness import FreshnessNames, freshness
from lavra.operators.joins import lookup_join, salted_lookup
from lavra.operators.reconcile import mean_absolute_errors
from lavra.operators.reference import KNOWN, enrich, mark, orphan_count, quarantine
from lavra.runtime import bounded, fits_broadcast, measured_bytes

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_project(table, rows):
    df = table("a string, b double, m_2024 string, dropped string", (" x ", 1.5, "3", "-"))
    fields = [Field("t", "text", "a"), Field("n", "whole", "b"), *numbers_by_year("y{year}", "m_{year}", [2024])]
    out = project(df, fields)
    assert rows(out) == [("x", 2, 3.0)]
    assert out.columns == ["t", "n", "y2024"]


def test_latest_wins_and_ties_are_repeatable(table, rows):
    df = table(
        "id string, ano bigint, at bigint, v string",
        ("1", 2024, 1, "old"),
        ("1", 2024, 2, "new"),
        (" 1", 2024, 1, "other key"),
        ("2", 2024, 1, "b"),
        ("2", 2024, 1, "a"),
        (None, 2024, 1, "null key"),
    )
    kept = latest_by(df, ["id", "ano"], [F.desc("at")])
    assert rows(kept, "id", "v") == [
        (" 1", "other key"), ("1", "new"), ("2", "a"), (None, "null key"),
    ]
    assert rows(latest_by(kept, ["id", "ano"], [F.desc("at")])) == rows(kept)


def test_latest_ranks_before_the_shuffle(table):
    df = table("id string, at bigint", ("1", 1))
    plan = plan_of(latest_by(df, ["id"], [F.desc("at")]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("broadcast", [True, False])
def test_reference_split(table, rows, broadcast):
    dim = table("k string, uf string", ("0000001", "A"), ("0000002", "B"), ("0000002", "B2"))
    dim = F.broadcast(dim) if broadcast else dim.hint("merge")
    df = table("id bigint, place string", (1, "1"), (2, "2"), (3, "3"), (4, None))
    key = pad_key(F.col("place"), 7)
    assert rows(enrich(df, dim, key, "k")) == [(1, "1", "A"), (2, "2", "B"), (2, "2", "B2")]
    bad = quarantine(df, dim, key, "k", {"why": F.lit("unknown")})
    assert rows(bad) == [(3, "3", "unknown"), (4, None, "unknown")]
    marked = mark(df, dim, key, "k")
    assert rows(marked.where(KNOWN).drop(KNOWN)) == rows(enrich(df, dim, key, "k"))
    unknown = marked.where(~F.col(KNOWN)).drop(KNOWN, "uf")
    assert rows(unknown) == rows(bad.drop("why"))
    padded = df.withColumn("place", key)
    assert rows(orphan_count(padded, dim, "place", "k")) == [(2,)]
    assert rows(orphan_count(padded.where("id = 1"), dim, "place", "k")) == [(0,)]


def test_orphans_are_counted_per_key_before_the_join(table):
    df, dim = table("p string", ("1",)), table("k string", ("1",))
    plan = plan_of(orphan_count(df, dim.hint("merge"), "p", "k"))
    assert plan.index("LeftAnti") < plan.index("partial_count(1)")


MEASURES = indicator.Measures("id", "present", "valid", "success", "score", "weight")
STUDENTS = (
    "uf string, place string, rede string, id string, present bigint, valid bigint, "
    "success bigint, score double, weight double"
)


def test_indicator_nulls(table, rows):
    df = table(
        STUDENTS,
        ("A", "1", "Estadual", "a", 1, 1, 1, 700.0, 2.0),
        ("A", "1", "Estadual", "b", 1, 1, 0, None, 1.0),
        ("A", "1", "Estadual", "c", 0, 0, 0, 500.0, None),
        ("A", "1", "Estadual", None, 0, 0, 0, None, None),
        ("A", "1", "Federal", "d", None, None, None, None, 0.0),
        ("A", "1", "Privada", "e", 1, 0, 0, None, 3.0),
    )
    parts = indicator.components(df, ["place", "rede"], MEASURES)
    out = parts.select(
        "rede", "n_persons", "n_present", "n_valid", "n_success",
        indicator.success_rate(), indicator.mean_score(),
    )
    assert rows(out) == [
        ("Estadual", 3, 2, 2, 1, pytest.approx(200 / 3), 700.0),
        ("Federal", 1, None, None, None, None, None),
        ("Privada", 1, 1, 0, 0, None, None),
    ]


def test_rollup_keeps_a_source_label_of_the_same_name(table, rows):
    df = table(
        STUDENTS,
        ("A", "1", "Estadual", "a", 1, 1, 1, 1.0, 1.0),
        ("A", "1", "Municipal", "b", 1, 1, 0, 1.0, 1.0),
        ("A", "1", "Federal", "c", 1, 1, 0, 1.0, 1.0),
        ("A", "1", "Pública", "d", 1, 1, 0, 1.0, 1.0),
        ("A", "1", None, "e", 1, 1, 0, 1.0, 1.0),
    )
    parts = indicator.components(df, ["place", "rede"], MEASURES)
    rolled = indicator.roll_up(parts, ["place"], "rede", "Pública", ["Estadual", "Municipal"])
    assert rows(rolled, "rede", "_rolled_up", "n_persons") == [
        ("Estadual", False, 1),
        ("Federal", False, 1),
        ("Municipal", False, 1),
        ("Pública", False, 1),
        ("Pública", True, 2),
        (None, False, 1),
    ]


students = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.sampled_from(["1", "2"]),
        st.sampled_from(["Estadual", "Municipal", "Privada"]),
        st.sampled_from(["x", "y", "z"]),
        st.sampled_from([0, 1]),
        st.sampled_from([0, 1, None]),
        st.sampled_from([0, 1, None]),
        st.sampled_from([None, 1.5, 700.25]),
        st.sampled_from([None, 0.0, 0.5, 3.0]),
    ),
    max_size=25,
)


@few
@given(data=students)
def test_components_agree_with_direct_aggregation(table, rows, data):
    # A place lies in one state.
    data = [(r[0], r[0] + r[1], *r[2:]) for r in data]
    df = table(STUDENTS, *data)
    members = ["Estadual", "Municipal"]
    own = [c.alias(n) for n, c in MEASURES.components().items()]
    fine = indicator.components(df, ["uf", "place", "rede"], MEASURES)
    rolled = indicator.roll_up(fine, ["uf"], "rede", "Pública", members)
    shown = ["uf", "rede", *indicator.COMPONENTS]
    rounding = [
        F.round(c, 6) if c.startswith(("w_", "sum_")) else F.col(c) for c in shown
    ]
    direct = df.groupBy("uf", "rede").agg(*own).unionByName(
        df.where(F.col("rede").isin(members)).groupBy("uf").agg(*own).withColumn("rede", F.lit("Pública"))
    )
    assert rows(rolled, *rounding) == rows(direct, *rounding)


def test_spine_counts_null_as_one_value(table, rows):
    a = table("ano bigint, rede string, x int", (1, "a", 0), (1, "a", 1), (1, None, 0))
    b = table("rede string, ano bigint", ("a", 1), (None, 1), ("b", 2))
    assert rows(key_spine([a, b], ["ano", "rede"])) == [(1, "a"), (1, None), (2, "b")]


@pytest.mark.parametrize("join", ["broadcast", "salted"])
def test_lookup_join_is_a_left_join(table, rows, join):
    left = table("k string, y int", ("a", 1), ("a", 2), ("b", 1), (None, 1))
    right = table("k string, y int, v int", *[("a", 1, i) for i in range(200)], (None, 1, 7), ("c", 1, 8))
    if join == "broadcast":
        out = lookup_join(left, [right], ["k", "y"])
    else:
        out = lookup_join(left, [right], ["k", "y"], limit=0)
    want = [("a", 1, i) for i in range(200)] + [("a", 2, None), ("b", 1, None), (None, 1, None)]
    assert sorted(rows(out, "k", "y", "v"), key=str) == sorted(want, key=str)


def test_salted_lookup_spreads_exact_copies(table):
    left = table("k string", ("a",))
    right = left.sparkSession.range(0, 6400, numPartitions=4).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    out = salted_lookup(left, right, ["k"])
    assert out.count() == 6400
    assert "_salt" not in out.columns


@few
@given(
    left=st.lists(st.sampled_from(["a", "b", None]), max_size=6),
    right=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=12),
)
def test_both_lookups_match_brute_force(table, rows, left, right):
    out = []
    for k in left:
        hits = [v for key, v in right if key is not None and key == k]
        out += [(k, v) for v in hits] or [(k, None)]
    a, b = table("k string", *[(k,) for k in left]), table("k string, v int", *right)
    for limit in (None, 0):
        got = rows(lookup_join(a, [b], ["k"], limit=limit), "k", "v")
        assert sorted(got, key=str) == sorted(out, key=str)


def test_sides_are_broadcast_only_when_measured_small(table):
    dim = table("k string, v string", ("a", "x" * 100))
    assert measured_bytes(dim, dim) == [133, 133]
    assert fits_broadcast(dim, limit=133) == [True] and fits_broadcast(dim, limit=132) == [False]
    big = table("k string", ("a",))
    assert "BroadcastHashJoin" in plan_of(big.hint("merge").join(bounded(dim), "k"))
    assert measured_bytes(table("k string")) == [0]


def test_verdicts(table, rows):
    df = table("a double, t double", (2.0, 1.0), (None, 1.0), (1.0, 1.0))
    out = verdicts(df, "t", [("a", "d", "m")])
    assert rows(out) == [(1.0, 1.0, 0.0, True), (2.0, 1.0, 1.0, True), (None, 1.0, None, None)]


def test_freshness(table, rows):
    names = FreshnessNames("n", "persons", "places", "first", "last", "cover")
    sample = table("ano int, id string, p string, t int", (1, "a", "x", 1), (1, "a", "y", 5), (2, "b", "x", 3))
    base = table("id string", ("a",), ("b",), ("c",), ("d",), ("d",))
    out = freshness(sample, base, "ano", "id", "p", "t", names)
    assert rows(out) == [(1, 2, 1, 2, 1, 5, 25.0), (2, 1, 1, 1, 3, 3, 25.0)]
    none = freshness(sample, base.where("id = 'z'"), "ano", "id", "p", "t", names)
    assert rows(none, "cover") == [(None,), (None,)]


def test_mean_absolute_errors(table, rows):
    own = table("k int, a double", (1, 1.0), (2, 5.0), (3, None), (4, 1.0))
    official = table("k int, b double", (1, 2.0), (2, 2.0), (3, 1.0))
    out = mean_absolute_errors(own, official, ["k"], {"mae": (F.col("a"), F.col("b"))})
    assert rows(out) == [(2.0, 2)]


def test_every_rollup_counts_its_members(table, rows):
    labels = ["Estadual", "Municipal", "Privada"]
    data = [("A", "1", r, str(i), 1, 1, 1, 1.0, 1.0) for i, r in itertools.product(range(3), labels)]
    parts = indicator.components(table(STUDENTS, *data), ["place", "rede"], MEASURES)
    rolled = indicator.roll_up(parts, ["place"], "rede", "Pública", labels[:2])
    counts = dict(rows(rolled, "rede", "n_persons"))
    assert counts["Pública"] == counts["Estadual"] + counts["Municipal"]


def test_order_columns_do_not_break_ties_again(table):
    df = table("id int, at int, x int, y int", (1, 2, 3, 4))
    plan = plan_of(latest_by(df, ["id"], ["at"]))
    window = next(line for line in plan.splitlines() if "row_number" in line)
    assert "DESC" in window and " ASC" in window and not re.search(r"at#\d+ ASC", window)


def test_salts_follow_the_measured_size():
    from lavra.operators.joins import LEAST_SALTS, SALT_BYTES, salts_for

    assert salts_for(1) == LEAST_SALTS
    assert salts_for(1000 * SALT_BYTES + 1) == 1001


def test_shuffle_partitions_follow_the_input():
    from lavra.session import MOST_PARTITIONS, TASK_BYTES, shuffle_partitions

    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(5000 * TASK_BYTES) == 5000
    assert shuffle_partitions(10**18) == MOST_PARTITIONS
