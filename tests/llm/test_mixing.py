from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra.llm import mixing, prefix_sums


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, goal = sum(sizes.values()), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > most * sizes[s]]
        if not over:
            goal |= {s: share * weight[s] for s in open_}
            break
        for s in over:
            goal[s] = most * sizes[s]
            left -= goal[s]
            open_.remove(s)
    return goal


def corpus(prose):
    rows = [(i, prose(i, 5 + i % 30), "en", "abcd"[i % 4]) for i in range(400)]
    rows += [(1000 + i, prose(i, 20), "en", "tiny") for i in range(3)]
    rows += [(2000 + i, prose(i, 10), "en", None) for i in range(30)]
    rows += [(3000, None, "en", "a"), (3001, "", "en", "zero"), (None, "null id", "en", "a")]
    return rows + [rows[0], (5, prose(77, 9), "en", "b")]


def assigned(frame):
    docs = frame.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    numbered, size, row = mixing.number_rows(docs, F.col("size"))
    plan = mixing.assign(numbered, size, row).withColumnRenamed("row", row)
    return numbered.join(plan, row).collect()


def test_targets_and_what_is_taken(docs, prose, monkeypatch):
    monkeypatch.setattr(prefix_sums, "BUCKET_ROWS", 16)
    rows = corpus(prose)
    found = assigned(docs(*rows))
    assert len(found) == len(rows)
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    goals, taken, longest = plain_targets(sizes), {}, {}
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(goals[r["source"]])
        assert len(r["positions"]) <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * len(r["positions"])
        longest[r["source"]] = max(longest.get(r["source"], 0), r["size"])
        assert r["positions"] == sorted(r["positions"])
        assert all(0 <= p <= 1 for p in r["positions"])
    for source, goal in goals.items():
        assert goal - longest[source] <= taken[source] <= goal + 1e-6


def test_reruns_agree(docs, prose):
    frame = docs(*corpus(prose))
    once, again = (
        sorted((str(r["doc_id"]), r["size"], r["positions"]) for r in assigned(f))
        for f in (frame, frame.repartition(5))
    )
    assert once == again


def test_positions_follow_the_schedule(spark):
    shares = spark.range(0, 101).selectExpr("id / 100 AS share", "0 AS schedule")
    times = shares.select("share", mixing._time_of(F.col("share"), ((3.0, 1.0),)).alias("t")).collect()
    for row in times:
        t = row["t"]
        assert 3 * t - t * t == pytest.approx(2 * row["share"])
    flat = shares.select("share", mixing._time_of(F.col("share"), ((2.0, 2.0, 2.0),)).alias("t"))
    assert all(r["t"] == pytest.approx(r["share"]) for r in flat.collect())


def test_running_totals(spark, monkeypatch):
    monkeypatch.setattr(prefix_sums, "BUCKET_ROWS", 8)
    rows = spark.range(500).selectExpr(
        "IF(id % 3 = 0, NULL, id % 2) AS g", "xxhash64(id % 400) AS draw", "id", "id % 7 AS v"
    )
    found = prefix_sums.with_totals_before(rows, ["g"], "draw", ["id"], {"before": F.col("v")})
    totals: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r["draw"], r["id"])):
        assert r["before"] == totals.get(r["g"], 0)
        totals[r["g"]] = totals.get(r["g"], 0) + r["v"]


def test_mix_returns_copies_in_order(docs, prose):
    rows = corpus(prose)
    frame = docs(*rows).selectExpr("*", "1 AS position", "2 AS mix_row", "3 AS row")
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    expected = sum(len(r["positions"]) for r in assigned(frame))
    assert mixed.count() == expected
    assert mixing.mix(docs()).count() == 0
    assert mixing.mix(docs((1, None), (2, ""))).count() <= 6


@pytest.mark.parametrize("place", [0, 100, 900])
def test_a_long_document_does_not_end_the_filling(spark, place):
    """The rest of the order is taken although one long document in it does not fit."""
    ids = spark.range(1001).orderBy(F.xxhash64("id"))
    long = [r["id"] for r in ids.collect()][place]
    rows = [(i, "b", 100_000 if i == long else 90 + i % 20, i) for i in range(1001)]
    rows.append((5000, "a", 10, 5000))
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, row bigint")
    plan = mixing.assign(frame.repartition(3), "size", "row", ((1.0, 1.0),), 20_000).collect()
    size = {row: n for *_, n, row in rows}
    found = {r["row"]: r for r in plan if r["source_size"] > 10}
    goal = found[long]["target"]
    taken = sum(size[row] * len(r["positions"]) for row, r in found.items())
    unused = [size[row] for row, r in found.items() if not r["positions"]]
    assert 90_000 < goal < 110_000
    assert 0 <= goal - taken < min(unused)
    # The filling spreads over the training, as the words of its source do.
    times = sorted(p for r in found.values() for p in r["positions"])
    assert all(abs(t - (i + 0.5) / len(times)) < 0.05 for i, t in enumerate(times))


def test_no_document_that_is_left_fits(docs, prose, monkeypatch):
    monkeypatch.setattr(prefix_sums, "BUCKET_ROWS", 16)
    of: dict = {}
    for r in assigned(docs(*corpus(prose))):
        of.setdefault(r["source"], []).append(r)
    for rows in of.values():
        copies = [len(r["positions"]) for r in rows if r["size"]] or [3]
        left = [r["size"] for r in rows if r["size"] and len(r["positions"]) == min(copies)]
        gap = rows[0]["target"] - sum(r["size"] * len(r["positions"]) for r in rows)
        if min(copies) < 3 and len(set(copies)) > 1:
            assert gap < min(left)


def plain_copies(rows, wide, most=3):
    """Copies per row, from (source, size, draw, id, row), by reading each source in order."""
    sizes: dict = {}
    for source, size, *_ in rows:
        sizes[source] = sizes.get(source, 0) + size
    goals, copies = plain_targets(sizes), {}
    for source, whole in sizes.items():
        own = sorted((r for r in rows if r[0] == source), key=lambda r: (r[2], r[3] or "", r[1], r[4]))
        rounds = min(int(goals[source] // whole), most) if whole else 0
        taken, before, left = rounds * whole, 0, []
        for _, size, _, _, row in own:
            more = rounds < most and before + size <= goals[source] - rounds * whole
            copies[row] = rounds + more
            taken += more * size
            if not more and rounds < most and size > 0:
                left.append((size, row))
            before += size
        while (gap := goals[source] - taken) >= wide:
            before, chosen = 0, []
            for size, row in left:
                if 2 * size <= gap:
                    if before + size <= gap:
                        chosen.append((size, row))
                    before += size
            if not chosen:
                break
            left = [one for one in left if one not in chosen]
            for size, row in chosen:
                copies[row] += 1
                taken += size
        for size, row in left:
            if size <= goals[source] - taken:
                copies[row] += 1
                taken += size
    return copies


@pytest.mark.parametrize("wide", [10, 1 << 16])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_copies_equal_a_plain_reading(spark, monkeypatch, wide, seed):
    import random

    monkeypatch.setattr(prefix_sums, "BUCKET_ROWS", 16)
    monkeypatch.setattr(mixing, "WIDE_GAP", wide)
    draw = random.Random(seed)
    rows = [
        (None if i % 50 == 7 else i // 2, draw.choice(["a", "a", "a", "b", "c", None]), draw.choice([0, 1, 3, 7, 40, 500]), i)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, row bigint")
    order = {r["row"]: r["h"] for r in frame.select("row", F.xxhash64("doc_id").alias("h")).collect()}
    plan = mixing.assign(frame.repartition(4), "size", "row").collect()
    found = {r["row"]: len(r["positions"]) for r in plan}
    listed = [(s, n, order[row], None if i is None else str(i), row) for i, s, n, row in rows]
    assert found == plain_copies(listed, wide)


def test_few_jobs(spark, docs, prose):
    """Plans and their code stay in the driver for a while, so the mix is made in few steps."""
    frame = docs(*corpus(prose))
    spark.sparkContext.setJobGroup("mix", "the whole mix")
    try:
        mixing.mix(frame).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("mix")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 35
