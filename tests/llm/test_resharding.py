from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from lavra.llm import resharding as rs


def test_flows_move_the_fewest_bytes():
    draw = random.Random(1)
    for _ in range(40):
        old, new = draw.randint(1, 9), draw.randint(1, 9)
        supplies = [draw.choice([0, draw.randint(1, 1000)]) for _ in range(old)]
        total = sum(supplies)
        capacities = [total * (j + 1) // new - total * j // new for j in range(new)]
        found = rs.flows(supplies, capacities)
        for i, supply in enumerate(supplies):
            assert sum(v for (a, _), v in found.items() if a == i) == supply
        for j, capacity in enumerate(capacities):
            assert sum(v for (_, b), v in found.items() if b == j) == capacity
        stays = sum(min(a, b) for a, b in zip(supplies, capacities, strict=False))
        assert sum(v for (i, j), v in found.items() if i != j) == total - stays


def test_flows_take_back_what_was_sent():
    prices = {(0, 0): 1, (0, 1): 2, (1, 0): 1, (1, 1): 9}
    found = rs.flows([5, 5], [5, 5], lambda i, j: prices[i, j])
    assert found == {(0, 1): 5, (1, 0): 5}
    with pytest.raises(ValueError):
        rs.flows([2], [1])


def corpus(prose):
    rows = [(i, prose(i, 5 + i % 40), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    rows += [(1000 + i, prose(1, 10), "en", "hot") for i in range(50)]
    return rows + [(2000, None, None, None), (2001, "", "en", "hot"), (None, "é", "en", "hot"), rows[0]]


def old_shard():
    return F.when(F.col("source") == "hot", 1).otherwise(F.crc32(F.coalesce("source", F.lit(""))) % 4)


@pytest.mark.parametrize("new, file_bytes", [(7, 64 << 20), (3, 500), (1, 64 << 20)])
def test_shards_are_level_and_slots_gapless(docs, prose, monkeypatch, new, file_bytes):
    monkeypatch.setattr(rs, "FILE_BYTES", file_bytes)
    rows = corpus(prose)
    frame = docs(*rows).selectExpr("*", "1 AS shard", "2 AS old", "3 AS draw", "4 AS file", "5 AS _first")
    found = rs.reshard(frame, old_shard(), 4, new)
    assert set(found.columns) == {*frame.columns, "slot", "moved"}
    found = found.collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in found) == sorted(
        str((i, t)) for i, t, *_ in rows
    )
    slots: dict = {}
    sizes = dict.fromkeys(range(new), 0)
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 16 for _, t, *_ in rows)
    mean = sum(sizes.values()) / new
    assert all(abs(size - mean) <= 2 * largest for size in sizes.values())


def test_only_changed_shards_are_written(docs, prose, spark, folder):
    rows = [(i, "x" * 84, "en", str(i % 4)) for i in range(400)]
    rows += [(1000 + i, "x" * 84, "en", "0") for i in range(100)]
    path = f"{folder}/shards"
    old = F.col("source").cast("int")
    found = rs.reshard(docs(*rows), old, 4, 4, path).collect()
    assert len(found) == 500
    stays = [r for r in found if not r["moved"]]
    assert all(r["shard"] == int(r["source"]) for r in stays)
    assert sum(r["moved"] for r in found) == pytest.approx(75, abs=3)
    level = [(i, "x" * 84, "en", str(i % 4)) for i in range(400)]
    again = f"{folder}/level"
    assert not any(r["moved"] for r in rs.reshard(docs(*level), old, 4, 4, again).collect())
    assert spark.read.parquet(again).count() == 0 if _has_files(again) else True


def _has_files(path):
    import glob

    return bool(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_no_rows(docs):
    found = rs.reshard(docs(), F.lit(0), 2, 3)
    assert found.count() == 0 and {"shard", "slot", "moved"} <= set(found.columns)


def test_sizes_and_checksums(docs):
    (row,) = docs((1, None)).select(
        rs.row_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc")
    ).collect()
    assert tuple(row) == (16, zlib.crc32(b""))


def plain_places(rows, old_shards, new_shards):
    """Shard and slot of every row (id, text, old, draw), by walking along each old shard."""
    size = [len((text or "").encode()) + 16 for _, text, *_ in rows]
    supplies = [sum(s for s, r in zip(size, rows, strict=True) if r[2] == i) for i in range(old_shards)]
    total = sum(supplies)
    ends = [total * j // new_shards for j in range(new_shards + 1)]
    moves = rs.flows(supplies, [b - a for a, b in zip(ends, ends[1:], strict=False)])
    shard = {}
    for old in range(old_shards):
        line = sorted((r[3], s, i) for i, (r, s) in enumerate(zip(rows, size, strict=True)) if r[2] == old)
        stretches, at, before, begun = [(new, n) for (o, new), n in moves.items() if o == old], 0, 0, {}
        limits = [sum(n for _, n in stretches[: k + 1]) for k in range(len(stretches))]
        for draw, s, _ in line:
            at = min(sum(limit <= before + s / 2 for limit in limits), len(limits) - 1)
            begun.setdefault(at, draw)
            before += s
        for draw, _, i in line:
            # Rows with one draw are one document: they stay together.
            shard[i] = stretches[max(k for k, first in begun.items() if first <= draw)][0]
    files = max(1, total // new_shards // rs.FILE_BYTES)
    places = {}
    for new in range(new_shards):
        own = [i for i in shard if shard[i] == new]
        order = sorted(own, key=lambda i: (rows[i][3] % files, rows[i][3], str(rows[i][0]), rows[i][1] or ""))
        places |= {i: (new, slot) for slot, i in enumerate(order)}
    return places


@pytest.mark.parametrize("new, file_bytes", [(7, 64 << 20), (3, 500), (4, 2000), (1, 64 << 20)])
def test_shards_and_slots_equal_a_plain_walk(docs, prose, monkeypatch, new, file_bytes):
    from lavra.llm import prefix_sums

    monkeypatch.setattr(rs, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(prefix_sums, "BUCKET_ROWS", 32)
    frame = docs(*corpus(prose))
    drawn = frame.select("doc_id", "text", old_shard().cast("int").alias("old"), rs._draw(F.col("doc_id"), F.col("text")).alias("draw"))
    rows = [tuple(r) for r in drawn.collect()]
    expected = plain_places(rows, 4, new)
    found = rs.reshard(frame.repartition(3), old_shard(), 4, new).collect()
    listed = sorted((r["shard"], r["slot"], str(r["doc_id"]), r["text"] or "") for r in found)
    assert listed == sorted((*expected[i], str(row[0]), row[1] or "") for i, row in enumerate(rows))
