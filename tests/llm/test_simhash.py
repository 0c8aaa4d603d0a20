from __future__ import annotations

import itertools
import random
import re

import pytest
import xxhash

from lavra.llm import simhash
from lavra.llm.components import connected_components


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(nodes, linked):
    """Smallest node reachable, by plain search."""
    smallest = {}
    for node in sorted(nodes):
        stack = [node]
        while stack:
            at = stack.pop()
            if at not in smallest:
                smallest[at] = node
                stack += [n for n in nodes if linked(at, n)]
    return smallest


@pytest.mark.parametrize(
    "text",
    [None, "", " \n", "One", "one two", "A b C", "É é Ñ x y z", "a b c a b c a b c"],
)
def test_fingerprint_of_odd_texts(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_fingerprint_of_long_text(prose, monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 100)
    text = prose(1, 1000) + " " + "y" * 10_000
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


@pytest.mark.parametrize("segments", [1, 2, 3, 4])
def test_links_are_exact(spark, segments):
    draw = random.Random(segments)
    values = [draw.getrandbits(64) - (1 << 63) for _ in range(40)]
    for value in values[:20]:
        bits = draw.sample(range(63), draw.randint(0, 5))
        values.append(value ^ sum(1 << b for b in bits))
    values = sorted(set(values))
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    found = {tuple(r) for r in simhash.linked_fingerprints(frame, 3, segments).collect()}
    mask = (1 << 64) - 1
    expected = {
        (a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) & mask).bit_count() <= 3
    }
    assert found == expected


def corpus(prose):
    base = prose(1, 300).split()
    rows = [(i, prose(10 + i, 100)) for i in range(10)]
    for i in range(12):
        rows.append((100 + i, " ".join([*base[: 290 - i], "changed", *base[290:]])))
    rows += [(200, prose(10, 100)), (201, prose(10, 100).upper()), (5, prose(15, 100))]
    return rows + [(300, None), (301, ""), (302, "  "), (None, prose(11, 100)), (None, "alone here")]


def test_same_as_brute_force(docs, prose):
    rows = corpus(prose)
    prints = [(i, plain_fingerprint(text)) for i, text in rows]
    groups = components_of({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 3)
    ids: dict = {}
    for i, f in prints:
        if i is not None:
            ids[groups[f]] = min(i, ids.get(groups[f], i))
    expected = sorted(((i, f, ids.get(groups[f])) for i, f in prints), key=str)
    found = simhash.near_duplicates(docs(*rows)).collect()
    mask = (1 << 64) - 1
    assert expected == sorted(((a, f & mask, c) for a, f, c in found), key=str)


def test_one_row_of_each_group_stays(docs, prose):
    rows = corpus(prose) + [(100, " ".join(prose(1, 300).split()[:290] + ["changed"]))]
    frame = docs(*rows).selectExpr("*", "1 AS fingerprint", "2 AS row_number", "3 AS component")
    kept = simhash.keep_representatives(frame)
    assert kept.columns == frame.columns
    groups = components_of(
        {plain_fingerprint(t) for _, t in rows}, lambda a, b: (a ^ b).bit_count() <= 3
    )
    left = [groups[plain_fingerprint(r["text"])] for r in kept.collect()]
    assert sorted(left) == sorted(set(groups.values()))
    assert 300 in {r["doc_id"] for r in kept.collect()}


def test_no_rows(docs):
    assert simhash.near_duplicates(docs()).count() == 0
    assert simhash.keep_representatives(docs()).count() == 0


def test_components_of_paths_stars_and_loops(table):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200, 200), (None, 3), (301, 300), (300, 301), (300, 301)]
    found = connected_components(table("src bigint, dst bigint", *edges)).collect()
    expected = {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}
    assert {r["node"]: r["component"] for r in found} == expected
    assert len(found) == len(expected)
    assert connected_components(table("src bigint, dst bigint")).count() == 0
