from __future__ import annotations

import numpy as np
import pytest

from lavra.llm import metric_join

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, least=0.98):
    def usable(v, label):
        return (
            label is not None
            and v
            and all(x is not None and np.isfinite(x) for x in v)
            and any(x != 0 for x in v)
        )

    n = len(rows)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (_, a, k), (_, b, m) = rows[i], rows[j]
            if usable(a, k) and usable(b, m) and k == m and len(a) == len(b):
                x, y = (np.float32(v).astype(float) for v in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    linked[i].append(j)
                    linked[j].append(i)
    result = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in linked[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        result.append((rows[i][0], len(linked[i]), min(ids, default=None)))
    return sorted(result, key=str)


def corpus(seed=0, dims=6):
    draw = np.random.default_rng(seed)
    rows = []
    for label in (1, 2):
        for centre in draw.normal(size=(12, dims)):
            for _ in range(int(draw.integers(1, 8))):
                rows.append((centre + draw.normal(size=dims) * 0.09).tolist() + [label])
    rows = [(3 * i, r[:-1], r[-1]) for i, r in enumerate(rows)]
    copies = [(1000 + i, rows[0][1], 1) for i in range(5)] + [(1100, [2 * x for x in rows[1][1]], 1)]
    odd = [
        (2000, None, 1),
        (2001, [], 1),
        (2002, [0.0] * dims, 1),
        (2003, [float("nan")] + [1.0] * (dims - 1), 1),
        (2004, [None] + [1.0] * (dims - 1), 1),
        (2005, [float("inf")] + [1.0] * (dims - 1), 1),
        (2006, rows[0][1], None),
        (2007, rows[0][1][:3], 1),
        (2008, [1e-30 * x for x in rows[0][1]], 1),
        (None, rows[0][1], 1),
        (None, [7.0, -3.0, 1.0, 0.0, 0.0, 2.0][:dims], 2),
        (3, rows[1][1], 1),
    ]
    return rows + copies + odd


@pytest.mark.parametrize("home, others", [(2048, 4096), (4, 3)])
def test_same_as_brute_force(table, monkeypatch, home, others):
    monkeypatch.setattr(metric_join, "HOME_ROWS", home)
    monkeypatch.setattr(metric_join, "_OTHER_ROWS", others)
    rows = corpus()
    frame = table(SCHEMA, *rows).selectExpr("*", "1 AS id", "2 AS class", "3 AS n", "4 AS vector")
    found = metric_join.near_duplicates(frame).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(rows)


def test_few_pivots_mean_larger_cells(table, monkeypatch):
    monkeypatch.setattr(metric_join, "HOME_ROWS", 2)
    monkeypatch.setattr(metric_join, "MOST_PIVOTS", 3)
    rows = corpus(7, 4)
    found = metric_join.near_duplicates(table(SCHEMA, *rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(rows)


def test_no_rows_and_leaders(table):
    assert metric_join.near_duplicates(table(SCHEMA)).count() == 0
    rows = [(5, [1.0, 0.0], 1), (3, [1.0, 0.01], 1), (9, [0.0, 1.0], 1), (4, None, 1)]
    kept = metric_join.keep_representatives(table(SCHEMA, *rows))
    assert sorted(r["vec_id"] for r in kept.collect()) == [3, 4, 9]
