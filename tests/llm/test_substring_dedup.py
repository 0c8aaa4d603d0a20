from __future__ import annotations

import numpy as np
import pytest

from lavra.llm import substring_dedup as sd


def brute_force(rows, words=20):
    """Kept text and removed words by id, from (id, text)."""
    starts: dict = {}
    split = [(i, t.encode().split() if t is not None else None) for i, t in rows]
    rank = {i: (i is not None, i or 0) for i, _ in split}
    for i, found in split:
        for at in range(len(found or ()) - words + 1):
            starts.setdefault(tuple(found[at : at + words]), []).append((rank[i], at))
    first = {window: min(places) for window, places in starts.items()}
    result = []
    for i, found in split:
        left = [True] * len(found or ())
        for at in range(len(left) - words + 1):
            if first[tuple(found[at : at + words])] < (rank[i], at):
                left[at : at + words] = [False] * words
        kept = b" ".join(w for w, l in zip(found or (), left, strict=True) if l).decode()
        result.append((i, None if found is None else kept, len(left), len(left) - sum(left)))
    return sorted(result, key=str)


def corpus(prose):
    shared, notice = prose(1, 60), prose(2, 25)
    rows = [(i, f"{prose(100 + i, 30 + i)} {notice} {prose(200 + i, 15)}") for i in range(20)]
    rows += [(30, shared), (31, shared), (32, shared + " tail"), (33, f"{shared} {shared}")]
    rows += [(40, None), (41, ""), (42, " \n\t"), (43, "one two"), (44, "na " * 200)]
    rows += [(None, f"{shared} null"), (50, prose(3, 20)), (49, prose(3, 20))]
    rows += [(60, "x" * 50_000 + " " + notice), (61, "é " * 19 + "é")]
    return rows


def result(frame):
    rows = frame.select("doc_id", "text", "n_words", "n_removed").collect()
    return sorted(map(tuple, rows), key=str)


def test_same_as_brute_force(docs, prose):
    rows = corpus(prose)
    assert result(sd.remove_repeats(docs(*rows))) == brute_force(rows)


def test_small_groups_and_buckets_that_split(docs, prose, monkeypatch):
    rows = corpus(prose) + [(1000 + i, prose(7, 300)) for i in range(30)]
    for name in ("_GROUP_BYTES", "_BUCKET_BYTES", "_STATE_BYTES"):
        monkeypatch.setattr(sd, name, 600)
    monkeypatch.setattr(sd, "_PIECE_WORDS", 40)
    assert result(sd.remove_repeats(docs(*rows))) == brute_force(rows)


def test_equal_hashes_are_told_apart(docs, prose, monkeypatch):
    monkeypatch.setattr(sd, "_mixed", lambda h: h % np.uint64(3))
    rows = corpus(prose)
    assert result(sd.remove_repeats(docs(*rows))) == brute_force(rows)


def test_repeated_rows_are_treated_alike(docs, prose):
    text = prose(5, 40)
    rows = [(1, text), (1, text), (1, prose(6, 30)), (2, text)]
    assert result(sd.remove_repeats(docs(*rows))) == sorted(
        [(1, text, 40, 0), (1, text, 40, 0), (1, prose(6, 30), 30, 0), (2, "", 40, 40)], key=str
    )


def test_no_rows_and_extra_columns(docs, prose):
    assert sd.remove_repeats(docs()).count() == 0
    extra = docs((1, prose(1, 20)), (2, prose(1, 20))).selectExpr(
        "*", "1 AS place", "2 AS mark", "3 AS runs", "4 AS done", "5 AS n_words", "6 AS of", "7 AS many"
    )
    found = sd.remove_repeats(extra)
    assert sorted(found.columns) == sorted([*extra.columns, "n_removed"])
    assert sorted((r["doc_id"], r["n_removed"], r["place"]) for r in found.collect()) == [
        (1, 0, 1),
        (2, 20, 1),
    ]


@pytest.mark.parametrize("words, minimiser", [(1, 1), (3, 2), (8, 8)])
def test_other_windows(docs, prose, words, minimiser):
    rows = [(i, prose(i, 12)) for i in range(6)] + [(9, prose(2, 12))]
    found = sd.remove_repeats(docs(*rows), words, minimiser)
    assert result(found) == brute_force(rows, words)
