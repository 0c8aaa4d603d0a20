from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(table):
    """Documents from (id, text) pairs or longer tuples."""

    def make(*rows):
        full = [(*row, *(None,) * (5 - len(row))) for row in rows]
        return table(DOCS, *full)

    return make


@pytest.fixture
def prose():
    """Repeatable word sequences: `prose(seed, n)`."""
    import random

    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]

    def make(seed: int, n: int) -> str:
        return " ".join(random.Random(seed).choices(vocabulary, k=n))

    return make
