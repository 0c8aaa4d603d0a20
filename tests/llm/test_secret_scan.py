from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from lavra.llm import secret_scan as ss

ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
HEX = "0123456789abcdef" * 2
TEXTS = [
    None,
    "",
    "nothing to see here",
    f"PassWord = 'hunter2x' and token:abc then api_key=\"{HEX}\"",
    "secret=token: abcdefgh and secret=abcde",
    "AKIA" + "Z" * 16 + " AKIA" + "Z" * 15 + " xAKIAAKIA" + "Q1" * 9,
    f"é🙂 {HEX}{HEX} é token={HEX}",
    "deadbeef" * 3 + " " + "deadbeef" * 2,
    "token=abcdef" * 30,
    "key 9fQz7LpX2vKw8RtY4bNm stays",
    "x " * 20_000 + f"passwd: {HEX}",
]


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


@pytest.fixture(scope="module")
def weights(spark, request):
    import random

    draw = random.Random(5)
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(4, 11))) for _ in range(400)]
    rows = [(i, " ".join(draw.choices(words, k=80)) + f" token={HEX}{i}" * (i % 7 == 0)) for i in range(60)]
    sample = ss.labelled_sample(spark.createDataFrame(rows, "doc_id bigint, text string"))
    return ss.train(sample)


def test_rules_are_the_plain_ones(docs, weights):
    frame = docs(*enumerate(TEXTS), (3, TEXTS[3])).selectExpr("*", "1 AS base", "2 AS guess", "3 AS m")
    found = ss.scan(frame, weights).collect()
    assert len(found) == len(TEXTS) + 1
    random_rank = ss.KINDS.index("random")
    for row in found:
        spans = [tuple(s) for s in row["secrets"]]
        assert spans == sorted(spans)
        assert [s for s in spans if s[1] < random_rank] == base(TEXTS[row["doc_id"]])


def test_models_tell_random_strings_from_identifiers(docs, weights):
    rows = [
        (1, "9fQz7LpX2vKw8RtY4bNm"),
        (2, "someOrdinaryIdentifierName"),
        (3, "1234567890123456789"),
        (4, "a_snake_case_identifier"),
    ]
    found = {r["doc_id"]: r["secrets"] for r in ss.scan(docs(*rows), weights).collect()}
    assert [tuple(s) for s in found[1]] == [(0, 3, 20)]
    assert found[2] == found[3] == found[4] == []


def test_report(docs, weights):
    scanned = ss.scan(docs((1, f"é {HEX}"), (2, None)), weights)
    assert sorted(r[0] for r in scanned.select(ss.report(F.col("secrets"))).collect()) == ["", "hex:2:34"]


def test_redaction_keeps_all_else(docs, weights):
    rows = [
        (i, text, "en", None, len(text) if text is not None else None) for i, text in enumerate(TEXTS)
    ]
    frame = docs(*rows).selectExpr("*", "1 AS secrets")
    done = ss.redact(frame, weights)
    assert done.columns == frame.columns
    for row in done.collect():
        text, spans = TEXTS[row["doc_id"]], base(TEXTS[row["doc_id"]])
        if not spans and row["doc_id"] != 9:
            assert row["text"] == text
            continue
        assert row["n_chars"] == len(row["text"])
        assert not base(row["text"])
    texts = {r["doc_id"]: r["text"] for r in done.collect()}
    assert texts[9] == "key [SECRET] stays"
    assert texts[6] == "é🙂 [SECRET] é [SECRET]"


def test_no_rows_and_no_samples(docs):
    weights = ss.train(ss.labelled_sample(docs()))
    assert len(weights) == 128 * 128 and set(weights) == {0.0}
    assert ss.scan(docs(), weights).count() == 0


def test_random_parts_of_names_and_paths(docs, weights):
    """A long ordinary prefix does not hide the random string that it is glued to."""
    secret, other = "9fQz7LpX2vKw8RtY4bNm", "Zx4Kq9Wv7Jp2Hd8Gs5Tb"
    name = "hello_another_ordinary_thread_statement_" * 4
    texts = {
        1: (f"{name}title={secret} on", [secret]),
        2: (f"see {'/strained/related/situation' * 6}/{secret}", [secret]),
        3: (f"{name}one={secret}/{'rathole/' * 30}{other}", [secret, other]),
        4: (f"{name}={name}", []),
        5: (secret, [secret]),
    }
    frame = docs(*[(i, text) for i, (text, _) in texts.items()])
    for row in ss.scan(frame, weights).collect():
        text, expected = texts[row["doc_id"]]
        assert [text[start:end] for start, _, end in row["secrets"]] == expected
    left = ss.scan(ss.redact(frame, weights), weights).where("size(secrets) > 0")
    assert left.count() == 0


def held_out(kind, n=300):
    """Random strings of an alphabet, or identifiers and paths made of the standard library's
    names; the models have seen neither."""
    import logging
    import random
    import string
    import unittest.mock
    import urllib.request

    draw = random.Random(kind)
    alphabets = {
        "base64": string.ascii_letters + string.digits + "+/",
        "alphanumeric": string.ascii_letters + string.digits,
        "hexadecimal": "0123456789ABCDEF",
        "base32": string.ascii_uppercase + "234567",
        "lower": string.ascii_lowercase + string.digits,
    }
    if kind in alphabets:
        return ["".join(draw.choices(alphabets[kind], k=draw.choice((20, 24, 32, 40)))) for _ in range(n)]
    listed = [name for m in (logging, string, unittest.mock, urllib.request, random) for name in dir(m)]
    listed += [name for cls in (str, dict, logging.Logger, unittest.mock.Mock) for name in dir(cls)]
    words = sorted({w.lower() for name in listed for w in re.findall("[A-Z]?[a-z]+", name) if len(w) > 2})

    def name():
        parts = draw.choices(words, k=draw.randint(3, 5))
        title = [p.title() for p in parts]
        return {
            "camel": parts[0] + "".join(title[1:]),
            "snake": "_".join(parts),
            "upper": "_".join(parts).upper(),
            "kebab": "-".join(parts),
            "path": f"src/main/java/{'/'.join(parts)}/{''.join(title[:3])}",
        }[kind]

    made = [name() for _ in range(3 * n)]
    return [one for one in made if len(one) >= ss.CANDIDATE_LENGTH][:n]


RANDOM = ("base64", "alphanumeric", "hexadecimal", "base32", "lower")
ORDINARY = ("camel", "snake", "upper", "kebab", "path")


def test_held_out_strings(spark, docs):
    """At least 0.9 of the random strings of every alphabet are found, and at most 0.1 of the
    identifiers and paths of every style, in words that the models have never seen."""
    folder = os.environ.get("LAVRA_TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("test data not found")
    weights = ss.train(ss.labelled_sample(spark.read.parquet(f"{folder}/documents.parquet")))
    rows = [(i, one, kind) for kind in RANDOM + ORDINARY for i, one in enumerate(held_out(kind))]
    found = ss.scan(docs(*rows), weights).groupBy("lang").agg(
        F.avg((F.size("secrets") > 0).cast("int")).alias("share")
    )
    shares = {r["lang"]: r["share"] for r in found.collect()}
    assert len(shares) == len(RANDOM + ORDINARY)
    assert all(shares[kind] >= 0.9 for kind in RANDOM), shares
    assert all(shares[kind] <= 0.1 for kind in ORDINARY), shares
