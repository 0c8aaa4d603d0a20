from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lavra.functions.numbers import deviation, for_year, percent, ratio, target_met, whole
from lavra.functions.text import blank_if_null, key_text, label_codes, pad_key, trim_ws, upper_code
from lavra.functions.times import instant
from lavra.plans import fixed


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_pad_key(table):
    df = table("k string", ("42",), ("12345678",), ("1234567",), (None,))
    assert one(df, pad_key(F.col("k"), 7)) == ["0000042", "1234567", "1234567", None]
    assert one(table("k bigint", (42,)), pad_key(F.col("k"), 7)) == ["0000042"]


def test_trim_strips_all_white_space_at_the_ends_only(table):
    df = table("x string", ("\t a b   \n",), ("",), ("  ",), (None,))
    assert one(df, trim_ws(F.col("x"))) == ["a b", "", "", None]
    assert one(df, upper_code(F.col("x"))) == ["A B", "", "", None]


def test_labels(table):
    df = table("c bigint", *[(i,) for i in (0, 1, 2, 3, 4, 5, 6, 7, None)])
    labels = one(df, label_codes(F.col("c"), fixed.NETWORK_LABELS, fixed.NETWORK_UNKNOWN))
    assert labels == [
        "Total", "Federal", "Estadual", "Municipal", "Privada", "Pública", "Pública",
        "Desconhecida", "Desconhecida",
    ]


def test_key_text_is_null_unless_blanked(table):
    df = table("a string, b bigint", ("x", 1), (None, 1), ("x", None))
    assert one(df, key_text(F.col("a"), F.col("b"))) == ["x-1", None, None]
    assert one(df, key_text(blank_if_null(F.col("a")), F.col("b"))) == ["x-1", "-1", None]


def test_whole_rounds_half_away_from_zero(table):
    df = table("x double", (2.5,), (-2.5,), (2.4,), (None,))
    assert one(df, whole(df, "x")) == [3, -3, 2, None]
    text = table("x string", ("7",))
    assert one(text, whole(text, "x")) == [7]
    bad = table("x string", ("x",))
    with pytest.raises(PySparkException):
        one(bad, whole(bad, "x"))


def test_ratio_of_zero_or_null_is_null(table):
    df = table("a double, b double", (1.0, 2.0), (1.0, 0.0), (None, 1.0), (1.0, None))
    assert one(df, ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None]
    assert one(df, percent(F.col("a"), F.col("b"))) == [50.0, None, None, None]


def test_for_year(table):
    columns = ", ".join(f"meta_{y} double" for y in fixed.TARGET_YEARS)
    targets = tuple(float(y) for y in fixed.TARGET_YEARS)
    df = table(
        f"ano bigint, {columns}",
        *[(y, *targets) for y in range(2023, 2032)],
        (2024, None, *targets[1:]),
        (None, *targets),
    )
    picked = one(df, for_year(F.col("ano"), fixed.TARGET_YEARS, "meta_{year}"))
    assert picked == [None, *targets, None, None, None]


def test_deviation_and_flag(table):
    df = table("a double, t double", (2.0, 1.0), (1.0, 1.0), (0.0, 1.0), (None, 1.0), (1.0, None))
    assert one(df, deviation(F.col("a"), F.col("t"))) == [1.0, 0.0, -1.0, None, None]
    assert one(df, target_met(F.col("a"), F.col("t"))) == [True, True, False, None, None]


def test_instant_is_utc(spark):
    at = dt.datetime(2024, 5, 1, 12, 30, 0, 123456, tzinfo=dt.timezone.utc)
    shown = spark.range(1).select(F.date_format(instant(at), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert shown.first()[0] == "2024-05-01 12:30:00.123456"
    naive = instant(at.replace(tzinfo=None))
    assert spark.range(1).select(naive == instant(at)).first()[0] is True
