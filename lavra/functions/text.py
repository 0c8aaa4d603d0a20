"""Keys, codes and labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(col: Column) -> Column:
    """Strip every kind of Unicode white space from both ends (`F.trim` strips blanks only)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def upper_code(col: Column) -> Column:
    return F.upper(trim_ws(col))


def pad_key(col: Column, width: int) -> Column:
    """Zero-padded text key; longer input is cut to `width`, NULL stays NULL."""
    return F.lpad(col.cast("string"), width, "0")


def label_codes(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """Label of an integer code; unknown and NULL codes get `default`."""
    (first, label), *rest = labels.items()
    expr = F.when(code == first, label)
    for value, label in rest:
        expr = expr.when(code == value, label)
    return expr.otherwise(default)


def key_text(*parts: Column) -> Column:
    """Composite key as text with `-` between the parts; NULL if any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), part.cast("string")]
    return F.concat(*pieces[1:])


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
