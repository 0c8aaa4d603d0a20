"""Typed and renamed projections, declared as a list of fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import whole
from lavra.functions.text import label_codes, pad_key, trim_ws, upper_code


@dataclass(frozen=True)
class Field:
    """One output column. `kind`: keep, text, code, key, whole, number or label."""

    name: str
    kind: str = "keep"
    source: str = ""
    width: int = 0
    labels: Mapping[int, str] | None = None
    default: str = ""

    def column(self, df: DataFrame) -> Column:
        name = self.source or self.name
        col = F.col(name)
        if self.kind == "text":
            col = trim_ws(col)
        elif self.kind == "code":
            col = upper_code(col)
        elif self.kind == "key":
            col = pad_key(col, self.width)
        elif self.kind == "whole":
            col = whole(df, name)
        elif self.kind == "number":
            col = col.cast("double")
        elif self.kind == "label":
            # The cast comes first: codes may arrive as text.
            col = label_codes(whole(df, name), self.labels, self.default)
        return col.alias(self.name)


def project(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Exactly `fields`, in order; unused input columns are pruned from the scan."""
    return df.select(*[field.column(df) for field in fields])


def numbers_by_year(target: str, source: str, years: Sequence[int]) -> list[Field]:
    """One number column per year, renamed from `source` to `target` (both hold `{year}`)."""
    return [
        Field(target.format(year=y), "number", source.format(year=y)) for y in years
    ]
