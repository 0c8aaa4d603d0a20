"""Volume and coverage of a sample relative to the full base."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import percent
from lavra.operators.distinct import by_value, count_values, with_count


@dataclass(frozen=True)
class FreshnessNames:
    """Output column names."""

    rows: str
    persons: str
    places: str
    first: str
    last: str
    coverage: str


def freshness(
    sample: DataFrame,
    base: DataFrame,
    group: str,
    person: str,
    place: str,
    at: str,
    names: FreshnessNames,
) -> DataFrame:
    """Per group: rows, distinct persons and places, first and last time, and the share of
    all persons of `base` (over all groups) that the group covers.

    Persons are many and counted by value, together with what one pass can tell; places are
    few and counted in bitmaps. `sample` is read twice more for its places.
    """
    everyone = base.select(F.countDistinct(person)).scalar()
    counted = by_value(
        sample,
        group,
        person,
        names.persons,
        rows=names.rows,
        least={names.first: at},
        most={names.last: at},
    )
    places = count_values(sample, group, place, names.places)
    return with_count(counted, group, places, names.places).select(
        group,
        names.rows,
        names.persons,
        names.places,
        names.first,
        names.last,
        percent(F.col(names.persons), everyone).alias(names.coverage),
    )
