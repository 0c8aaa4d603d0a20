"""Left join that keeps its speed when the looked-up side has a hot key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import BROADCAST_BYTES, materialize, measured_bytes

# A hot key of the optional side is cut into parts of at most this size.
SALT_BYTES = 256 * 1024 * 1024
LEAST_SALTS = 64
_SALT = "_salt"


def lookup_join(
    left: DataFrame, sides: Sequence[DataFrame], keys: Sequence[str], limit: int | None = None
) -> DataFrame:
    """`left` LEFT JOIN each of `sides` on equal `keys`; every match of a key gives a row.

    A small side is broadcast. In a larger one a single key may own a large share of the
    rows, and adaptive execution cannot split the optional side of an outer join, so such a
    side is joined by `salted_lookup`.
    """
    bound = BROADCAST_BYTES if limit is None else limit
    for side, size in zip(sides, measured_bytes(*sides), strict=True):
        if size <= bound:
            left = left.join(F.broadcast(side), list(keys), "left")
        else:
            left = salted_lookup(left, side, keys, salts_for(size))
    return left


def salts_for(size: int) -> int:
    """Parts of a side of `size` bytes, so that even one key with all rows has small parts."""
    return max(LEAST_SALTS, -(-size // SALT_BYTES))


def salted_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], salts: int = LEAST_SALTS
) -> DataFrame:
    """The same result as a left join, with every hot key of `right` in `salts` parts.

    The rows of `right` get a written salt, the distinct (key, salt) pairs fan `left` out,
    and the rows are then fetched by key and salt.
    """
    keys = list(keys)
    # NULL keys match nothing. The salt is stored, so a repeated task cannot change it.
    matchable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    salted = materialize(
        right.where(matchable).withColumn(_SALT, F.monotonically_increasing_id() % salts),
        "lookup",
    )
    pairs = salted.select(*keys, _SALT).distinct()
    fanned = left.join(pairs, keys, "left")
    return fanned.join(salted, [*keys, _SALT], "left").drop(_SALT)
