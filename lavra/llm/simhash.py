"""SimHash near-duplicates found through multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches, free_name
from lavra.llm.components import connected_components
from lavra.runtime import bounded, materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

_BITS = 64
# Shingle hashes whose bits are counted at once, so that memory does not grow with the text.
_BLOCK = 1 << 15


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text; 0 without a word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle_words, len(words))
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(_BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    ones = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of `text` as a signed 64-bit column."""

    @F.pandas_udf("bigint")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = (fingerprint_of(text, shingle_words) for text in texts)
            yield pd.Series(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return simhash(text)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def linked_fingerprints(
    distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = 2
) -> DataFrame:
    """Pairs (`src`, `dst`) of the `fingerprint` values in `distinct` that differ in at most
    `max_bits` bits, each pair at least once.

    If two fingerprints differ in `max_bits` bits, they differ in at most
    `max_bits // segments` bits of one segment. Every fingerprint therefore stands once per
    segment in the table and looks up all keys of that small Hamming ball; the complete
    distance is part of the join condition, so only true pairs leave the join.
    """
    if not 1 <= segments <= 8:
        raise ValueError("segments must be 1 to 8")
    width = -(-_BITS // segments)
    radius = max_bits // segments
    masks = [
        sum(1 << bit for bit in bits)
        for size in range(radius + 1)
        for bits in combinations(range(width), size)
    ]
    low = F.lit(_signed((1 << width) - 1))
    keys = [
        F.struct(
            F.lit(i).alias("segment"),
            F.shiftrightunsigned("fingerprint", i * width).bitwiseAND(low).alias("key"),
        )
        for i in range(segments)
    ]
    table = distinct.select(F.col("fingerprint").alias("dst"), F.inline(F.array(*keys)))
    ball = F.array(*[F.lit(_signed(mask)) for mask in masks])
    asked = table.select(
        F.col("dst").alias("src"),
        "segment",
        F.explode(F.transform(ball, lambda mask: F.col("key").bitwiseXOR(mask))).alias("key"),
    )
    distance = F.bit_count(F.col("src").bitwiseXOR(F.col("dst")))
    return (
        asked.join(table, ["segment", "key"])
        .where((F.col("src") < F.col("dst")) & (distance <= max_bits))
        .select("src", "dst")
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """`fingerprint` (bigint) and `component_id` for every row of `docs` (`doc_id`, `text`).

    Words of three make a shingle, repeats included; fewer words make one shingle; null, empty
    and blank texts have fingerprint 0 and link like any other. The component is the smallest
    `doc_id` reachable through links; null ids are only a component's id where it has no
    other. Repeated rows stay repeated. Other columns are not looked at.
    """
    bound_batches(docs.sparkSession)
    marked = materialize(
        docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fingerprint")),
        "fingerprints",
    )
    ids = _components(marked, max_bits).select("fingerprint", "component_id")
    return marked.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _components(marked: DataFrame, max_bits: int) -> DataFrame:
    """`component` (its smallest fingerprint) and `component_id` of every `fingerprint`."""
    # Copies meet here, after partial aggregation: one row per fingerprint goes on.
    distinct = materialize(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprints"
    )
    links = linked_fingerprints(distinct.select("fingerprint"), max_bits)
    members = connected_components(links).withColumnRenamed("node", "fingerprint")
    grouped = distinct.join(members, "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return grouped.join(smallest, "component").select("fingerprint", "component", "component_id")


def keep_representatives(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of every component of `docs`, with all columns: the one whose id is the
    component's. Of rows that repeat this id one stays, and of a component whose ids are all
    null as well."""
    bound_batches(docs.sparkSession)
    mark, row = free_name(docs, "fingerprint"), free_name(docs, "row_number")
    # Written with the texts, so that row numbers stay what they are if a task runs again.
    numbered = materialize(
        docs.withColumns(
            {
                mark: fingerprint(F.col("text"), shingle_words),
                row: F.monotonically_increasing_id(),
            }
        ),
        "fingerprints",
    )
    marked = numbered.select("doc_id", F.col(mark).alias("fingerprint"), F.col(row).alias("row"))
    leaders = (
        marked.join(_components(marked, max_bits), "fingerprint")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min("row").alias(row))
        .select(row)
    )
    leaders = bounded(materialize(leaders, "leaders"))
    return numbered.join(leaders, row, "left_semi").select(*docs.columns)


def _signed(mask: int) -> int:
    """The 64 bits of `mask` as a signed number."""
    return mask - (1 << _BITS) if mask >> (_BITS - 1) else mask
