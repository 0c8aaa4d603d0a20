"""Weighted indicators at several grains from one pass over person-level rows.

Every metric is a count, a sum, or a ratio of two sums. `components` computes the sums once
at the finest grain; coarser grains and rolled-up labels add components up, and `finish`
divides last.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import percent, ratio

ROLLED_UP = "_rolled_up"


@dataclass(frozen=True)
class Measures:
    """Person-level columns: 0/1 flags, a nullable score and a nullable weight."""

    person: str
    present: str
    valid: str
    success: str
    score: str
    weight: str

    def components(self) -> dict[str, Column]:
        """Additive parts. A NULL weight drops the row from weighted sums only."""
        weight, score = F.col(self.weight), F.col(self.score)
        return {
            "n_persons": F.count(self.person),
            "n_present": F.sum(self.present),
            "n_valid": F.sum(self.valid),
            "n_success": F.sum(self.success),
            "w_success": F.sum(F.col(self.success) * weight),
            "w_valid": F.sum(F.col(self.valid) * weight),
            "w_score": F.sum(score * weight),
            "w_scored": F.sum(F.when(score.isNotNull(), weight)),
            "sum_score": F.sum(score),
            "n_scored": F.count(score),
        }


COMPONENTS = (
    "n_persons",
    "n_present",
    "n_valid",
    "n_success",
    "w_success",
    "w_valid",
    "w_score",
    "w_scored",
    "sum_score",
    "n_scored",
)


def components(df: DataFrame, dims: Sequence[str], measures: Measures) -> DataFrame:
    """Additive parts per `dims`; hot groups are summed before the shuffle."""
    return df.groupBy(*dims).agg(*[c.alias(n) for n, c in measures.components().items()])


def roll_up(
    parts: DataFrame, dims: Sequence[str], label: str, rolled: str, members: Sequence[str]
) -> DataFrame:
    """Components per `dims` and label, plus one extra label made of `members`.

    Rows of the extra label are tagged, so a source label of the same name stays a row of
    its own. Each component row feeds its own label and, if a member, the extra one, hence
    a single pass and no second scan for the union.
    """
    own = F.struct(F.col(label).alias("label"), F.lit(False).alias("rolled"))
    extra = F.struct(F.lit(rolled).alias("label"), F.lit(True).alias("rolled"))
    targets = F.array(own, F.when(F.col(label).isin(list(members)), extra))
    fed = parts.withColumn("_target", F.explode(F.array_compact(targets)))
    return fed.groupBy(
        *dims, F.col("_target.label").alias(label), F.col("_target.rolled").alias(ROLLED_UP)
    ).agg(*[F.sum(c).alias(c) for c in COMPONENTS])


def success_rate() -> Column:
    """Weighted share of successes among valid persons, in percent."""
    return percent(F.col("w_success"), F.col("w_valid"))


def mean_score() -> Column:
    """Weighted mean score over persons that have one."""
    return ratio(F.col("w_score"), F.col("w_scored"))


def plain_rate() -> Column:
    """Unweighted share of successes, in percent."""
    return percent(F.col("n_success"), F.col("n_valid"))


def plain_mean_score() -> Column:
    return ratio(F.col("sum_score"), F.col("n_scored"))
