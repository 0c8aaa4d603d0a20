"""Mixing sources along a curriculum of weights that change over training time."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import free_name, words
from lavra.llm.prefix_sums import with_totals_before
from lavra.runtime import bounded, materialize, narrowed

# Weight at equally spaced times of the training, linear between them; sources in the order of
# their names take these in turn. Their integrals are 5, 2 and 1.
SCHEDULES = ((7.5, 5.0, 2.5), (1.0, 2.0, 3.0), (0.5, 1.0, 1.5))
MOST_COPIES = 3
# Words of a gap from which on documents of up to half the gap are taken in rounds.
WIDE_GAP = 1 << 16


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def _integrals(knots: Sequence[float]) -> list[float]:
    """Area under the schedule from the start to every knot."""
    width, area = 1 / (len(knots) - 1), [0.0]
    for a, b in zip(knots, knots[1:], strict=False):
        area.append(area[-1] + (a + b) / 2 * width)
    return area


def targets(sizes: DataFrame, schedules=SCHEDULES, most: int = MOST_COPIES) -> DataFrame:
    """`target` and `schedule` (index) of every row of `sizes` (`source`, `source_size`).

    Sources in code-point order, null last, take the schedules in turn; a schedule's integral
    is the source's weight. Weights share the total of all sizes. A target stops at `most`
    times its source's size, and the excess is shared by weight among the others until none is
    above. That means target = min(cap, level * weight) with one common level: in the order of
    cap / weight, it is what is left over the weights left, at the first source it does not
    exceed. The table has one row per source, so its windows are as small as the mix's list.
    """
    weight = F.lit(0.0)
    for i, knots in enumerate(schedules):
        weight = F.when(F.col("schedule") == i, _integrals(knots)[-1]).otherwise(weight)
    order = Window.orderBy(F.asc_nulls_last("source"))
    ranked = sizes.withColumn("schedule", (F.row_number().over(order) - 1) % len(schedules))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    filling = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = ranked.withColumn("level", left / F.sum("weight").over(after))
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    return level.withColumn("common", F.max(fits).over(everything)).select(
        "source",
        "source_size",
        F.col("schedule").cast("int").alias("schedule"),
        F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight")).alias("target"),
    )


def _time_of(share: Column, schedules) -> Column:
    """When a source has used `share` (0 to 1) of its demand: the inverse of the integral.

    Inside a segment the weight runs from a to b, so the area up to x is
    a x + (b - a) x^2 / (2 width); the root is written so that it also holds for a = b.
    """
    result = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        area, width = _integrals(knots), 1 / (len(knots) - 1)
        inverse = F.lit(1.0)
        for k in reversed(range(len(knots) - 1)):
            a, b = knots[k], knots[k + 1]
            rest = F.greatest(share * area[-1] - area[k], F.lit(0.0))
            root = F.sqrt(F.greatest(a * a + 2 * (b - a) / width * rest, F.lit(0.0)))
            x = F.when(a + root > 0, 2 * rest / (a + root)).otherwise(F.lit(0.0))
            time = k * width + F.least(x, F.lit(width))
            inverse = F.when(share * area[-1] <= area[k + 1], time).otherwise(inverse)
        result = F.when(F.col("schedule") == i, inverse).otherwise(result)
    return result


def assign(
    docs: DataFrame, size: str, row: str, schedules=SCHEDULES, most: int = MOST_COPIES
) -> DataFrame:
    """Per row of `docs` (a written table with `doc_id`, `source`, `size` and a unique `row`):
    `row`, `source_size`, `target`, and `positions`, the training time of each copy.

    Every source is read round by round in the order of a hash of its ids. Whole rounds go
    to all documents, the last one to those that end before the target. What the next one
    would overshoot is filled with later documents until none that is left fits. A copy's
    position is the time at which its source's schedule has asked for the words up to the
    document's middle; the filling comes last. Ids that repeat, or are null, come in the order
    of their size and row. Documents without words may be copied but take nothing; empty
    input gives no rows.
    """
    rows = docs.select(
        F.col(row).alias("row"),
        "source",
        F.col(size).alias("size"),
        F.xxhash64("doc_id").alias("draw"),
        F.col("doc_id").cast("string").alias("id"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = bounded(materialize(targets(sizes, schedules, most), "targets", measured=True))
    order, total = ["id", "size", "row"], F.col("size")
    summed = with_totals_before(rows, ["source"], "draw", order, {"before": total})
    rounds = F.least(F.floor(F.try_divide("target", "source_size")), F.lit(most))
    known = (
        summed.join(
            goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
        )
        .withColumn("rounds", F.coalesce(rounds, F.lit(0)))
        .withColumn("extra", F.col("target") - F.col("rounds") * F.col("source_size"))
        .withColumn("more", (F.col("rounds") < most) & (F.col("before") + total <= F.col("extra")))
    )
    known = materialize(known.drop("of", "extra"), "mix")
    taken = F.sum(total * (F.col("rounds") + F.col("more").cast("int")))
    gaps = known.groupBy("source").agg((F.first("target") - taken).alias("gap"))
    added = bounded(materialize(_fillers(known, gaps, order, most), "mix", measured=True))
    filling = F.col("filled").isNotNull()
    copies = F.col("rounds") + (F.col("more") | filling).cast("int")

    def start(i: Column) -> Column:
        """Words that the source has given before copy `i`."""
        whole = i * F.col("source_size") + F.col("before")
        return F.when(filling & (i == F.col("rounds")), F.col("filled")).otherwise(whole)

    shares = F.transform(
        F.sequence(F.lit(0), F.col("copies").cast("int") - 1),
        lambda i: F.least(
            F.coalesce(F.try_divide(start(i) + total / 2, F.col("target")), F.lit(1.0)),
            F.lit(1.0),
        ),
    )
    return (
        known.join(added, "row", "left")
        .withColumn("copies", copies)
        .select(
            "row",
            "source_size",
            "target",
            F.when(F.col("copies") > 0, F.transform(shares, lambda s: _time_of(s, schedules)))
            .otherwise(F.array().cast("array<double>"))
            .alias("positions"),
        )
    )


def _fillers(known: DataFrame, gaps: DataFrame, order: list[str], most: int) -> DataFrame:
    """`row` of the documents that fill each source's `gap`, and `filled`, the words that the
    source has given before them. At the end no document that is left fits its source's gap.

    Documents are tried by draw and `order` and taken if they fit what is left of the gap, so
    one that did not fit never will. Of documents of one size the first ones are taken, and at
    most gap / size of them: only these are sorted, and they are few however many documents a
    source has. Rounds that take documents of up to half the gap, as far as they fit, come
    first as long as a gap is so wide that even these were many.
    """
    left = known.where(~F.col("more") & (F.col("rounds") < most) & (F.col("size") > 0))
    left = left.select("source", "target", "size", "draw", "id", "row")
    gaps = materialize(gaps, "gaps", measured=True)
    picked = left.select("row", F.lit(0.0).alias("filled")).limit(0)
    while not gaps.where(F.col("gap") >= WIDE_GAP).isEmpty():
        wide = gaps.where(F.col("gap") >= WIDE_GAP)
        halves = _within(left, narrowed(wide, gaps), 2)
        if halves.isEmpty():
            break
        summed = with_totals_before(halves, ["source"], "draw", order, {"before": F.col("size")})
        fits = F.col("before") + F.col("size") <= F.col("gap")
        chosen = summed.where(fits).select(
            "row", "source", "size", (F.col("target") - F.col("gap") + F.col("before")).alias("filled")
        )
        chosen = materialize(chosen, "mix", measured=True)
        picked = picked.unionByName(chosen.select("row", "filled"))
        used = chosen.groupBy("source").agg(F.sum("size").alias("used"))
        used = used.withColumnRenamed("source", "of")
        gaps = gaps.join(used, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")
        )
        gaps = materialize(gaps, "gaps", measured=True)
        left = left.join(bounded(narrowed(chosen.select("row"), chosen)), "row", "left_anti")
    fitting = _within(left, gaps, 1)
    ranked = with_totals_before(
        fitting, ["source", "size"], "draw", order, {"place": F.lit(1).cast("bigint")}
    )
    candidates = ranked.where((F.col("place") + 1) * F.col("size") <= F.col("gap"))
    filled = candidates.groupBy("source").applyInArrow(_first_fit, "row bigint, filled double")
    return picked.unionByName(filled)


def _within(rows: DataFrame, gaps: DataFrame, times: int) -> DataFrame:
    """`rows` with their source's `gap`, if `times` their size is within it; written."""
    of = bounded(narrowed(gaps.withColumnRenamed("source", "of"), gaps))
    fits = F.col("source").eqNullSafe(F.col("of")) & (times * F.col("size") <= F.col("gap"))
    return materialize(rows.join(of, fits).drop("of"), "mix")


def _first_fit(group: pa.Table) -> pa.Table:
    """One source's candidates, in their order, as far as each fits what is left of the gap."""
    ordered = group.sort_by([(name, "ascending") for name in ("draw", "id", "size", "row")])
    rows = zip(
        *(ordered.column(name).to_pylist() for name in ("row", "size", "gap", "target")),
        strict=True,
    )
    taken, before = [], 0
    for row, size, gap, target in rows:
        if before + size <= gap:
            taken.append((row, target - gap + before))
            before += size
    return pa.table(
        [
            pa.array([row for row, _ in taken], pa.int64()),
            pa.array([filled for _, filled in taken], pa.float64()),
        ],
        names=["row", "filled"],
    )


def number_rows(docs: DataFrame, size: Column) -> tuple[DataFrame, str, str]:
    """`docs` written with a size and a row number; and the names of these two columns."""
    size_name, row_name = free_name(docs, "mix_size"), free_name(docs, "mix_row")
    numbered = docs.withColumns({size_name: size, row_name: F.monotonically_increasing_id()})
    return materialize(numbered, "mix"), size_name, row_name


def mix(docs: DataFrame, schedules=SCHEDULES, most: int = MOST_COPIES) -> DataFrame:
    """The training order: every copy of the documents the mix takes, range-sorted by position.

    Columns are those of `docs`; documents that it takes no copy of are missing.
    """
    numbered, size, row = number_rows(docs, word_count(docs["text"]))
    taken = assign(numbered, size, row, schedules, most).where(F.size("positions") > 0)
    taken = taken.select(F.col("row").alias(row), "positions")
    plan = bounded(materialize(taken, "mix", measured=True))
    position = free_name(docs, "position")
    copies = numbered.join(plan.withColumnRenamed("positions", position), row)
    return (
        copies.withColumn(position, F.explode(position))
        .orderBy(position, row)
        .select(*docs.columns)
    )
