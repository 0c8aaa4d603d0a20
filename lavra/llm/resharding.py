"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import free_name, utf8_bytes
from lavra.llm.prefix_sums import with_totals_before
from lavra.runtime import bounded, materialize, scratch_path

# Bytes a row takes besides its text.
ROW_BYTES = 16
# Bytes that go into one file, on average.
FILE_BYTES = 64 << 20


@dataclass(frozen=True)
class Block:
    """Rows of shard `old` whose draw is at least `first_draw`, up to the next block's."""

    old: int
    first_draw: int
    new: int
    size: int


def flows(
    supplies: Sequence[int],
    capacities: Sequence[int],
    cost: Callable[[int, int], int] = lambda old, new: int(old != new),
) -> dict[tuple[int, int], int]:
    """Bytes from every old to every new shard, of least total cost.

    Successive shortest paths: each round sends as much as possible over the cheapest way from a
    supply to a free capacity, which may take back what earlier rounds sent. `capacities` must
    be able to hold `supplies`. The work depends on the number of shards, not of rows.
    """
    if sum(capacities) < sum(supplies):
        raise ValueError("the new shards cannot hold all bytes")
    left, free = list(supplies), list(capacities)
    sent: dict[tuple[int, int], int] = {}
    while any(left):
        way = _cheapest_way(left, free, sent, cost)
        taken_back = (sent[way[k + 1], way[k]] for k in range(1, len(way) - 1, 2))
        amount = min(left[way[0]], free[way[-1]], *taken_back)
        for k in range(0, len(way) - 1, 2):
            sent[way[k], way[k + 1]] = sent.get((way[k], way[k + 1]), 0) + amount
        for k in range(1, len(way) - 1, 2):
            sent[way[k + 1], way[k]] -= amount
        left[way[0]] -= amount
        free[way[-1]] -= amount
    return {pair: amount for pair, amount in sorted(sent.items()) if amount}


def _cheapest_way(left, free, sent, cost) -> list[int]:
    """Old and new shards in turn, from one with a supply left to one with free capacity."""
    olds, news = range(len(left)), range(len(free))
    to_old = {i: (0, None) for i in olds if left[i]}
    to_new: dict[int, tuple[int, int]] = {}
    backward: dict[int, list[int]] = {}
    for (i, j), amount in sent.items():
        if amount:
            backward.setdefault(j, []).append(i)
    changed = set(to_old)
    while changed:
        reached = set()
        for i in changed:
            for j in news:
                price = to_old[i][0] + cost(i, j)
                if j not in to_new or price < to_new[j][0]:
                    to_new[j] = (price, i)
                    reached.add(j)
        changed = set()
        for j in reached:
            for i in backward.get(j, ()):
                price = to_new[j][0] - cost(i, j)
                if i not in to_old or price < to_old[i][0]:
                    to_old[i] = (price, j)
                    changed.add(i)
    at = min((j for j in to_new if free[j]), key=lambda j: (to_new[j][0], j))
    way = [at]
    while True:
        i = to_new[way[-1]][1]
        way.append(i)
        if to_old[i][1] is None:
            return way[::-1]
        way.append(to_old[i][1])


def _draw(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, plus `ROW_BYTES`."""
    return utf8_bytes(text) + ROW_BYTES


def plan_blocks(rows: DataFrame, old_shards: int, new_shards: int) -> list[Block]:
    """Blocks of `rows` (`old`, `draw`, `size`) for `new_shards` shards of equal bytes.

    Rows of an old shard are lined up by their draw. The flow from it to every new shard is a
    stretch of that line; a row belongs to the stretch that its middle lies in.
    """
    sums = rows.groupBy("old").agg(F.sum("size").alias("size")).collect()
    sizes = {row["old"]: row["size"] for row in sums}
    supplies = [sizes.get(i, 0) for i in range(old_shards)]
    total = sum(supplies)
    ends_at = [total * j // new_shards for j in range(new_shards + 1)]
    capacities = [b - a for a, b in pairwise(ends_at)]
    moves = flows(supplies, capacities)
    cuts: dict[int, list[tuple[int, int]]] = {}
    for (old, new), amount in moves.items():
        stretch = cuts.setdefault(old, [])
        stretch.append((stretch[-1][0] + amount if stretch else amount, new))
    if not cuts:
        return []
    lined = with_totals_before(rows, ["old"], "draw", ["size"], {"before": F.col("size")})
    middle = F.col("before") + F.col("size") / 2
    ends = F.create_map(
        *(
            x
            for old, stretch in cuts.items()
            for x in (F.lit(old), F.array(*[F.lit(e) for e, _ in stretch]).cast("array<bigint>"))
        )
    )
    passed = F.size(F.filter(F.element_at(ends, F.col("old")), lambda end: end <= middle))
    found = (
        lined.withColumn("stretch", F.least(passed, F.size(F.element_at(ends, F.col("old"))) - 1))
        .groupBy("old", "stretch")
        .agg(F.min("draw").alias("first_draw"), F.sum("size").alias("size"))
        .orderBy("old", "stretch")
    )
    return [
        Block(row["old"], row["first_draw"], cuts[row["old"]][row["stretch"]][1], row["size"])
        for row in found.collect()
    ]


def shard_of(old: Column, draw: Column, blocks: Sequence[Block]) -> Column:
    """New shard of a row, from the blocks of its old shard in the order of their draws."""
    by_old: dict[int, list[Block]] = {}
    for block in blocks:
        by_old.setdefault(block.old, []).append(block)
    entries = []
    for old_shard, own in by_old.items():
        pairs = [
            F.struct(F.lit(b.first_draw).cast("bigint").alias("draw"), F.lit(b.new).alias("new"))
            for b in own
        ]
        entries += [F.lit(old_shard), F.array(*pairs)]
    reached = F.filter(F.element_at(F.create_map(*entries), old), lambda b: b["draw"] <= draw)
    return F.element_at(reached, -1)["new"].cast("int")


def reshard(
    docs: DataFrame, old: Column, old_shards: int, new_shards: int, path: str | None = None
) -> DataFrame:
    """Move `docs` (`doc_id`, `text` and more) from the shards that `old` names (0 to
    `old_shards` - 1) to `new_shards` shards of nearly equal bytes, and write the shards that
    change as `path`/shard=N. Returns all rows with `shard`, `slot` (from 0, without gaps)
    and `moved`; columns of these names are replaced.

    A row moves only if its old shard is too large or no longer exists. Shards that nothing
    moves to or from are not written: their rows come from `docs`. Rows that are equal in id and
    text go together. Null texts have no bytes and null ids are like any other; no rows give
    an empty result.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot", "moved")
    names = {name: free_name(docs, name) for name in ("old", "draw", "file", "of", "part", "first")}
    named = docs.withColumns(
        {names["old"]: old.cast("int"), names["draw"]: _draw(docs["doc_id"], docs["text"])}
    )
    rows = named.select(
        F.col(names["old"]).alias("old"),
        F.col(names["draw"]).alias("draw"),
        row_size(F.col("text")).alias("size"),
    )
    rows = materialize(rows, "rows")
    blocks = plan_blocks(rows, old_shards, new_shards)
    if not blocks:
        empty = docs.withColumns(
            {
                "shard": F.lit(None).cast("int"),
                "slot": F.lit(None).cast("bigint"),
                "moved": F.lit(None).cast("boolean"),
            }
        )
        return empty.where(F.lit(False))
    changed = {x for b in blocks if b.old != b.new for x in (b.old, b.new)}
    files = max(1, sum(b.size for b in blocks) // new_shards // FILE_BYTES)
    shard = shard_of(F.col(names["old"]), F.col(names["draw"]), blocks)
    file = F.pmod(F.col(names["draw"]), F.lit(files))
    slots = _first_slots(
        rows.select(
            shard_of(F.col("old"), F.col("draw"), blocks).alias("shard"),
            F.pmod("draw", F.lit(files)).alias("file"),
        )
    )
    slots = bounded(materialize(slots, "slots"))
    inside = Window.partitionBy("shard", names["file"]).orderBy(names["draw"], "doc_id", "text")
    of, part, first = names["of"], names["part"], names["first"]
    slots = slots.toDF(of, part, first)
    placed = (
        named.withColumns({"shard": shard, names["file"]: file})
        .withColumn("slot", F.row_number().over(inside) - 1)
        .join(slots, (F.col("shard") == F.col(of)) & (F.col(names["file"]) == F.col(part)))
        .withColumn("slot", (F.col("slot") + F.col(first)).cast("bigint"))
        .withColumn("moved", F.col("shard") != F.col(names["old"]))
        .select(*docs.columns, "slot", "moved", "shard")
    )
    path = path or scratch_path(spark, "shards")
    affected = placed.where(F.col("shard").isin(sorted(changed)))
    affected.write.partitionBy("shard").parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    if changed.issuperset({b.new for b in blocks}):
        return written
    return written.unionByName(placed.where(~F.col("shard").isin(sorted(changed))))


def _first_slots(rows: DataFrame) -> DataFrame:
    """First slot of every file of a shard: one row per file."""
    counts = rows.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.select(
        "shard", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
