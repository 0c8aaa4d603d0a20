"""Exact range join of vectors under a metric, by pivots.

On unit vectors a cosine is a distance: |x - y|^2 = 2 - 2 cos. Every vector lives in the cell
of its nearest pivot. By the triangle inequality a vector y within r of some x of cell i has
d(y, p_i) <= d(y, nearest) + 2 r, so copies go to exactly these cells, and each cell can be
joined by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches, free_name
from lavra.llm.components import connected_components
from lavra.runtime import bounded, materialize

MIN_COSINE = 0.98
# Vectors that one task holds as the home side of a cell, on average.
HOME_ROWS = 2048
# Bound of the pivots, which every task gets: cells grow beyond HOME_ROWS if there are more
# vectors than this times HOME_ROWS, and are then split into more home sides.
MOST_PIVOTS = 4096

_OTHER_ROWS = 4096
_LEAST_DRAWN = 64
_SLACK = 1e-9
_KEY = ["label", "dims", "cell", "chunk"]


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares of tiny and huge values finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _assigner(pivots: dict, radius: float):
    """Home cell and the cells to copy to, of classes (`class`, `label`, `vector`, `n`)."""

    def cells_of(vectors: np.ndarray, own: np.ndarray | None):
        if own is None:
            return [0] * len(vectors), [[0]] * len(vectors)
        distance = np.sqrt(np.maximum(2 - 2 * _unit(vectors) @ own.T, 0))
        nearest = distance.min(axis=1, keepdims=True)
        near = distance <= nearest + 2 * radius + _SLACK
        return distance.argmin(axis=1).tolist(), [np.flatnonzero(row).tolist() for row in near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = {key: _unit(np.array(rows)) for key, rows in pivots.value.items()}
        for batch in batches:
            labels = batch.column("label").to_pylist()
            dims = batch.column("dims").to_pylist()
            home, near = [0] * len(labels), [[0]] * len(labels)
            by_key: dict = {}
            for i, key in enumerate(zip(labels, dims, strict=True)):
                by_key.setdefault(key, []).append(i)
            for key, found in by_key.items():
                chosen = batch.column("vector").take(pa.array(found))
                cells = cells_of(_matrix(chosen), matrices.get(key))
                for i, cell, others in zip(found, *cells, strict=True):
                    home[i], near[i] = cell, others
            added = [pa.array(home, pa.int32()), pa.array(near, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, "cell", "near"]
            )

    return run


def _blocks_roots(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row reachable from every row and column of a two-sided graph."""
    rows = np.arange(linked.shape[0])
    far = linked.shape[0]
    while True:
        columns = np.where(linked, rows[:, None], far).min(axis=0)
        smaller = np.minimum(rows, np.where(linked, columns[None, :], far).min(axis=1))
        smaller = smaller[smaller]
        if (smaller == rows).all():
            return rows, columns
        rows = smaller


def _joiner(min_cosine: float):
    """Cells (home rows first, then copies) to link counts and edges that keep connectivity."""

    def linked_pairs(home: np.ndarray, other: np.ndarray) -> np.ndarray:
        cosine = _unit(home) @ _unit(other).T
        linked = cosine >= min_cosine
        # Where the product's rounding could decide, the quotient of plain sums does.
        for i, j in np.argwhere(np.abs(cosine - min_cosine) < _SLACK):
            a, b = home[i], other[j]
            linked[i, j] = a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= min_cosine
        return linked

    def of_cell(home, others) -> Iterator[pa.RecordBatch]:
        ids, vectors = home
        counts = np.zeros(len(ids), np.int64)
        for other_ids, other_vectors, n in others:
            linked = linked_pairs(vectors, other_vectors)
            linked &= ids[:, None] != other_ids[None, :]
            counts += linked @ n
            i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            if len(i):
                rows, columns = _blocks_roots(linked[np.ix_(i, j)])
                src = np.concatenate([ids[i], other_ids[j]])
                dst = np.concatenate([ids[i][rows], ids[i][columns]])
                yield out(src[src != dst], dst=dst[src != dst])
        yield out(ids, links=counts)

    def out(src, dst=None, links=None):
        nothing = pa.nulls(len(src), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(src, pa.int64()),
                nothing if dst is None else pa.array(dst, pa.int64()),
                nothing if links is None else pa.array(links, pa.int64()),
            ],
            names=["class", "dst", "links"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in _parts(batch))
        for _, group in groupby(parts, lambda part: part[0]):
            home, rest = [], iter(())
            for _, is_copy, ids, vectors, n in group:
                if is_copy:
                    rest = iter([(ids, vectors, n)])
                    break
                home.append((ids, vectors))
            if not home:
                continue
            sides = [np.concatenate(side) for side in zip(*home, strict=True)]
            more = ((ids, vectors, n) for _, _, ids, vectors, n in group)
            yield from of_cell(sides, (part for source in (rest, more) for part in source))

    return run


def _parts(batch: pa.RecordBatch):
    """Runs of rows with one key and side, in blocks."""
    keys = list(zip(*(batch.column(name).to_pylist() for name in [*_KEY, "copy"]), strict=True))
    ids, n = (batch.column(name).to_numpy() for name in ("class", "n"))
    for key, places in groupby(range(len(keys)), keys.__getitem__):
        places = list(places)
        for at in range(0, len(places), _OTHER_ROWS):
            a, b = places[at], places[min(at + _OTHER_ROWS, len(places)) - 1] + 1
            vectors = _matrix(batch.column("vector").slice(a, b - a))
            yield key[:-1], key[-1], ids[a:b], vectors, n[a:b]


def _pivots(classes: DataFrame) -> dict:
    """Vectors of (label, dims) groups with more than one cell, drawn by hash."""
    counts = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("size"))
    total = classes.count()
    home = max(HOME_ROWS, -(-total // MOST_PIVOTS))
    large = bounded(
        materialize(
            counts.where(F.col("size") > home).select(
                "label", "dims", F.ceil(F.col("size") / home).alias("cells"), "size"
            ),
            "cells",
            measured=True,
        )
    )
    # A multiple of what is needed is ranked, not all vectors of a label with many.
    enough = F.greatest(F.lit(_LEAST_DRAWN), 4 * F.col("cells")) / F.col("size")
    low = F.shiftrightunsigned(F.xxhash64("vector"), 1) <= enough * float(1 << 63)
    draw = Window.partitionBy("label", "dims").orderBy(F.xxhash64("vector"), "class")
    drawn = (
        classes.join(large, ["label", "dims"])
        .where(low)
        .withColumn("place", F.row_number().over(draw))
        .where((F.col("place") <= MOST_PIVOTS) & (F.col("place") <= F.col("cells")))
        .select("label", "dims", "vector")
    )
    pivots: dict = {}
    for row in drawn.toLocalIterator():
        pivots.setdefault((row["label"], row["dims"]), []).append(list(row["vector"]))
    return pivots


def near_duplicates(
    vectors: DataFrame,
    id_name: str = "vec_id",
    vector_name: str = "embedding",
    label_name: str = "label",
    min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """Id, `n_links` and `component_id` of every row of `vectors`.

    Rows link if their labels are equal and not null, their lengths are equal, and the cosine
    in double precision is at least `min_cosine`. Vectors that are null, empty, zero, or hold a
    null, NaN or infinite component link with nothing. Equal vectors of a label are one class
    and are compared once: a row's links are the other rows of its class and all rows of linked
    classes. The component is the smallest id reachable; null ids are a component's only if
    it has no other. Other columns are not looked at.
    """
    if not 0 < min_cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = vectors.select(
        F.col(id_name).alias("id"),
        F.col(label_name).alias("label"),
        F.col(vector_name).alias("vector"),
    )
    usable = F.col("label").isNotNull() & _usable(F.col("vector"))
    classes = (
        rows.where(usable)
        .groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .withColumn("class", F.monotonically_increasing_id())
        .withColumn("dims", F.size("vector"))
    )
    classes = materialize(classes, "vectors")
    pivots = spark.sparkContext.broadcast(_pivots(classes))
    radius = float(np.sqrt(2 - 2 * min_cosine))
    compared = classes.select("class", "label", "dims", "vector", "n")
    schema = _schema(compared, "cell int, near array<int>")
    placed = materialize(compared.mapInArrow(_assigner(pivots, radius), schema), "cells")
    sides = _sides(placed)
    order = [*_KEY, "copy"]
    found = sides.repartition(*_KEY).sortWithinPartitions(*order)
    found = materialize(
        found.mapInArrow(_joiner(min_cosine), "class bigint, dst bigint, links bigint"), "links"
    )
    members = connected_components(
        found.where("dst is not null").select(F.col("class").alias("src"), "dst")
    )
    counted = found.where("links is not null").select("class", "links")
    grouped = (
        classes.select("class", "label", "vector", "n", "first_id")
        .join(counted, "class")
        .join(members.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("smallest"))
    known = grouped.join(smallest, "component").select(
        F.col("label").alias("of_label"),
        F.col("vector").alias("of_vector"),
        (F.col("n") - 1 + F.col("links")).alias("links"),
        "smallest",
    )
    known = bounded(materialize(known, "links"))
    same = (F.col("label") == F.col("of_label")) & (F.col("vector") == F.col("of_vector"))
    return rows.join(known, same & usable, "left").select(
        F.col("id").alias(id_name),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("smallest")).alias(
            "component_id"
        ),
    )


def _schema(df: DataFrame, more: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*fields, more])


def _sides(placed: DataFrame) -> DataFrame:
    """Home rows with their chunk of the cell, and copies for every chunk of the cells near."""
    cells = placed.groupBy("label", "dims", "cell").agg(
        F.ceil(F.count(F.lit(1)) / (2 * HOME_ROWS)).cast("int").alias("chunks")
    )
    cells = bounded(materialize(cells, "cells"))
    columns = [*_KEY, "copy", "class", "n", "vector"]
    home = (
        placed.join(cells, ["label", "dims", "cell"])
        .withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
        .withColumn("copy", F.lit(False))
    )
    copies = (
        placed.withColumn("cell", F.explode("near"))
        .join(cells, ["label", "dims", "cell"])
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("copy", F.lit(True))
    )
    return home.select(columns).unionByName(copies.select(columns))


def keep_representatives(
    vectors: DataFrame, id_name: str = "vec_id", vector_name: str = "embedding"
) -> DataFrame:
    """The rows of `vectors` whose id leads their component."""
    found = near_duplicates(vectors, id_name, vector_name)
    leader = free_name(vectors, "leader")
    leaders = found.where(F.col(id_name) == F.col("component_id"))
    leaders = leaders.select(F.col(id_name).alias(leader)).distinct()
    return vectors.join(leaders, vectors[id_name] == F.col(leader), "left_semi")
