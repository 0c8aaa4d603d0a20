"""Written intermediate tables and measured broadcast bounds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after its values were measured to fit in this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

_CELL_OVERHEAD = 16
_EIGHT_BYTES = (T.NumericType, T.BooleanType, T.DatetimeType, T.TimestampType, T.TimestampNTZType)


# Folders written by `materialize` that nobody has released yet, by session.
_written: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names in `spark.checkpoint.dir`, or the one its
    context was given. Without either this raises: a local folder would be lost with, and
    unseen by, other machines."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; `release` removes what is written there."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove all scratch folders of this session. Call it when results that were built from
    them have been consumed: their plans still read the files."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders that the block writes at its end; those from before stay."""
    mine = _written.pop(spark.sparkContext.applicationId, [])
    try:
        yield
    finally:
        release(spark)
        if mine:
            _written[spark.sparkContext.applicationId] = mine


def materialize(df: DataFrame, label: str, measured: bool = False) -> DataFrame:
    """Write `df` once and go on from the files.

    Cuts the lineage, so several consumers share one computation and a lost executor
    costs a re-read, not a recomputation. The files stay until `release`. With `measured`
    the size is added up while writing, so that `measured_bytes` need not scan again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    size = None
    if measured:
        df, size = observe_size(df)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    return with_size(written, size() if size else None)


def observe_size(df: DataFrame) -> tuple[DataFrame, Callable[[], int | None]]:
    """`df`, and a function that tells its size once it was written; None if Spark found it to
    be empty while planning, since nothing is then observed."""
    size = Observation()

    def told() -> int | None:
        try:
            return size.get["bytes"]
        except Py4JJavaError:
            return None

    return df.observe(size, _size(df).cast("bigint").alias("bytes")), told


def with_size(df: DataFrame, size: int | None) -> DataFrame:
    """Remember that `df` has at most `size` bytes; None leaves it to be measured."""
    df._lavra_bytes = size
    return df


def narrowed(df: DataFrame, whole: DataFrame) -> DataFrame:
    """`df`, made of rows of `whole` and no more of its columns, has at most its known size."""
    return with_size(df, getattr(whole, "_lavra_bytes", None))


@contextmanager
def staging(df: DataFrame, label: str, folders: Sequence[str] = ()) -> Iterator[DataFrame]:
    """Like `materialize`, for consumers that all finish inside the block; the files are
    removed at its end. Filters on the `folders` columns read only the matching files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*folders).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it; one that is not there is fine."""
    folder, system = _hadoop(spark, path)
    system.delete(folder, True)


def child_paths(spark: SparkSession, path: str) -> list[str]:
    """Folders and files directly below `path`, as `path`/name."""
    folder, system = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    return [f"{path.rstrip('/')}/{child.getPath().getName()}" for child in system.listStatus(folder)]


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _hadoop(spark, path)
    return system.exists(folder)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, read by the driver."""
    file, system = _hadoop(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with `text`, unless the path exists: then False and no change.

    Of several that try at once one succeeds, and nobody ever sees half a file: the text is
    written beside it and then given its name, by a rename that does not replace, which the
    file system makes atomic. Local files get the name by a link, as their rename replaces.
    """
    target, system = _hadoop(spark, path)
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path
    system.mkdirs(target.getParent())
    draft = jpath(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getScheme() == "file":
            # The real folder, also behind a mount table.
            local = [jvm.java.io.File(system.resolvePath(draft.getParent()).toUri().getPath(), name)
                     for name in (target.getName(), draft.getName())]
            jvm.java.nio.file.Files.createLink(*[file.toPath() for file in local])
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()
            )
            none = spark.sparkContext._gateway.new_array(
                jvm.org.apache.hadoop.fs.Options.Rename, 0
            )
            context.rename(draft, target, none)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)


def move_absent(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name that must be free."""
    source, system = _hadoop(spark, path)
    goal, _ = _hadoop(spark, target)
    if system.exists(goal) or not system.rename(source, goal):
        raise FileExistsError(target)


def file_times(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files directly below `path` with their modification time in milliseconds."""
    folder, system = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    return [
        (f"{path.rstrip('/')}/{one.getPath().getName()}", one.getModificationTime())
        for one in system.listStatus(folder)
        if one.isFile() and not one.getPath().getName().startswith(("_", "."))
    ]


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def measured_bytes(*sides: DataFrame) -> list[int]:
    """Per side, the size of all its values plus an overhead per cell.

    Sides that were measured while they were written need no job. All others share one: each
    is a distributed sum, the driver gets one number per side.
    """
    known = [getattr(side, "_lavra_bytes", None) for side in sides]
    sizes = [
        side.agg(_size(side).cast("bigint").alias("size")).select(F.lit(i).alias("side"), "size")
        for i, side in enumerate(sides)
        if known[i] is None
    ]
    if sizes:
        for row in reduce(lambda a, b: a.unionByName(b), sizes).collect():
            known[row["side"]] = row["size"]
    return known


def _size(df: DataFrame) -> Column:
    """Aggregate: fixed widths times rows, plus the text lengths of all other columns."""
    fixed = 0
    size = F.lit(0)
    for field in df.schema.fields:
        fixed += _CELL_OVERHEAD
        if isinstance(field.dataType, _EIGHT_BYTES):
            fixed += 8
        else:
            length = F.octet_length(F.col(f"`{field.name}`").cast("string"))
            size = size + F.coalesce(F.sum(length), F.lit(0))
    return size + F.count(F.lit(1)) * fixed


def fits_broadcast(*sides: DataFrame, limit: int | None = None) -> list[bool]:
    """Per side, whether it was measured to be small enough to copy to every executor."""
    bound = BROADCAST_BYTES if limit is None else limit
    return [size <= bound for size in measured_bytes(*sides)]


def bounded(df: DataFrame, limit: int | None = None) -> DataFrame:
    """`df` marked for broadcast if it was measured to fit; otherwise unchanged.

    Unmarked sides join by shuffle, where adaptive execution splits hot partitions.
    """
    (size,) = measured_bytes(df)
    fits = size <= (BROADCAST_BYTES if limit is None else limit)
    return with_size(F.broadcast(df) if fits else df, size)
