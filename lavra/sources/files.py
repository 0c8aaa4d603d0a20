"""File readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STATE = "`regiao-imediata`.`regiao-intermediaria`.UF"

_REGION_TYPE = "struct<sigla: string, nome: string>"
_STATE_TYPE = f"struct<id: bigint, sigla: string, nome: string, regiao: {_REGION_TYPE}>"
PLACES_JSON = (
    "id bigint, nome string, "
    f"`regiao-imediata` struct<`regiao-intermediaria`: struct<UF: {_STATE_TYPE}>>"
)

# Quotes inside quoted text are doubled, as other CSV programs write and read them.
_QUOTING = {"quote": '"', "escape": '"', "encoding": "UTF-8", "header": True}
# Stands for quoted empty text while a file is read, since the reader takes both for missing.
_EMPTY_TEXT = "\x01"

# Declared type, and the narrower types of a source that lose nothing in it.
_WIDENING = {
    "bigint": ("tinyint", "smallint", "int"),
    "int": ("tinyint", "smallint"),
    "double": ("float", "tinyint", "smallint", "int"),
}


def declared_columns(df: DataFrame, schema: T.StructType, source: str) -> DataFrame:
    """`df` with the columns of `schema` first, in their types, and all other columns after.

    A missing column, or one of another type than declared or a narrower one, raises: imposing
    the schema would silently turn its values into NULL.
    """
    found = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    problems = []
    for field in schema.fields:
        want, have = field.dataType.simpleString(), found.get(field.name)
        if have is None:
            problems.append(f"{field.name} is missing")
        elif have != want and have not in _WIDENING.get(want, ()):
            problems.append(f"{field.name} is {have}, not {want}")
    if problems:
        raise ValueError(f"{source} differs from its declared schema: {', '.join(problems)}")
    own = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(f"`{name}`") for name in df.columns if name not in schema.names]
    return df.select(*own, *extra)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """CSV with a header line: the columns of `schema` in their types, then all others as text.

    Columns are found by name. A missing column raises at once; a line with too few or too many
    fields, and text that does not fit its type, raise when they are read. An empty field is
    NULL and a quoted empty one is empty text (NULL in other types). Blanks around text stay.
    Text with line breaks needs `multi_line`; such a file is read whole by one task.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {**_QUOTING, "emptyValue": _EMPTY_TEXT, "multiLine": multi_line, "mode": "FAILFAST"}
    names = spark.read.options(**options).csv(path).columns
    missing = [name for name in declared.names if name not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    # Every file must have this header; all fields arrive as text.
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = spark.read.schema(text).options(**options, enforceSchema=False).csv(path)
    kinds = {field.name: field.dataType for field in declared.fields}
    order = [*declared.names, *[name for name in names if name not in kinds]]
    return rows.select(*[_typed(name, kinds.get(name, T.StringType())) for name in order])


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(f"`{name}`")
    empty = text == _EMPTY_TEXT
    if isinstance(kind, T.StringType):
        return F.when(empty, F.lit("")).otherwise(text).alias(name)
    value = F.when(empty, F.lit(None)).otherwise(text)
    typed = value.try_cast(kind)
    problem = F.concat(F.lit(f"{name} is not {kind.simpleString()}: "), value)
    return (
        F.when(value.isNotNull() & typed.isNull(), F.raise_error(problem).cast(kind))
        .otherwise(typed)
        .alias(name)
    )


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header line and a fixed column order, in UTF-8, that `read_csv` reads back:
    empty text is quoted, NULL is not, and blanks around text stay."""
    (
        df.select(*columns)
        .write.options(
            **_QUOTING,
            emptyValue='""',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines: the columns of `schema`, then all others as text; a broken line raises.

    One scan finds the names, since JSON has no header. A column that no line has raises.
    """
    inferred = spark.read.options(primitivesAsString=True, mode="FAILFAST").json(path).schema
    found = [name for name in inferred.names if name not in schema.names]
    missing = [name for name in schema.names if name not in inferred.names]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    extra = [T.StructField(name, T.StringType()) for name in found]
    full = T.StructType([*schema.fields, *extra])
    return spark.read.schema(full).option("mode", "FAILFAST").json(path)


def read_places_json(spark: SparkSession, path: str, array: bool = True) -> DataFrame:
    """Nested place records: one array per file as an API returns it, or one per line. A file
    that is cut off or broken raises."""
    options = {"multiLine": array, "mode": "FAILFAST"}
    return spark.read.schema(PLACES_JSON).options(**options).json(path)


def flatten_places(nested: DataFrame) -> DataFrame:
    """One flat row per place, through the immediate region (the other path can be NULL).

    A record without that path yields NULL codes, which the `not_null` check reports.
    """
    return nested.select(
        F.col("id").alias("id_municipio"),
        F.col("nome").alias("nome_municipio"),
        F.col(f"{_STATE}.sigla").alias("sigla_uf"),
        F.col(f"{_STATE}.nome").alias("nome_uf"),
        F.col(f"{_STATE}.id").alias("id_uf"),
        F.col(f"{_STATE}.regiao.sigla").alias("sigla_regiao"),
        F.col(f"{_STATE}.regiao.nome").alias("nome_regiao"),
    )
