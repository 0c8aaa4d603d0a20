"""Events as JSON messages: encoding, decoding and coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.sources.ledger import INGESTED_AT, SOURCE_FILE

VALUE = "value"
MESSAGE = "_message"
REASON = "_bad_reason"

_PARSED = "_parsed"


def as_events(rows: DataFrame) -> DataFrame:
    """One JSON message per row, in the column `value`."""
    return rows.select(F.to_json(F.struct("*")).alias(VALUE))


def replay(rows: DataFrame, limit: int) -> DataFrame:
    """A bounded sample of a table as messages; which rows is up to the scan order."""
    return as_events(rows.limit(limit))


def write_events(messages: DataFrame, format: str, location: str, **options: str) -> None:
    """Send messages to a Kafka topic, or append them to a folder as one line each."""
    writer = messages.select(VALUE).write.format(format).mode("append").options(**options)
    if format == "kafka":
        writer.option("topic", location).save()
    else:
        writer.save(location)


def encode_base64(events: DataFrame) -> DataFrame:
    return events.select(F.base64(F.encode(VALUE, "UTF-8")).alias(VALUE))


def decode_base64(events: DataFrame) -> DataFrame:
    """Unwrapped messages; one that is no Base64 of UTF-8 text stays as it came."""
    text = F.try_to_binary(F.col(VALUE).cast("string"), F.lit("base64")).cast("string")
    return events.withColumn(VALUE, F.coalesce(F.try_validate_utf8(text), F.col(VALUE)))


def decode(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` from the JSON text in `value`, plus the message and a bad reason.

    Empty text and missing fields give NULL. Numbers may arrive as text; text that is no
    number, or a message that is no JSON object, sets the reason and is never dropped.
    Fields outside `schema` are left out of the columns; of a repeated field the last value
    counts (this sets `spark.sql.variant.allowDuplicateKeys` in the session).
    """
    events.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.col(VALUE).cast("string")
    # As the only element of an array, a message with text after its end is no valid JSON.
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    parsed = events.select(
        text.alias(MESSAGE),
        F.when(alone, F.try_variant_get(wrapped, "$[0]", "variant")).alias(_PARSED),
    )
    # Valid JSON is an object exactly if its first character is a brace.
    starts = F.ltrim(F.col(MESSAGE), F.lit(" \t\r\n")).startswith("{")
    is_object = F.col(_PARSED).isNotNull() & F.coalesce(starts, F.lit(False))
    bad = [(F.lit("not a JSON object"), ~is_object)]
    columns: list[Column] = []
    for column in schema.fields:
        kind = column.dataType.simpleString()
        value = _field(column.name, kind)
        columns.append(value.alias(column.name))
        if kind != "string":
            unread = value.isNull() & (_field(column.name, "string") != "")
            bad.append((F.lit(f"{column.name} is not {kind}"), unread))
    reason = F.coalesce(*[F.when(failed, explanation) for explanation, failed in bad])
    # A plain projection would be repeated inside every filter on the reason. Filters do not
    # move below a generator, so each message is parsed once.
    return parsed.select(F.inline(F.array(F.struct(*columns, MESSAGE, reason.alias(REASON)))))


def arrive(decoded: DataFrame, source: str) -> DataFrame:
    """Stamp the arrival time (one instant per micro-batch) and the source."""
    return decoded.withColumns({INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.lit(source)})


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNull()).drop(MESSAGE, REASON)


def bad(decoded: DataFrame) -> DataFrame:
    """Rejected messages as they came, with the reason."""
    meta = [c for c in (INGESTED_AT, SOURCE_FILE) if c in decoded.columns]
    return decoded.where(F.col(REASON).isNotNull()).select(MESSAGE, REASON, *meta)


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return good(decoded), bad(decoded)


def _field(name: str, kind: str) -> Column:
    return F.try_variant_get(_PARSED, f"$['{name}']", kind)
