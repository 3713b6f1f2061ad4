"""Expressions over one NDJSON line."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logharbor.functions.paths import endpoint_url
from logharbor.schemas import DEFAULT_TOPIC


def is_blank(line: Column) -> Column:
    return line.rlike(r"(?U)^\s*$")


# Closes a line's array when its text is checked. A line that holds it itself is checked
# a second way.
END_MARK = "\u241c"
#: Bytes above which a line may be too large for the parser that serves all others; it is then read by another.
LARGE_LINE = 16 << 20


def _type_of(doc: Column) -> Column:
    """Text of the top-level ``type`` of a parsed line."""
    text = F.try_variant_get(doc, "$[0].type", "string")
    # Objects and arrays come back as their JSON text; only text like theirs needs a look
    # at the kind of value.
    kind = F.schema_of_variant(F.try_variant_get(doc, "$[0].type", "variant"))
    nested = text.rlike(r"^[{\[]") & kind.rlike("^(OBJECT|ARRAY)")
    return F.when(text.isNull() | nested, "unknown").otherwise(text)


def _type_of_large(line: Column) -> Column:
    """Event type of a line beyond the size that a parsed document may have, null if it is not JSON.

    Read as text alone, a type that begins with a bracket counts as nested.
    """
    single = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    text = F.get_json_object(line, "$.type")
    return F.when(single, F.when(text.isNull() | text.rlike(r"^[{\[]"), "unknown").otherwise(text))


def line_types(line: Column) -> Column:
    """One-element array with the event type of a valid JSON line, empty for other text.

    A JSON reader stops after the first value, so text after it would go unnoticed. The
    line is therefore read as the first element of an array whose second one is a mark:
    only if the mark is found there is the line one whole value.
    """
    mark = F.lit(END_MARK)
    parsed = F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{END_MARK}"]')))
    whole = ~F.contains(line, mark) | F.json_object_keys(
        F.concat(F.lit('{"v":'), line, F.lit("}"))
    ).isNotNull()

    def kind(doc: Column) -> Column:
        marked = F.try_variant_get(doc, "$[1]", "string") == mark
        return F.when(F.coalesce(marked, F.lit(False)) & whole, _type_of(doc))

    # Binding the document in a lambda parses it once for all its uses.
    found = F.transform(F.array(parsed), lambda doc: F.coalesce(kind(doc), F.when(F.octet_length(line) > LARGE_LINE, _type_of_large(line))))
    return F.filter(found, lambda name: name.isNotNull())


def event_type(line: Column) -> Column:
    """Event type of a line; ``unknown`` if it has none, null if it is not JSON."""
    return F.get(line_types(line), F.lit(0))


def is_json(line: Column) -> Column:
    return F.size(line_types(line)) == 1


def envelope(line: Column, kind: Column, sending_time_ms: Column, host: str, ip: str) -> Column:
    return F.struct(
        sending_time_ms.cast("bigint").alias("agentSendingTime"),
        line.alias("data"),
        kind.alias("type"),
        F.lit(host).alias("hostname"),
        F.lit(ip).alias("ipAddr"),
    )


def json_text(value: Column) -> Column:
    """A string as a JSON string literal."""
    wrapped = F.to_json(F.array(value))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def kafka_record(
    line: Column, channel: Column, topic: str = DEFAULT_TOPIC, raw_value: bool = False
) -> list[Column]:
    """Topic, key and value of a line's record; the value is the line as a JSON string."""
    return [
        F.lit(topic).alias("topic"),
        channel.alias("key"),
        (line if raw_value else json_text(line)).alias("value"),
    ]


def http_event(
    wrapped: Column, channel: Column, host: str, topic: str = DEFAULT_TOPIC, version: str | None = None
) -> list[Column]:
    """URL, headers and body of the request that carries one enveloped line."""
    return [
        endpoint_url(host, wrapped["type"], version).alias("url"),
        F.create_map(
            F.lit("Content-Type"), F.lit("application/json"),
            F.lit("X-Topic"), F.lit(topic),
            F.lit("X-Key"), channel,
        ).alias("headers"),
        F.to_json(wrapped).alias("body"),
    ]
