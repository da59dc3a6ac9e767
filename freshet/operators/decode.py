"""Decoding and validation of JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshet.functions.text import strip_blanks
from freshet.functions.json_text import is_json, json_kind, lenient_object, parse_whole, unwrap_once

# The document message and the fields read from it.
MESSAGE_SCHEMA = "doc_id string, source string, text string, meta struct<project: string, user: string, ts: string>"

# The declared raw event and the JSON types each field may have.
DECLARED_FIELDS = {
    "type": "string",
    "event": "string",
    "title": "string",
    "user": "string",
    "timestamp": "integer",
}


def decode(df: DataFrame, schema: str | StructType, value: str = "value") -> DataFrame:
    """Typed fields next to the untouched text; text that is not JSON gives null fields."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, parsed.alias("_data"), F.col(value).cast("string").alias("raw_json")).select(
        *rest, "_data.*", "raw_json"
    )


def flatten_message(df: DataFrame) -> DataFrame:
    """The seven text columns that the table sink stores."""
    return df.select(
        "doc_id",
        "source",
        "text",
        F.col("meta.project").alias("project"),
        F.col("meta.user").alias("username"),
        F.col("meta.ts").alias("event_ts"),
        "raw_json",
    )


def with_values(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns as the output of a generator of one row.

    A filter on an ordinary column is evaluated below the projection that
    defines it, by repeating its whole definition. On these columns it reads
    the value, so costly parsing happens once.
    """
    return df.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def decode_double(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``body`` (object text, else null) and ``reason`` for messages that may be encoded twice.

    Every step is its own projection, so the text is unwrapped and parsed once.
    """
    steps = df.withColumn("_text", unwrap_once(value)).withColumn("_kind", json_kind("_text"))
    reason = (
        F.when(F.col(value).isNull(), "tombstone")
        .when((strip_blanks(value) == "") | (F.col("_text") == ""), "empty")
        .when(F.col("_kind").isNull(), "malformed")
        .when(~F.startswith("_kind", F.lit("OBJECT")), "not_an_object")
    )
    readable = F.startswith("_kind", F.lit("OBJECT"))
    return with_values(steps, reason=reason, body=F.when(readable, F.col("_text"))).drop("_text", "_kind")


def classify(df: DataFrame, value: str = "value", field: str = "content") -> DataFrame:
    """One pass over the messages: ``body``, ``reason`` and ``result`` (ok, skipped or error).

    The required content must be a non-empty JSON string.
    """
    decoded = decode_double(df, value)
    steps = decoded.withColumn(
        "_field", F.try_variant_get(F.try_parse_json("body"), f"$.{field}", "variant")
    ).withColumns({"_kind": F.schema_of_variant("_field"), "_blank": F.try_variant_get("_field", "$", "string") == ""})
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("_kind").isNull() | (F.col("_kind") == "VOID"), "content_missing")
        .when(F.col("_kind") != "STRING", "content_not_text")
        .when(F.col("_blank"), "content_empty")
    )
    named = steps.withColumn("reason", reason).withColumn(
        "result",
        F.when(F.col("reason").isNull(), "ok").when(F.col("reason") == "tombstone", "skipped").otherwise("error"),
    )
    rest = [c for c in named.columns if c not in ("reason", "result", "_field", "_kind", "_blank")]
    return with_values(named.select(*rest, F.col("reason").alias("_r"), F.col("result").alias("_s")), reason=F.col("_r"), result=F.col("_s")).drop(
        "_r", "_s"
    )


def split_valid(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Readable messages and the quarantine with its reasons; tombstones are in neither."""
    marked = classify(df, value)
    valid = marked.where(F.col("result") == "ok").drop("reason", "result")
    quarantine = marked.where(F.col("result") == "error").drop("result", "body")
    return valid, quarantine


def lenient(df: DataFrame, value: str = "value", out: str = "body") -> DataFrame:
    return df.withColumn(out, lenient_object(value))


def drop_malformed(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(is_json(value))


def type_violations(df: DataFrame, value: str = "value", fields: Mapping[str, str] = DECLARED_FIELDS) -> DataFrame:
    """Adds ``violations``: declared fields that hold another JSON type. Null and absent are allowed."""
    kinds = df.withColumn("_v", parse_whole(value)).withColumns(
        {f"_kind_{n}": F.schema_of_variant(F.try_variant_get("_v", f"$.{n}", "variant")) for n in fields}
    )
    checks = []
    for name, wanted in fields.items():
        kind = F.col(f"_kind_{name}")
        fits = kind == ("BIGINT" if wanted == "integer" else "STRING")
        checks.append(F.when(kind.isNotNull() & (kind != "VOID") & ~fits, F.lit(name)))
    return kinds.withColumn("violations", F.array_compact(F.array(*checks))).drop("_v", *[f"_kind_{n}" for n in fields])
