"""Typed metadata values: construction, JSON in and out, and the per-key merge."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.schema import METADATA, VALUE

INT64_MIN, INT64_MAX = -(2**63), 2**63 - 1


# ---------------------------------------------------------------------------- Python values


def iso_text(value: dt.datetime) -> str:
    """ISO-8601 with seven fractional digits. UTC ends in Z, other zones in their offset."""
    text = value.strftime("%Y-%m-%dT%H:%M:%S.") + f"{value.microsecond:06d}0"
    if value.tzinfo is None:
        return text
    if value.tzinfo is dt.timezone.utc:
        return text + "Z"
    offset = value.strftime("%z")
    return f"{text}{offset[:3]}:{offset[3:5]}"


def primitive(value: Any) -> tuple[str, Any] | None:
    """(type tag, plain value) of a primitive, None if `value` is not one. NumPy scalars count as what they hold."""
    if isinstance(value, np.generic) and not isinstance(value, (np.datetime64, np.timedelta64)):
        value = value.item()
    if isinstance(value, bool):
        return "b", value
    if isinstance(value, str):
        return "s", value
    if isinstance(value, int):
        return ("i", value) if INT64_MIN <= value <= INT64_MAX else ("d", float(value))
    if isinstance(value, (float, Decimal)):
        return "d", float(value)
    if isinstance(value, dt.datetime):
        return "s", iso_text(value)
    if isinstance(value, dt.date):
        return "s", iso_text(dt.datetime.combine(value, dt.time()))
    if isinstance(value, uuid.UUID):
        return "s", str(value)
    return None


def pack(value: Any) -> dict[str, Any]:
    """A Python metadata value as a row of the value struct. Non-primitives become JSON text."""
    row: dict[str, Any] = dict.fromkeys(VALUE.fieldNames())
    if value is None:
        row["t"] = "n"
        return row
    tag, plain = primitive(value) or ("s", json.dumps(value, separators=(",", ":"), default=str))
    row["t"] = tag
    row[tag] = plain
    return row


def pack_all(metadata: Mapping[str, Any] | None) -> dict[str, dict[str, Any]] | None:
    return None if metadata is None else {k: pack(v) for k, v in metadata.items()}


def unpack_all(metadata: Mapping[str, Any] | None) -> dict[str, Any]:
    """A collected metadata map as plain Python values. Null gives an empty dict."""
    return {k: None if v["t"] == "n" else v[v["t"]] for k, v in (metadata or {}).items()}


# ---------------------------------------------------------------------------- Spark columns


def _slot(tag: str, value: Column) -> Column:
    """The value struct with one slot filled, or null where `value` is null."""
    slots = [
        (value if f == tag else F.lit(None)).cast(VALUE[f].dataType).alias(f)
        for f in VALUE.fieldNames()
        if f != "t"
    ]
    return F.when(value.isNotNull(), F.struct(F.lit(tag).alias("t"), *slots))


def iso_column(ts: Column) -> Column:
    """Timestamp to ISO-8601 text in UTC with seven fractional digits, whatever the session time zone."""
    micros = F.unix_micros(ts.cast("timestamp"))
    rest = F.pmod(micros, F.lit(86_400_000_000))
    days = ((micros - rest) / 86_400_000_000).cast("int")
    seconds = (rest.cast("decimal(14,0)") / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    # As text from a time without zone: formatting a moment would go through the session's zone and its gaps.
    utc = (F.to_timestamp_ntz(F.lit("1970-01-01")) + F.make_dt_interval(days, zero, zero, seconds)).cast("string")
    part = F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(F.substring(utc, 1, 10), F.lit("T"), F.substring(utc, 12, 8), F.lit("."), part, F.lit("0Z"))


def value_column(value: Column, dtype: T.DataType) -> Column:
    """A column of type `dtype` as a typed metadata value (null stays null)."""
    if isinstance(dtype, T.BooleanType):
        return _slot("b", value)
    if isinstance(dtype, T.StringType):
        return _slot("s", value)
    if isinstance(dtype, T.IntegralType):
        return _slot("i", value.cast("bigint"))
    if isinstance(dtype, T.FloatType):
        return _slot("d", value.cast("string").cast("double"))  # the same number, not the same bits
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return _slot("d", value.cast("double"))
    if isinstance(dtype, T.TimestampType):
        return _slot("s", iso_column(value))
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return _slot("s", F.date_format(value.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'"))
    return _slot("s", F.to_json(value))


def metadata_column(schema: T.StructType, names: Iterable[str]) -> Column:
    """Metadata map of the named columns; a null column leaves its key out."""
    pairs: list[Column] = []
    for name in names:
        pairs += [F.lit(name), value_column(F.col(name), schema[name].dataType)]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).cast(METADATA)


def typed_slot(value: Column, dtype: T.DataType) -> Column:
    """The content of a value struct as a plain column of type `dtype`; null on another type or beyond its range."""
    if isinstance(dtype, T.BooleanType):
        return value["b"]
    if isinstance(dtype, T.StringType):
        return value["s"]
    if isinstance(dtype, T.IntegralType):
        return value["i"].try_cast(dtype)
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return F.coalesce(value["d"], value["i"].cast("double")).try_cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value["s"].try_cast(dtype)
    return F.lit(None).cast(dtype)


def from_json_text(text: Column, mode: str = "permissive") -> Column:
    """A JSON object text as a metadata map.

    Permissive: null, empty, broken and non-object text gives an empty map. Failfast: broken and
    non-object text raises, null and empty text gives null.
    Numbers are bigint where they fit and double otherwise; nested values stay JSON text.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    as_map = "map<string,variant>"
    if mode == "failfast":
        raw = F.parse_json(F.when(F.trim(text) != "", text)).cast(as_map)
    else:
        raw = F.try_parse_json(text).try_cast(as_map)

    def convert(_: Column, v: Column) -> Column:
        kind = F.schema_of_variant(v)
        null = F.lit(None)

        def struct(tag: Column, s: Column, i: Column, d: Column, b: Column) -> Column:
            return F.struct(
                tag.alias("t"),
                s.cast("string").alias("s"),
                i.cast("bigint").alias("i"),
                d.cast("double").alias("d"),
                b.cast("boolean").alias("b"),
            )

        is_int = kind == "BIGINT"
        is_num = (kind == "DOUBLE") | kind.startswith("DECIMAL")
        is_bool = kind == "BOOLEAN"
        is_null = v.isNull() | (kind == "VOID")
        is_text = ~(is_int | is_num | is_bool | is_null)
        tag = (
            F.when(is_null, "n").when(is_int, "i").when(is_num, "d").when(is_bool, "b").otherwise("s")
        )
        return struct(
            tag,
            F.when(is_text, v.try_cast("string")).otherwise(null),
            F.when(is_int, v.try_cast("bigint")).otherwise(null),
            F.when(is_num, v.try_cast("double")).otherwise(null),
            F.when(is_bool, v.try_cast("boolean")).otherwise(null),
        )

    typed = F.transform_values(raw, convert)
    return F.coalesce(typed, F.create_map().cast(METADATA)) if mode == "permissive" else typed


def to_json_text(metadata: Column) -> Column:
    """A metadata map as JSON object text; a null map stays null."""

    def variant(_: Column, v: Column) -> Column:
        return (
            F.when(v["t"] == "s", v["s"].cast("variant"))
            .when(v["t"] == "i", v["i"].cast("variant"))
            .when(v["t"] == "d", v["d"].cast("variant"))
            .when(v["t"] == "b", v["b"].cast("variant"))
        )

    return F.to_json(F.transform_values(metadata, variant), {"ignoreNullFields": "false"})


def drop_nulls(metadata: Column) -> Column:
    """Leave out keys whose value is an explicit null."""
    return F.map_filter(metadata, lambda k, v: v["t"] != "n")


def merge(old: Column, new: Column) -> Column:
    """Per-key merge: new keys win, other keys stay, an explicit null removes its key."""
    base = F.coalesce(old, F.create_map().cast(METADATA))
    merged = drop_nulls(F.map_zip_with(base, new, lambda k, o, n: F.coalesce(n, o)))
    return F.when(new.isNull(), old).otherwise(merged)
