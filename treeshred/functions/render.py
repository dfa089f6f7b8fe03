"""Stored value to text and to column types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import values as V

TEXT_LIMIT, HEX_LIMIT = 4000, 8000
PRECISIONS = (250, 500, 1000, 2000, 4000)

# Column type per stored kind in each storage profile.
TEXT_PROFILE = {
    V.INT32: "int", V.INT64: "bigint", V.BIGINT20: "decimal(20,0)", V.BOOL: "boolean",
    V.FLOAT: "double", V.TIME: "timestamp_ntz", V.GUID: "string", V.TEXT: "string",
    V.TEXT8: "string", V.BYTES: "string", V.ARRAY: "string",
}
COMPAT_PROFILE = {**TEXT_PROFILE, V.FLOAT: "float", V.TIME: "string"}
PROFILES = {"text": TEXT_PROFILE, "compat": COMPAT_PROFILE}


def multi_text(texts: Column) -> Column:
    """Repeated values as one text (F16)."""
    return F.concat(F.lit("{ "), F.array_join(texts, ", ", ""), F.lit(" }"))


def clip(kind: Column, text: Column) -> Column:
    """Cut over-long text."""
    limit = F.when(kind == V.BYTES, F.lit(HEX_LIMIT)).otherwise(F.lit(TEXT_LIMIT))
    return F.substring(text, F.lit(1), limit)


def is_clipped(kind: Column, text: Column) -> Column:
    limit = F.when(kind == V.BYTES, F.lit(HEX_LIMIT)).otherwise(F.lit(TEXT_LIMIT))
    return F.length(text) > limit


def text_precision(length: Column) -> Column:
    """Smallest length bucket that holds a text."""
    out = F.lit(PRECISIONS[-1])
    for bucket in reversed(PRECISIONS[:-1]):
        out = F.when(length <= bucket, F.lit(bucket)).otherwise(out)
    return out


def hex_text(raw: Column) -> Column:
    """Bytes as lower-case hex."""
    return F.lower(F.hex(raw))


def to_type(text: Column, kind: str, profile: str = "text") -> Column:
    """Stored text to the column type of its resolved kind."""
    target = PROFILES[profile][kind]
    if target == "string":
        return text
    if target == "boolean":
        return F.when(text == "1", F.lit(True)).when(text == "0", F.lit(False))
    return text.try_cast(target)


def from_type(value: Column, kind: str) -> Column:
    """Typed column back to stored text."""
    if kind == V.BOOL:
        return F.when(value, F.lit("1")).when(~value, F.lit("0"))
    if kind == V.FLOAT:
        return V.plain_double(value.cast("string").cast("double"))
    if kind == V.TIME:
        return V.time_text(value)
    return value.cast("string")
