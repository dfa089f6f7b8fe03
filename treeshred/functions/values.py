"""Dictionary-driven value typing as column expressions (2.C, F4, F5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Type tag -> runtime class.
TAG_CLASS = {
    "FT_NONE": "string", "FT_PROTOCOL": "string", "FT_BOOLEAN": "bool",
    "FT_UINT8": "u8", "FT_UINT16": "u16", "FT_UINT24": "u32", "FT_UINT32": "u32",
    "FT_UINT64": "u64", "FT_INT8": "i8", "FT_INT16": "i16", "FT_INT24": "i32",
    "FT_INT32": "i32", "FT_INT64": "i64", "FT_FLOAT": "float", "FT_DOUBLE": "double",
    "FT_ABSOLUTE_TIME": "time", "FT_RELATIVE_TIME": "span", "FT_STRING": "string",
    "FT_STRINGZ": "string", "FT_EBCDIC": "string", "FT_UINT_STRING": "string",
    "FT_ETHER": "string", "FT_BYTES": "bytes", "FT_UINT_BYTES": "bytes", "FT_IPV4": "ip",
    "FT_IPV6": "ip", "FT_IPXNET": "string", "FT_FRAMENUM": "u32", "FT_PCRE": "string",
    "FT_GUID": "guid", "FT_OID": "string", "FT_EUI64": "u64",
}

# Stored kinds.
INT32, INT64, BIGINT20 = "Int32", "Int64", "BigInteger"
BOOL, FLOAT, TIME, GUID = "Boolean", "Float", "DateTime", "Guid"
TEXT, TEXT8, BYTES, ARRAY = "String16", "String8", "Bytes", "Array"

UNSIGNED = ("u8", "u16", "u32", "u64")
SIGNED = ("i8", "i16", "i32", "i64")

MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
TIME_TEXT = r"(?i)^([a-z]{3})\s+(\d{1,2})\s*,\s*(\d{4})\s+(\d{2})\s*:\s*(\d{2})\s*:\s*(\d{2})(?:\.(\d*))?$"
IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$"
IPV6 = (
    r"(?i)^(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?:[0-9a-f]{1,4}:){1,7}:|"
    r"(?:[0-9a-f]{1,4}:){1,6}:[0-9a-f]{1,4}|(?:[0-9a-f]{1,4}:){1,5}(?::[0-9a-f]{1,4}){1,2}|"
    r"(?:[0-9a-f]{1,4}:){1,4}(?::[0-9a-f]{1,4}){1,3}|(?:[0-9a-f]{1,4}:){1,3}(?::[0-9a-f]{1,4}){1,4}|"
    r"(?:[0-9a-f]{1,4}:){1,2}(?::[0-9a-f]{1,4}){1,5}|[0-9a-f]{1,4}:(?::[0-9a-f]{1,4}){1,6}|"
    r":(?:(?::[0-9a-f]{1,4}){1,7}|:))$"
)
GUID_TEXT = (
    r"(?i)^(?:[0-9a-f]{32}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|"
    r"\{[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\}|\([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\))$"
)
UINT64_MAX = "18446744073709551615"


def class_of_tag(tag: Column) -> Column:
    """Runtime class of a type tag, null when the tag is not known."""
    by_class: dict[str, list[str]] = {}
    for name, cls in TAG_CLASS.items():
        by_class.setdefault(cls, []).append(name)
    upper = F.upper(tag)
    out = F.lit(None).cast("string")
    for cls, names in by_class.items():
        out = F.when(upper.isin(names), F.lit(cls)).otherwise(out)
    return out


def hex_digits(c: Column) -> Column:
    """Digits of a hex literal: prefix removed, text from '(' cut; null when not hex."""
    body = F.when(c.startswith("0x") | c.startswith("&"), F.substring(c, 3, 2147483647)).otherwise(c)
    digits = F.rtrim(F.substring_index(body, "(", 1))
    return F.when(digits.rlike("^[0-9a-fA-F]*$"), digits)


def low64(c: Column, signed: bool) -> Column:
    """Low 64 bits of a hex literal as an integer."""
    digits = hex_digits(c)
    digits = F.when(digits == "", F.lit("0")).otherwise(F.right(digits, F.lit(16)))
    return F.when(c != "", F.conv(digits, 16, -10 if signed else 10))


def as_unsigned(c: Column, short: Column | None = None) -> Column:
    """Decimal text to unsigned 64-bit text; ``short`` is the value when it fits 64-bit signed."""
    short = as_signed(c) if short is None else short
    wide = F.when(c.rlike(r"^\s*\+?\d+\s*$"), c).try_cast("decimal(38,0)")
    return (F.when(short >= 0, short.cast("string"))
            .when(F.length(c) > 18, F.when(wide <= F.lit(UINT64_MAX).cast("decimal(20,0)"), wide.cast("string"))))


def as_signed(c: Column) -> Column:
    """Decimal text to a 64-bit integer. The pattern guards the cast: a failing try_cast is slow."""
    return F.when(c.rlike(r"^\s*[+-]?\d{1,19}\s*$"), c).try_cast("bigint")


def as_literal(c: Column) -> Column:
    """64-bit integer literal, decimal or prefixed by 0x / &h."""
    text = F.trim(c)
    digits = F.regexp_extract(text, r"(?i)^(?:0x|&h)([0-9a-f]{1,16})$", 1)
    return F.when(digits != "", F.conv(digits, 16, -10).try_cast("bigint")).otherwise(as_signed(text))


def as_double(c: Column) -> Column:
    """Double from text; text that overflows the range is not a number."""
    # Plain digits can't overflow and are parsed once.
    plain = c.rlike(r"^[+-]?\d+(?:\.\d*)?$") & (F.length(c) < 300)
    grouped = F.when(c.rlike(r"^\s*[+-]?(?:\d[\d,]*\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"),
                     F.replace(c, F.lit(","), F.lit("")))
    special = F.trim(c).isin("NaN", "Infinity", "-Infinity")
    number = F.when(special, F.trim(c)).otherwise(grouped).try_cast("double")
    return F.when(plain, c.try_cast("double")).when((F.abs(number) < F.lit(float("inf"))) | special, number)


def as_float(c: Column) -> Column:
    wide = as_double(c)
    return F.when((F.abs(wide) <= 3.4028234663852886e38) | F.isnan(wide) | (F.abs(wide) == float("inf")),
                  wide.cast("float"))


def as_time(c: Column, capture_tz: str = "UTC") -> Column:
    """Capture time text to a UTC wall-clock timestamp, fraction cut to microseconds."""
    month = F.instr(F.lit(MONTHS), F.upper(F.substring(c, 1, 3)))
    number = ((month + 2) / 3).cast("int").cast("string")
    iso = F.replace(F.regexp_replace(c, TIME_TEXT, "$3-@-$2 $4:$5:$6.$7"), F.lit("@"), number)
    local = F.when(month % 3 == 1, iso).try_cast("timestamp_ntz")
    if capture_tz == "UTC":
        return local
    return F.convert_timezone(F.lit(capture_tz), F.lit("UTC"), local)


def ip_from_hex(c: Column) -> Column:
    """Address text from 4 or 16 raw bytes in hex."""
    digits = F.lower(hex_digits(c))
    quad = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(3)),
                    lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10)), ".")
    groups = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(7)),
                    lambda i: F.lower(F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 16))), ":")
    return F.when(F.length(digits) == 8, quad).when(F.length(digits) == 32, compress_ipv6(groups))


def compress_ipv6(groups: Column) -> Column:
    """Write the longest run of two or more zero groups as '::', the first one on a tie."""
    out = groups
    for n in range(2, 9):
        run = rf"(?:^|:)0(?::0){{{n - 1}}}(?:$|:)"
        out = F.when(groups.rlike(run), F.regexp_replace(groups, rf"^(.*?){run}", "$1::")).otherwise(out)
    return out


def as_ip(show: Column, value: Column) -> Column:
    text = F.when(show.rlike(IPV4), F.regexp_replace(show, r"(^|\.)0+(?=\d)", "$1"))
    text = text.when(show.rlike(IPV6), F.lower(show))
    return F.coalesce(text, ip_from_hex(value))


def as_guid(c: Column) -> Column:
    text = F.trim(c)
    digits = F.regexp_replace(F.lower(text), "[^0-9a-f]", "")
    dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(text.rlike(GUID_TEXT), dashed)


def unsigned_kind(v: Column) -> Column:
    """Stored kind by magnitude: 16-bit values fit Int32, 32-bit fit Int64."""
    return (F.when(v <= 65535, F.lit(INT32)).when(v <= 4294967295, F.lit(INT64))
            .otherwise(F.lit(BIGINT20)))


def signed_kind(v: Column) -> Column:
    return F.when(v.between(-2147483648, 2147483647), F.lit(INT32)).otherwise(F.lit(INT64))


def fallback_text(name: Column, show: Column, value: Column) -> Column:
    """Text kept when a value has no definition or does not parse."""
    named_by_show = value.isNotNull() & F.contains(F.lower(name), F.lower(show))
    return F.when(show.isNull() | named_by_show, value).otherwise(show)


def plain_double(v: Column) -> Column:
    """Shortest digits, without exponent where that stays readable."""
    text, size = v.cast("string"), F.abs(v)
    fixed = F.regexp_replace(v.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    whole = v.try_cast("bigint")
    # Between 0.001 and ten million the digits come without exponent.
    return (F.when(v == 0, F.lit("0"))
            .when((size < 1e7) & (whole.cast("double") == v), whole.cast("string"))
            .when((size >= 1e-3) & (size < 1e7), text)
            .when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2))
            .when((size >= 1e-5) & (size < 1e15) & text.contains("E"), fixed)
            .otherwise(text))


def time_text(v: Column) -> Column:
    """Sortable time text without trailing fraction zeros."""
    return v.cast("string")


def parsed_numbers(cls: Column, base: Column, show: Column) -> dict[str, Column]:
    """Numbers that several expressions need, so that each text is parsed once: ``_i`` and ``_d``."""
    decimal = ~F.coalesce(base.startswith("BASE_HEX") | (base == "BASE_NONE"), F.lit(False))
    return {
        "_i": F.when(cls.isin(*UNSIGNED, *SIGNED) & decimal, as_signed(show)),
        "_d": F.when(cls.isin("double", "span"), as_double(show))
        .when(cls == "float", as_float(show).cast("string").cast("double")),
    }


def typed_text(cls: Column, base: Column, show: Column, value: Column, i: Column, d: Column,
               capture_tz: str = "UTC") -> Column:
    """Canonical text of a value under its dictionary class; null when it does not parse."""
    base = F.coalesce(base, F.lit("BASE_DEC"))
    is_hex = base.startswith("BASE_HEX")
    unsigned, signed = cls.isin(*UNSIGNED), cls.isin(*SIGNED)
    raw = F.lower(F.hex(F.try_to_binary(hex_digits(value), F.lit("hex"))))
    return (
        F.when((cls == "string") | ((base == "BASE_NONE") & (unsigned | signed)) | (cls == "bool"), show)
        .when(unsigned & is_hex, low64(show, False))
        .when(unsigned, as_unsigned(show, i))
        .when(signed & is_hex, low64(show, True))
        .when(signed, i.cast("string"))
        .when(cls.isin("float", "double", "span"), plain_double(d))
        .when(cls == "time", time_text(as_time(show, capture_tz)))
        .when(cls == "bytes", F.when(value.isNull(), F.lit("")).otherwise(raw))
        .when(cls == "ip", as_ip(show, value))
        .when(cls == "guid", as_guid(show))
    )


def typed_kind(cls: Column, base: Column, text: Column) -> Column:
    """Stored kind of a canonical text (F4); text stays text when it did not parse."""
    base = F.coalesce(base, F.lit("BASE_DEC"))
    number = base != "BASE_NONE"
    return (
        F.when(text.isNull() | cls.isNull() | (cls == "string"), F.lit(TEXT))
        .when(cls == "bool", F.when(text.isin("0", "1"), F.lit(BOOL)).otherwise(F.lit(TEXT)))
        .when(cls == "bytes", F.lit(BYTES))
        .when(cls.isin(*UNSIGNED) & number & (F.length(text) <= 18), unsigned_kind(text.try_cast("bigint")))
        .when(cls.isin(*UNSIGNED) & number, unsigned_kind(text.try_cast("decimal(20,0)")))
        .when(cls.isin(*SIGNED) & number, signed_kind(text.try_cast("bigint")))
        .when(cls.isin("float", "double", "span"), F.lit(FLOAT))
        .when(cls == "time", F.lit(TIME))
        .when(cls == "ip", F.lit(TEXT8))
        .when(cls == "guid", F.lit(GUID))
        .otherwise(F.lit(TEXT))
    )
