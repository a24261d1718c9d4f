"""Source types to sink types, and the text forms in which values travel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of a source type's lower-case text that decide the sink type; the first that fits counts.
TYPE_RULES = [
    ("bool", "BOOLEAN"),
    ("int", "INT64"),
    ("numeric", "DECIMAL"),
    ("decimal", "DECIMAL"),
    ("float", "FLOAT64"),
    ("double", "FLOAT64"),
    ("real", "FLOAT64"),
    ("timestamp", "TIMESTAMP"),
    ("date", "DATE"),
    ("json", "VARIANT"),
    ("variant", "VARIANT"),
    ("bytea", "BINARY"),
    ("blob", "BINARY"),
]
# Type numbers that stand for a type.
TYPE_NUMBERS = {"16": "BOOLEAN", "20": "INT64", "23": "INT64", "25": "STRING", "1043": "STRING", "1114": "TIMESTAMP", "1184": "TIMESTAMP", "3802": "VARIANT"}
#: Types whose names contain "int" without being integers; strict mapping sends them to STRING.
NOT_INTEGERS = ("interval", "point", "int4range", "int8range")

SPARK_TYPES = {"BOOLEAN": "boolean", "INT64": "bigint", "FLOAT64": "double", "TIMESTAMP": "timestamp", "DATE": "date", "VARIANT": "variant", "BINARY": "binary", "STRING": "string"}


def decimal_type(precision: int = 38, scale: int = 9) -> str:
    """DECIMAL with the scale held at or below the precision; a scale of zero isn't printed."""
    scale = min(scale, precision)
    return f"DECIMAL({precision})" if scale == 0 else f"DECIMAL({precision},{scale})"


def sink_type(source: Column, precision: int = 38, scale: int = 9, by_substring: bool = False) -> Column:
    """Sink type of a source type's text. by_substring: take every type with "int" in its name for an integer."""
    low = F.lower(F.trim(source))
    out = F.when(low.endswith("[]") | low.startswith("_") | low.contains("array"), F.lit("VARIANT"))
    if not by_substring:
        out = out.when(low.isin(*NOT_INTEGERS), F.lit("STRING"))
    for part, kind in TYPE_RULES:
        out = out.when(low.contains(part), F.lit(decimal_type(precision, scale) if kind == "DECIMAL" else kind))
    for number, kind in TYPE_NUMBERS.items():
        out = out.when(low == number, F.lit(kind))
    return F.coalesce(out, F.lit("STRING"))


def spark_type(kind: str) -> str:
    """Spark's name of a sink type."""
    return kind.lower() if kind.startswith("DECIMAL") else SPARK_TYPES[kind]


def typed(value: Column, kind: str) -> Column:
    """A transported text as a value of a Spark type; texts that don't fit are null, decimals stay exact."""
    if kind == "string":
        return value
    if kind == "variant":
        return F.try_parse_json(value)
    if kind == "binary":
        return F.unbase64(value)
    return value.try_cast(kind)


def wire_text(column: Column, kind: str) -> Column:
    """The text in which a value of a Spark type travels."""
    if kind.startswith(("array", "map", "struct", "variant")):
        return F.to_json(column)
    if kind == "binary":
        return F.base64(column)
    return column.cast("string")


# Kinds named beside travelling values, by Spark type; nested types travel as json.
WIRE_KINDS = {
    "boolean": "bool", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "double": "double", "float": "double",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "date", "string": "string", "binary": "string",
}


def wire_kind(kind: str) -> str:
    """The kind named beside a travelling value of a Spark type."""
    return "decimal" if kind.startswith("decimal") else WIRE_KINDS.get(kind, "json")


def uuid_text(raw: Column) -> Column:
    """16 bytes as uuid text; other lengths in base64."""
    h = F.lower(F.hex(raw))
    dashed = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(F.octet_length(raw) == 16, dashed).otherwise(F.base64(raw))


def json_or_text(value: Column) -> Column:
    """Parsed JSON; text that isn't JSON becomes a JSON string."""
    wrapped = F.variant_get(F.try_parse_json(F.to_json(F.struct(value.alias("v")))), "$.v", "variant")
    return F.coalesce(F.try_parse_json(value), wrapped)


def plain_value(value):
    """A nested value in the forms that travel as JSON: numbers, texts, truth values, lists and maps of them."""
    import datetime
    import decimal
    import uuid

    if isinstance(value, dict):
        return {str(k): plain_value(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain_value(v) for v in value]
    if isinstance(value, bytes):
        import base64

        return base64.b64encode(value).decode()
    if isinstance(value, datetime.datetime):
        utc = value.astimezone(datetime.UTC).replace(tzinfo=None) if value.tzinfo else value
        return utc.isoformat() + "Z"
    if isinstance(value, (datetime.date, decimal.Decimal, uuid.UUID)):
        return str(value)
    return value


def normalised(column: Column, kind: str) -> Column:
    """A value of any Spark type with all that is in it in the text form in which it travels; arrays and structs keep their shape."""
    from pyspark.sql.types import ArrayType, MapType, StructType, _parse_datatype_string

    def walk(c: Column, t) -> Column:
        if isinstance(t, ArrayType):
            return F.transform(c, lambda x: walk(x, t.elementType))
        if isinstance(t, MapType):
            return F.transform_values(c, lambda _, v: walk(v, t.valueType))
        if isinstance(t, StructType):
            inside = F.struct(*[walk(c[f.name], f.dataType).alias(f.name) for f in t.fields])
            return F.when(c.isNotNull(), inside)
        return wire_text(c, t.simpleString())

    return walk(column, _parse_datatype_string(kind))
