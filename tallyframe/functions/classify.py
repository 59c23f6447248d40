"""Classes of columns, and the common names of types."""

from __future__ import annotations

from pyspark.sql import types as T

NUMERICAL, CATEGORICAL, DATE, TIME, UNSUPPORTED = "NUMERICAL", "CATEGORICAL", "DATE", "TIME", "UNSUPPORTED"
TIMESTAMP_NTZ, TIMESTAMP_TZ = "TIMESTAMP_WITHOUT_TIME_ZONE", "TIMESTAMP_WITH_TIME_ZONE"

# Type names of other systems by class.
NUMERIC_NAMES = ("smallint", "integer", "bigint", "decimal", "numeric", "real", "double precision", "smallserial", "serial", "bigserial", "money")
TEXT_NAMES = ("character varying", "varchar", "character", "char", "text", "boolean", "uuid", "json", "jsonb", "xml", "bytea", "name", "inet", "cidr", "macaddr", "macaddr8", "bit", "bit varying", "user-defined")

# One name for the spellings of a type.
TYPE_NAMES = {
    "int2": "smallint", "smallint": "smallint", "short": "smallint",
    "int4": "int", "integer": "int", "int": "int",
    "int8": "bigint", "bigint": "bigint", "long": "bigint",
    "float4": "float", "real": "float", "float": "float",
    "float8": "double", "double precision": "double", "double": "double",
    "numeric": "decimal", "decimal": "decimal",
    "bool": "boolean", "boolean": "boolean",
    "varchar": "string", "character varying": "string", "char": "string", "character": "string", "string": "string",
    "timestamp": "timestamp", "timestamp without time zone": "timestamp", "timestamp_ntz": "timestamp",
    "timestamp with time zone": "timestamp", "date": "date", "bytea": "binary", "binary": "binary",
}


def classify(kind: T.DataType) -> str:
    """The class of a Spark type."""
    if isinstance(kind, T.NumericType):
        return NUMERICAL
    if isinstance(kind, T.DateType):
        return DATE
    if isinstance(kind, T.TimestampNTZType):
        return TIMESTAMP_NTZ
    if isinstance(kind, T.TimestampType):
        return TIMESTAMP_TZ
    if isinstance(kind, (T.StringType, T.BooleanType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        return CATEGORICAL
    return UNSUPPORTED


def classify_name(name: str) -> str:
    """The class of a type given by a catalogue's name for it."""
    name = name.lower().split("(")[0].strip()
    if name in NUMERIC_NAMES:
        return NUMERICAL
    if name in TEXT_NAMES or name.startswith(("array", "_")):
        return CATEGORICAL
    if name == "date":
        return DATE
    if name.startswith("timestamp"):
        return TIMESTAMP_TZ if "with time zone" in name or name == "timestamptz" else TIMESTAMP_NTZ
    return TIME if name.startswith("time") else UNSUPPORTED


def type_name(name: str, extra: dict[str, str] | None = None) -> str:
    """The common name of a type; precision and length are ignored, unknown names stay."""
    plain = name.lower().split("(")[0].strip()
    return (extra or {}).get(plain) or TYPE_NAMES.get(plain, plain)


def is_datelike(name: str) -> bool:
    return "date" in name.lower() or "time" in name.lower()


def is_numberlike(name: str) -> bool:
    return type_name(name) in ("smallint", "int", "bigint", "float", "double", "decimal", "tinyint")
