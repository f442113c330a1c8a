"""Type categories, common names and the class of a type change."""

from __future__ import annotations

from pyspark.sql import types as T

INTEGER, DECIMAL, FLOATING, TEXT, BOOL, DATE, TIMESTAMP, BINARY, VOID, NESTED = "integer decimal floating text bool date timestamp binary void nested".split()

_BY_TYPE = [
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), INTEGER),
    ((T.DecimalType,), DECIMAL),
    ((T.FloatType, T.DoubleType), FLOATING),
    ((T.StringType, T.CharType, T.VarcharType), TEXT),
    ((T.BooleanType,), BOOL),
    ((T.DateType,), DATE),
    ((T.TimestampType, T.TimestampNTZType), TIMESTAMP),
    ((T.BinaryType,), BINARY),
    ((T.NullType,), VOID),
]

NUMERIC = (INTEGER, DECIMAL, FLOATING)


def category(kind: T.DataType) -> str:
    """The category that decides how a column is canonicalised and profiled; unknown types count as nested."""
    return next((name for kinds, name in _BY_TYPE if isinstance(kind, kinds)), NESTED)


#: Common names of database types, for schemas that come as text.
COMMON = {
    "tinyint": "tinyint", "smallint": "smallint", "int2": "smallint", "integer": "int", "int": "int", "int4": "int", "bigint": "bigint", "int8": "bigint",
    "utinyint": "smallint", "usmallint": "int", "uinteger": "bigint", "ubigint": "decimal(20,0)", "hugeint": "decimal(38,0)", "numeric": "decimal(38,18)",
    "real": "float", "float4": "float", "float": "float", "double": "double", "double precision": "double", "float8": "double", "boolean": "boolean", "bool": "boolean",
    "text": "string", "varchar": "string", "character varying": "string", "character": "string", "char": "string", "uuid": "string", "time": "string",
    "time without time zone": "string", "json": "string", "jsonb": "string", "string": "string", "date": "date", "bytea": "binary", "blob": "binary",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamp", "timestamptz": "timestamp",
    "interval": "interval", "null": "void",
}


def common_type(name: str) -> str:
    """A database's type name in common terms; sized names keep their sizes, unknown ones become string."""
    low = name.strip().lower()
    head, paren, tail = low.partition("(")
    head = head.strip()
    if head in ("decimal", "numeric") and paren:
        return "decimal(" + tail.replace(" ", "")
    if low.endswith("[]") or head in ("struct", "map", "array", "list"):
        return "nested"
    return COMMON.get(head, "string")


#: Changes of declared type that keep every value.
WIDENING = frozenset({
    ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("int", "decimal"), ("bigint", "decimal"), ("int", "double"), ("bigint", "double"),
    ("float", "double"), ("float", "decimal"), ("double", "decimal"), ("date", "timestamp"),
})


def change_class(source: str, target: str) -> str:
    """How a column's type changed: SAME, TEXT_EQUIVALENT, WIDENING, PRECISION or INCOMPATIBLE."""
    if source.strip().lower() == target.strip().lower():
        return "SAME"
    a, b = (common_type(x).partition("(")[0] for x in (source, target))
    if a == b == "string":
        return "TEXT_EQUIVALENT"
    if (a, b) in WIDENING:
        return "WIDENING"
    return "PRECISION" if a == b else "INCOMPATIBLE"
