"""Strict JSON schemas of row types, for services that must answer in them."""

from __future__ import annotations

from pyspark.sql import types as T

_NAMES = {T.StringType: "string", T.BooleanType: "boolean", T.IntegerType: "integer", T.LongType: "integer", T.ShortType: "integer", T.DoubleType: "number", T.FloatType: "number", T.DecimalType: "number"}


def nullable(schema: dict) -> dict:
    """The schema, or null in its place."""
    return {"anyOf": [schema, {"type": "null"}]}


def strict_schema(kind: T.DataType) -> dict:
    """The JSON schema of a type: every field of a struct is required, none may be added, nullable ones may be null."""
    if isinstance(kind, T.StructType):
        fields = {f.name: nullable(strict_schema(f.dataType)) if f.nullable else strict_schema(f.dataType) for f in kind}
        return {"type": "object", "properties": fields, "required": list(fields), "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        inner = strict_schema(kind.elementType)
        return {"type": "array", "items": nullable(inner) if kind.containsNull else inner}
    if type(kind) not in _NAMES:
        raise TypeError(f"{kind.simpleString()} has no JSON schema")
    return {"type": _NAMES[type(kind)]}
