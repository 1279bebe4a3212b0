"""Payload schemas declared as Avro JSON text, as Spark types and back.

A union with null is a nullable type. Unions of int and long, or of float and double, are the wider of
the two; any other union is a struct with one field for each branch. Names refer to types declared
before them; a type that holds itself has no Spark type and is refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import types as T

# Names of Avro types, and of logical types on them.
PRIMITIVES: dict[str, T.DataType] = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
LOGICAL: dict[tuple[str, str], T.DataType] = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}
# How a Spark type is declared; decimals, nested types and smaller integers are not in the list.
DECLARED: list[tuple[type[T.DataType], Any]] = [
    (T.NullType, "null"),
    (T.BooleanType, "boolean"),
    (T.ByteType, "int"),
    (T.ShortType, "int"),
    (T.IntegerType, "int"),
    (T.LongType, "long"),
    (T.FloatType, "float"),
    (T.DoubleType, "double"),
    (T.BinaryType, "bytes"),
    (T.StringType, "string"),
    (T.DateType, {"type": "int", "logicalType": "date"}),
    (T.TimestampType, {"type": "long", "logicalType": "timestamp-micros"}),
    (T.TimestampNTZType, {"type": "long", "logicalType": "local-timestamp-micros"}),
]
WIDER = [({"int", "long"}, T.LongType()), ({"float", "double"}, T.DoubleType())]

Typed = tuple[T.DataType, bool]


class _Reader:
    """Types of one declaration. ``named`` holds those that names may refer to; None while they are open."""

    def __init__(self) -> None:
        self.named: dict[str, Typed | None] = {}

    def of(self, declared: Any, space: str) -> Typed:
        """The Spark type, and whether it may be null."""
        if isinstance(declared, list):
            return self.union(declared, space)
        if isinstance(declared, str):
            return self.by_name(declared, space)
        if not isinstance(declared, dict) or "type" not in declared:
            raise ValueError(f"Not an Avro type: {declared!r}")
        kind = declared["type"]
        nested: dict[str, Callable[[dict, str], Typed]] = {
            "record": self.record, "error": self.record, "enum": self.named_plain, "fixed": self.named_plain,
            "array": self.array, "map": self.map,
        }
        if isinstance(kind, str) and kind in nested:
            return nested[kind](declared, space)
        if declared.get("logicalType") == "decimal" and kind == "bytes":
            return self.decimal(declared), False
        if isinstance(kind, str) and (kind, declared.get("logicalType")) in LOGICAL:
            return LOGICAL[kind, declared["logicalType"]], False
        return self.of(kind, space)

    def by_name(self, name: str, space: str) -> Typed:
        if name in PRIMITIVES:
            return PRIMITIVES[name], name == "null"
        full = name if "." in name or not space else f"{space}.{name}"
        found = full if full in self.named else name
        if found not in self.named:
            raise ValueError(f"Unknown Avro type {name!r}")
        typed = self.named[found]
        if typed is None:
            raise ValueError(f"Avro type {name!r} holds itself, which no Spark type can")
        return typed

    def union(self, branches: list, space: str) -> Typed:
        some = [b for b in branches if b != "null"]
        nullable = len(some) < len(branches)
        if not some:
            return T.NullType(), True
        if len(some) == 1:
            inner, own = self.of(some[0], space)
            return inner, nullable or own
        if all(isinstance(b, str) for b in some):
            for names, wider in WIDER:
                if set(some) == names:
                    return wider, nullable
        members = [self.of(b, space)[0] for b in some]
        return T.StructType([T.StructField(f"member{i}", m, True) for i, m in enumerate(members)]), nullable

    def _full(self, declared: dict, space: str) -> str:
        name, own = declared["name"], declared.get("namespace", space)
        return name if "." in name or not own else f"{own}.{name}"

    def record(self, declared: dict, space: str) -> Typed:
        full = self._full(declared, space)
        inside = full.rpartition(".")[0]
        self.named[full] = None
        fields = []
        for field in declared["fields"]:
            kind, nullable = self.of(field["type"], inside)
            fields.append(T.StructField(field["name"], kind, nullable))
        self.named[full] = T.StructType(fields), False
        return self.named[full]

    def named_plain(self, declared: dict, space: str) -> Typed:
        kind: T.DataType = T.StringType() if declared["type"] == "enum" else T.BinaryType()
        if declared.get("logicalType") == "decimal":
            kind = self.decimal(declared)
        self.named[self._full(declared, space)] = kind, False
        return kind, False

    @staticmethod
    def decimal(declared: dict) -> T.DecimalType:
        return T.DecimalType(declared["precision"], declared.get("scale", 0))

    def array(self, declared: dict, space: str) -> Typed:
        return T.ArrayType(*self.of(declared["items"], space)), False

    def map(self, declared: dict, space: str) -> Typed:
        return T.MapType(T.StringType(), *self.of(declared["values"], space)), False


def is_avro_text(schema: object) -> bool:
    """Is this Avro JSON text, not DDL?"""
    return isinstance(schema, str) and schema.lstrip()[:1] in ("{", "[", '"')


def from_avro_text(text: str) -> T.StructType:
    """The Spark type of a record declared as Avro JSON text."""
    try:
        declared = json.loads(text)
    except ValueError as error:
        raise ValueError(f"The Avro schema is not JSON: {error}") from error
    kind, _ = _Reader().of(declared, "")
    if not isinstance(kind, T.StructType):
        raise ValueError(f"A payload schema must be a record, not {kind.simpleString()}")
    return kind


def _declared(kind: T.DataType, nullable: bool, path: str) -> Any:
    """A Spark type as Avro; nested records are named by where they stand."""
    if isinstance(kind, T.StructType):
        fields = [{"name": f.name, "type": _declared(f.dataType, f.nullable, f"{path}_{f.name}")} for f in kind.fields]
        found: Any = {"type": "record", "name": path, "fields": fields}
    elif isinstance(kind, T.ArrayType):
        found = {"type": "array", "items": _declared(kind.elementType, kind.containsNull, path)}
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError(f"Avro maps have text keys, not {kind.keyType.simpleString()}")
        found = {"type": "map", "values": _declared(kind.valueType, kind.valueContainsNull, path)}
    elif isinstance(kind, T.DecimalType):
        found = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    else:
        found = next((avro for spark, avro in DECLARED if type(kind) is spark), None)
        if found is None:
            raise ValueError(f"Avro has no type for {kind.simpleString()}")
    return [found, "null"] if nullable and found != "null" else found


def to_avro_text(schema: T.StructType, name: str = "row") -> str:
    """The Avro JSON text of a record with the fields of ``schema``; what may be null is a union with null."""
    return json.dumps(_declared(schema, False, name))
