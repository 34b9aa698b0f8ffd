"""Declared document schema: ordered typed fields with stored / indexed flags.

The schema is fixed before anything is written and is never inferred.
All validation happens on the driver, before a Spark job starts.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

from quarry.functions.text import DEFAULT, Analyzer

TEXT = "text"
U64 = "u64"
I64 = "i64"
F64 = "f64"
BOOL = "bool"
FIELD_TYPES = (TEXT, U64, I64, F64, BOOL)
NUMERIC_TYPES = (U64, I64, F64)

# Largest value an unsigned 64-bit field can hold.
U64_MAX = 18446744073709551615


class SearchError(ValueError):
    """Raised for every invalid schema, field, or query argument."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    stored: bool = False
    indexed: bool = True
    analyzer: Analyzer = DEFAULT

    def __post_init__(self):
        if isinstance(self.analyzer, dict):
            object.__setattr__(self, "analyzer", Analyzer(**self.analyzer))
        if self.analyzer != DEFAULT and self.type != TEXT:
            raise SearchError("Only text fields have an analyzer")
        if self.type not in FIELD_TYPES:
            raise SearchError(f"Unsupported field type '{self.type}'")
        if not isinstance(self.name, str) or not self.name:
            raise SearchError("Field name must be a non-empty string")

    def spark_type(self) -> T.DataType:
        return {
            TEXT: T.StringType(),
            U64: T.DecimalType(20, 0),      # the whole unsigned 64-bit range
            I64: T.LongType(),
            F64: T.DoubleType(),
            BOOL: T.BooleanType(),
        }[self.type]


class Schema:
    """Ordered list of fields. Builders return a new schema (immutable)."""

    def __init__(self, fields=()):
        self.fields: tuple[Field, ...] = tuple(fields)

    def _add(self, name, type_, stored, indexed) -> "Schema":
        return Schema(self.fields + (Field(name, type_, stored, indexed),))

    def add_text_field(self, name, stored=False, indexed=True, analyzer: Analyzer = DEFAULT) -> "Schema":
        return Schema(self.fields + (Field(name, TEXT, stored, indexed, analyzer),))

    def add_u64_field(self, name, stored=False, indexed=True) -> "Schema":
        return self._add(name, U64, stored, indexed)

    def add_i64_field(self, name, stored=False, indexed=True) -> "Schema":
        return self._add(name, I64, stored, indexed)

    def add_f64_field(self, name, stored=False, indexed=True) -> "Schema":
        return self._add(name, F64, stored, indexed)

    def add_bool_field(self, name, stored=False, indexed=True) -> "Schema":
        return self._add(name, BOOL, stored, indexed)

    def validate(self) -> "Schema":
        if not self.fields:
            raise SearchError("no_fields: a schema needs at least one field")
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise SearchError("duplicate_field_names: field names must be unique")
        return self

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise SearchError(f"Field '{name}' not found in schema")

    def text_fields(self) -> list[str]:
        """Indexed text fields: the ones analysed into the term table."""
        return [f.name for f in self.fields if f.type == TEXT and f.indexed]

    def analyzers(self) -> dict[str, Analyzer]:
        """The fields with a chain of their own."""
        return {f.name: f.analyzer for f in self.fields if f.analyzer != DEFAULT}

    def value_fields(self) -> list[Field]:
        """Indexed numeric and boolean fields: the ones kept in the value table."""
        return [f for f in self.fields if f.type != TEXT and f.indexed]

    def stored_fields(self) -> list[str]:
        return [f.name for f in self.fields if f.stored]

    def require_text(self, name: str, message: str | None = None) -> Field:
        f = self.field(name)
        if f.type != TEXT:
            raise SearchError(
                message or f"Field '{name}' is not a text field. Only text fields are "
                "currently supported for term queries."
            )
        return f

    def to_json(self) -> str:
        return json.dumps([asdict(f) for f in self.fields])

    @classmethod
    def from_json(cls, text: str) -> "Schema":
        return cls(Field(**f) for f in json.loads(text))

    def __repr__(self):
        return f"Schema({list(self.fields)!r})"
