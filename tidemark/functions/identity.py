"""Table identity: schema defaults, qualified names, key tokens, identifiers, primary-key strings."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCHEMA = "public"


def schema_or_default(schema: Column) -> Column:
    """Null and empty schemas are public."""
    return F.coalesce(F.nullif(schema, F.lit("")), F.lit(DEFAULT_SCHEMA))


def qualified(schema: Column, table: Column) -> Column:
    return F.concat_ws(".", schema_or_default(schema), table)


def key_token(schema: Column, table: Column) -> Column:
    """The bare table in public, else schema=table; no two tables share a token."""
    named = schema_or_default(schema)
    return F.when(named == DEFAULT_SCHEMA, table).otherwise(F.concat(named, F.lit("="), table))


@dataclass(frozen=True, order=True)
class TableRef:
    schema: str
    table: str

    @classmethod
    def parse(cls, text: str) -> TableRef:
        """table or schema.table; other forms, empty parts and '=' are refused."""
        parts = text.split(".")
        if len(parts) > 2 or not all(parts) or "=" in text:
            raise ValueError(f"not a table reference: {text!r}")
        return cls(*parts) if len(parts) == 2 else cls(DEFAULT_SCHEMA, text)

    @classmethod
    def from_token(cls, token: str) -> TableRef:
        schema, eq, table = token.partition("=")
        return cls(schema, table) if eq else cls(DEFAULT_SCHEMA, token)

    @property
    def token(self) -> str:
        return self.table if self.schema == DEFAULT_SCHEMA else f"{self.schema}={self.table}"

    def __str__(self) -> str:
        return f"{self.schema}.{self.table}"


_PART = re.compile(r"[A-Za-z0-9_]+\Z")


def checked_identifier(name: str) -> str:
    """The name, if each dot-separated part is letters, digits and underscores."""
    if not all(_PART.match(p) for p in name.split(".")):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def is_identifier(name: Column) -> Column:
    """Whether each dot-separated part of a name is letters, digits and underscores."""
    return name.rlike(r"^[A-Za-z0-9_]+(\.[A-Za-z0-9_]+)*\z")


def quoted(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def stats_key(pipeline: Column, source: Column, sink: Column, schema: Column, table: Column) -> Column:
    return F.concat_ws(".", pipeline, source, sink, key_token(schema, table))


def key_text(column: Column, kind: str) -> Column:
    """Display text of one key value: whole doubles without a fraction, bytes as text, the rest as Spark prints them."""
    if kind in ("double", "float"):
        whole = (column == F.floor(column)) & (F.abs(column) < 9e18)
        return F.when(whole, column.cast("bigint").cast("string")).otherwise(column.cast("string"))
    return column.cast("string")


def key_string(columns: list[Column]) -> Column:
    """Key values joined by a vertical bar, for display; joins use the typed columns."""
    return F.concat_ws("|", *columns)
