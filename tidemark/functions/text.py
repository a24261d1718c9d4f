"""Text functions: masking, globs, safe names, key lists in DDL."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask(value: Column, salt: str) -> Column:
    """Lower-case SHA-256 of value and salt; null stays null."""
    return F.sha2(F.concat(value, F.lit(salt)), 256)


def glob_regex(glob: str) -> str:
    """An anchored pattern in which * stands for any run of characters and all else for itself."""
    return "(?s)^" + ".*".join(re.escape(p) for p in glob.split("*")) + "$"


def glob_any(value: Column, globs: list[str]) -> Column:
    """Whether any glob fits; no globs fit nothing."""
    out = F.lit(False)
    for g in globs:
        out = out | value.rlike(glob_regex(g))
    return out


def safe_component(name: Column) -> Column:
    """Dots, spaces, > and * become underscores."""
    return F.translate(name, ". >*", "____")


def primary_key_columns(ddl: Column) -> Column:
    """Column names of a PRIMARY KEY clause, without quotes and sort order; none: an empty list."""
    inside = F.regexp_extract(ddl, r"(?i)primary\s+key\s*\(([^)]*)\)", 1)
    names = F.transform(F.split(inside, ","), lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)\s+(asc|desc)$", ""), r"[`\"']", ""))
    return F.filter(names, lambda c: c != "")


def contains_ignoring_case(value: Column, part: str) -> Column:
    return F.lower(value).contains(part.lower())
