"""Identifiers, dotted names and document fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier(name: Column, max_length: int = 60, default: str = "model") -> Column:
    """Lower-case identifier: runs of other characters become one underscore."""
    text = F.regexp_replace(name, "[^a-zA-Z0-9_]+", "_")
    text = F.regexp_replace(text, "^_+|_+$", "")
    text = F.substring(F.lower(text), 1, max_length)
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def last_part(name: Column, separator: str = ".") -> Column:
    """Text after the last separator."""
    return F.substring_index(name, separator, -1)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def json_field(text: Column, path: str, default: str = "") -> Column:
    """A field of a JSON text, with a default for missing fields and bad texts."""
    return F.coalesce(F.get_json_object(text, path), F.lit(default))


def entries(map_col: Column) -> Column:
    """A map as a list of key/value pairs, ordered by key."""
    return F.sort_array(F.map_entries(map_col))


def from_entries(list_col: Column) -> Column:
    return F.map_from_entries(list_col)
