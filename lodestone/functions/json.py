"""Tests on schemaless JSON payloads kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _c


def is_nonempty_object(c) -> Column:
    """True only for a JSON object with at least one key (text, ``{}``, arrays, null -> False).

    Note that ``from_json`` of plain text gives a struct of NULLs, not NULL, so
    the test must look at the keys and not at the parsed struct.
    """
    return F.coalesce(F.size(F.json_object_keys(_c(c))), F.lit(0)) > 0


def has_key(c, key: str) -> Column:
    """True when the JSON object has ``key`` (even with a null value)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_c(c)), F.lit(key)), F.lit(False))


def first_map_value(c) -> Column:
    """First value of a map in its stored order (NULL for an empty map)."""
    return F.get(F.map_values(_c(c)), 0)


def non_null_map(*pairs) -> Column:
    """``map<string,string>`` of the given (name, column) pairs without NULL values."""
    args = []
    for name, col in pairs:
        args += [F.lit(name), _c(col).cast("string")]
    if not args:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*args), lambda k, v: v.isNotNull())


def record_to_json(*cols) -> Column:
    """Serialise a record (the given columns, or all with ``"*"``) to one JSON text."""
    return F.to_json(F.struct(*cols))


def record_from_json(c, schema) -> Column:
    """Inverse of ``record_to_json`` for a known schema (lossless for the record types used)."""
    return F.from_json(_c(c), schema)
