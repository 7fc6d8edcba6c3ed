"""Column expressions (all JVM-side built-ins, no UDFs)."""

from .json import (first_map_value, has_key, is_nonempty_object, non_null_map, record_from_json,
                   record_to_json)
from .keys import chunk_id, slugify, url_from_title
from .parse import (date_is_invalid, date_of_parts, date_parts, falsy_to_null_double, is_falsy,
                    parse_multi_date, safe_double, year_of)
from .text import blank_to_null, identity_text, labelled_join, py_strip

__all__ = [
    "first_map_value", "has_key", "is_nonempty_object", "non_null_map", "record_from_json",
    "record_to_json", "chunk_id", "slugify",
    "url_from_title", "date_is_invalid", "date_of_parts", "date_parts", "falsy_to_null_double", "is_falsy", "parse_multi_date",
    "safe_double", "year_of", "blank_to_null", "identity_text", "labelled_join", "py_strip",
]
