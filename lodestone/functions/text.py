"""Text expressions with Python string semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _c

# Whitespace as Python's str.strip/isspace sees it: Unicode white space plus the
# four information separators U+001C..U+001F.
WS_CLASS = r"[\s\x{1c}-\x{1f}]"
_STRIP = rf"(?U)^{WS_CLASS}+|{WS_CLASS}+$"


def py_strip(c) -> Column:
    """Strip leading and trailing whitespace (all Unicode whitespace, not only spaces)."""
    return F.regexp_replace(_c(c), _STRIP, "")


def blank_to_null(c) -> Column:
    """Strip, and NULL when nothing is left."""
    return F.nullif(py_strip(c), F.lit(""))


def labelled_join(pairs, sep: str = "; ") -> Column:
    """``"k1: v1; k2: v2"`` over the pairs whose value is non-empty; NULL when none is."""
    parts = [F.when(F.coalesce(_c(v), F.lit("")) != "", F.concat(F.lit(f"{k}: "), _c(v)))
             for k, v in pairs]
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))


def identity_text(title, key) -> Column:
    """``"Species: {title} ({key})"`` - the always-present identity section."""
    return F.format_string("Species: %s (%s)", F.coalesce(_c(title), F.lit("")),
                           F.coalesce(_c(key), F.lit("")))
