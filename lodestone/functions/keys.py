"""Key and identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slugify(c) -> Column:
    """Natural key of a name: lower-case, each space becomes ``_``, NULL becomes ``''``.

    Other characters are kept as they are (``'Hello World! @#$%'`` -> ``'hello_world!_@#$%'``).
    """
    return F.coalesce(F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_")), F.lit(""))


def url_from_title(base: str, title) -> Column:
    """``base`` followed by the title with spaces replaced by underscores."""
    return F.concat(F.lit(base), F.replace(_c(title), F.lit(" "), F.lit("_")))


def chunk_id(key, section, n: int = 0) -> Column:
    """``{key}__{section}__{n}``; the sequence number is always 0 (one chunk per section)."""
    return F.concat_ws("__", _c(key), _c(section), F.lit(str(n)))
