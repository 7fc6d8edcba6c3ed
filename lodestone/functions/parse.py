"""Parsing of dirty landed values.  ANSI mode is on in Spark 4, so every cast
of ingested text goes through ``try_*`` functions and never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _c

# Fixed value: accepted date shapes, matching the whole string: year, year-month-day, or
# year-month-dayThour:minute:second.
DATE_SHAPES = r"^[0-9]{4}(-[0-9]{1,2}-[0-9]{1,2}([Tt][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?)?$"


def date_parts(c) -> Column:
    """The numbers of a text of an accepted shape (1, 3 or 6 texts), else NULL."""
    raw = _c(c)
    return F.when(raw.rlike(DATE_SHAPES), F.split(F.translate(raw, "Tt:", "---"), "-"))


def date_of_parts(parts: Column) -> Column:
    """``date_parts`` -> naive timestamp (``timestamp_ntz``), NULL where they name no time.  The
    parts are assembled with ``try_make_timestamp_ntz``: no parse exceptions on dirty rows,
    invalid calendar dates (Feb 30) give NULL, and the result does not depend on the session time
    zone.  Year 0000, hour 24, minute or second 60 are rejected as a strict parse rejects them."""
    year, month, day, hour, minute, second = (
        F.coalesce(F.get(parts, i).cast("int"), F.lit(int(i in (1, 2)))) for i in range(6))
    return F.when((year != 0) & (hour < 24) & (minute < 60) & (second < 60),
                  F.try_make_timestamp_ntz(year, month, day, hour, minute, second))


def parse_multi_date(c) -> Column:
    """Text -> naive timestamp by its shape; NULL for empty or unparseable text.  Signs and
    three-digit months are no accepted shape.  Where a row's parts are needed as a column of their
    own (they are read six times), use ``date_parts`` and ``date_of_parts``."""
    return date_of_parts(date_parts(c))


def date_is_invalid(c) -> Column:
    """True when a non-empty date text does not parse (empty / NULL is valid and gives NULL)."""
    raw = _c(c)
    return F.coalesce(raw != "", F.lit(False)) & parse_multi_date(raw).isNull()


# Shape of a number in text: decimal or exponent form, or a name of infinity or NaN.  A cast
# alone also takes the type suffixes of Java literals ("1d", "5f").
NUMBER_SHAPE = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?|nan))\s*$"


def safe_double(c) -> Column:
    """Text or number -> double; non-numeric -> NULL instead of an error."""
    text = _c(c).cast("string")
    return F.when(text.rlike(NUMBER_SHAPE), F.trim(text).try_cast("double"))


def falsy_to_null_double(c) -> Column:
    """NULL, ``''``, ``0`` -> NULL; anything else -> double (non-numeric stays NULL)."""
    return F.nullif(safe_double(c), F.lit(0.0))


def is_falsy(c) -> Column:
    """Python-style falsiness for a text value: NULL, ``''`` or a zero number."""
    raw = _c(c).cast("string")
    return raw.isNull() | (raw == "") | F.coalesce(safe_double(raw) == 0, F.lit(False))


def year_of(c) -> Column:
    return F.year(_c(c))
