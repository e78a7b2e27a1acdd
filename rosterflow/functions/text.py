"""Cell text in and out: blanks, dates, amounts, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.model import (
    OPEN_END_SENTINEL,
    SHEET_DATE_FORMAT,
    SHEET_DATE_PATTERN,
    SHEET_DATE_SHAPE,
)


def filled(col: Column) -> Column:
    """Neither null nor blank."""
    return col.isNotNull() & (col != "")


def blank_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Turn ``''`` into null in the named (default: all) text columns."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.nullif(F.col(f"`{name}`"), F.lit("")) for name in names})


def null_text() -> Column:
    """A text column with nothing in it."""
    return F.lit(None).cast("string")


def parse_date(col: Column) -> Column:
    """Sheet text to a date; blanks and words become null instead of failing.

    The shape is tested first: a failed parse costs far more than a failed match.
    """
    text = F.trim(col)
    return F.when(text.rlike(SHEET_DATE_SHAPE), F.try_to_date(text, SHEET_DATE_PATTERN))


def date_text(col: Column, pattern: str = SHEET_DATE_FORMAT) -> Column:
    """A date in the sheets' own form."""
    return F.date_format(col, pattern)


def end_date_or_sentinel(col: Column, sentinel: str = OPEN_END_SENTINEL) -> Column:
    """End date as a date, with a far-off date standing for an open (blank) end."""
    open_end = col.isNull() | (F.trim(col) == "")
    return F.when(open_end, F.lit(sentinel).cast("date")).otherwise(parse_date(col))


def sentinel_to_null(col: Column, sentinel: str = OPEN_END_SENTINEL) -> Column:
    """Undo :func:`end_date_or_sentinel` after aggregation."""
    return F.nullif(col, F.lit(sentinel).cast("date"))


def parse_amount(col: Column) -> Column:
    """``12.345,67`` to a decimal; unreadable text becomes null."""
    plain = F.translate(F.trim(col), ",.", ".")  # a comma becomes a point, a point goes
    return F.nullif(plain, F.lit("")).try_cast("decimal(12,2)")


def scale_hundredths(col: Column) -> Column:
    """Integer hundredths to a two-place decimal."""
    return (col.cast("decimal(14,0)") / F.lit(100)).cast("decimal(12,2)")


def sheet_team(name: Column, prefix: str) -> Column:
    """Team a sheet belongs to, or null when the name lacks the prefix."""
    return F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 2**31 - 1))


def split_name(col: Column, surname: str = "last_name", given: str = "first_name") -> list[Column]:
    """``Surname, Name`` as two columns."""
    parts = F.split(col, r",\s*", 2)
    return [F.get(parts, 0).alias(surname), F.get(parts, 1).alias(given)]


def cast_key(col: Column) -> Column:
    """Key as text, at full length, for comparing ids of different types."""
    return col.cast("string")


def load_stamp(day: Column) -> Column:
    """``YYYYMMDD`` of the given day (pass ``current_date()`` for today)."""
    return F.date_format(day, "yyyyMMdd")
