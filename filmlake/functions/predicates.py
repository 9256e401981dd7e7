"""Validity of a raw film record, as Columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"


def has_text(column: str) -> Column:
    """Not NULL and not made of spaces alone; never NULL itself."""
    return F.coalesce(F.trim(F.col(column)) != F.lit(""), F.lit(False))


def parsed_date(column: str, date_format: str | None = DATE_FORMAT) -> Column:
    """Text to date; NULL where it is no date, also in ANSI mode.

    ``date_format=None`` takes every spelling a Spark cast knows, such as a bare
    year. The usual format is that cast behind a look at the shape, which is
    several times faster than a formatter and accepts the same texts.
    """
    text = F.col(column)
    if date_format is None:
        return text.try_cast("date")
    if date_format == DATE_FORMAT:
        return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))
    return F.try_to_date(text, date_format)


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day a run counts as today."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date")


def is_released(
    column: str, as_of: dt.date | str | None = None, date_format: str | None = DATE_FORMAT
) -> Column:
    """A real date that is not after ``as_of``; never NULL itself."""
    return F.coalesce(parsed_date(column, date_format) <= as_of_date(as_of), F.lit(False))


def is_valid_film(
    as_of: dt.date | str | None = None, date_format: str | None = DATE_FORMAT
) -> Column:
    """A record worth keeping: with an id, dated, titled, with a genre list, already released.

    An empty genre list passes, a missing one does not.
    """
    return (
        F.col("id").isNotNull()
        & has_text("title")
        & F.col("genre_ids").isNotNull()
        & has_text("release_date")
        & is_released("release_date", as_of, date_format)
    )
