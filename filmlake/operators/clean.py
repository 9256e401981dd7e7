"""Cleaning of raw film records: one copy per key, validity, filling, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.functions.predicates import (
    DATE_FORMAT,
    as_of_date,
    has_text,
    is_valid_film,
    parsed_date,
)
from filmlake.schemas import CORRUPT

ZERO_FILLED = ["vote_average", "vote_count"]
# what an audit counts failures of
RULES = ("no_id", "no_title", "no_genres", "no_date", "bad_date", "future_date")


def keep_one(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by the columns ``by``, then by all others.

    The full order makes the survivor the same in every run and for every split
    of the input. NULL counts as least. As a maximum it is settled in each task
    before the shuffle, so any number of copies of one key does no harm.
    """
    rest = [name for name in df.columns if name not in (*keys, *by)]
    greatest = F.max(F.struct(*by, *rest)).alias("_row")
    return (
        df.groupBy(*keys)
        .agg(greatest)
        .select(*(
            F.col(name) if name in keys else F.col("_row")[name].alias(name)
            for name in df.columns
        ))
    )


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first; cheaper, but differs between runs."""
    return df.dropDuplicates(list(keys))


def fill_zero(df: DataFrame, columns: Sequence[str] = ZERO_FILLED) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def clean_films(
    raw: DataFrame,
    as_of: dt.date | str | None = None,
    date_format: str | None = DATE_FORMAT,
    strict_reference_order: bool = False,
    all_valid: bool = False,
) -> DataFrame:
    """Valid records, one per id, the most popular copy, votes filled with 0.

    A film lives if any of its copies is valid, so invalid copies are dropped
    first, which also keeps them out of the shuffle. ``strict_reference_order``
    picks a copy without looking at validity and filters afterwards. ``all_valid`` says that
    the invalid ones of the same day are gone already, so no text is read again to tell.
    """
    if all_valid:
        return fill_zero(keep_one(raw, ["id"], ["popularity"]))
    valid = is_valid_film(as_of, date_format)
    if strict_reference_order:
        kept = keep_one(raw, ["id"], ["popularity"]).filter(valid)
    else:
        kept = keep_one(raw.filter(valid), ["id"], ["popularity"])
    return fill_zero(kept)


def with_checks(
    raw: DataFrame, as_of: dt.date | str | None = None, date_format: str | None = DATE_FORMAT
) -> DataFrame:
    """Each record beside ``_valid`` and, for each rule, whether it fails it (a row may fail many).

    A record's texts and its date are looked at once, in generated code, however many counts and filters follow.
    """
    seen = raw.withColumns({
        "_titled": has_text("title"),
        "_dated": has_text("release_date"),
        "_date": parsed_date("release_date", date_format),
    })
    dated, readable = F.col("_dated"), F.col("_date").isNotNull()
    released = F.coalesce(F.col("_date") <= as_of_date(as_of), F.lit(False))
    failures = {
        "no_id": F.col("id").isNull(),
        "no_title": ~F.col("_titled"),
        "no_genres": F.col("genre_ids").isNull(),
        "no_date": ~dated,
        "bad_date": dated & ~readable,
        "future_date": readable & ~released,
    }
    return seen.select(
        *raw.columns,
        # a record is valid if it fails no rule
        (~reduce(or_, failures.values())).alias("_valid"),
        *(failed.alias(f"_{name}") for name, failed in failures.items()),
    )


def audit_columns() -> list[Column]:
    """Rows in, rows that pass, and rows that fail each rule, of a frame from ``with_checks``."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("_valid").alias("rows_valid"),
        *(F.count_if(f"_{name}").alias(name) for name in RULES),
    ]


def corrupt_column() -> Column:
    """Lines that were no JSON; only a frame from ``read_films`` has the column."""
    return F.count(F.col(CORRUPT)).alias("corrupt")


def cleaning_audit(
    raw: DataFrame, as_of: dt.date | str | None = None, date_format: str | None = DATE_FORMAT
) -> DataFrame:
    """The audit as one row, in one pass."""
    return with_checks(raw, as_of, date_format).agg(*audit_columns())
