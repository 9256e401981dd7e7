"""Table contracts as queries that return the rows breaking them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.operators.relate import orphans

__all__ = ["key_violations", "orphans", "text_violations"]


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are NULL in any part or occur more than once, with a count.

    Counted map-side first, so a key that fills the table is one row per task.
    """
    incomplete = reduce(or_, (F.col(key).isNull() for key in keys))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(incomplete | (F.col("copies") > 1))
    )


def text_violations(df: DataFrame, key: str, limits: Mapping[str, int]) -> DataFrame:
    """One row per text longer than its column allows, all columns in one scan."""
    texts = F.array(*(
        F.struct(
            F.lit(column).alias("column_name"),
            F.length(column).cast("long").alias("text_length"),
            F.lit(limit).cast("long").alias("max_length"),
        )
        for column, limit in limits.items()
    ))
    too_long = F.filter(texts, lambda text: text["text_length"] > text["max_length"])
    return df.select(F.col(key), F.inline(too_long))
