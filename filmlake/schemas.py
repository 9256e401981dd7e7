"""Table contracts: one fixed StructType per layer, and ``conform`` to reach it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"

# bronze: the fields the later layers use; anything else in the JSON is never parsed
FILM_RAW = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("original_title", StringType()),
    StructField("original_language", StringType()),
    StructField("release_date", StringType()),
    StructField("genre_ids", ArrayType(LongType())),
    StructField("popularity", DoubleType()),
    StructField("revenue", LongType()),
    StructField("vote_average", DoubleType()),
    StructField("vote_count", LongType()),
])

GENRE_RAW = StructType([
    StructField("id", StringType()),
    StructField("genero", StringType()),
])

# silver
FILMS = StructType([
    StructField("id", LongType(), False),
    StructField("titulo", StringType()),
    StructField("idioma_original", StringType()),
    StructField("data_lancamento", DateType()),
    StructField("popularidade", DoubleType()),
    StructField("nota_media", DoubleType()),
    StructField("total_votos", LongType()),
])

GENRES = StructType([
    StructField("id", LongType(), False),
    StructField("genero", StringType()),
])

FILM_GENRES = StructType([
    StructField("id_filme", LongType(), False),
    StructField("id_genero", LongType(), False),
])

# longest text each silver column may hold
TEXT_LIMITS = {
    "films": {"titulo": 255, "idioma_original": 50},
    "genres": {"genero": 25},
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select, cast and order the columns of ``df`` as ``schema`` says.

    Extra columns go away; a missing one is an analysis error and a value that
    does not cast is a runtime error (ANSI), since by then data must be clean. So is
    a NULL in a column that may hold none.
    """

    def brought(f: StructField) -> Column:
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in column {f.name}")).cast(f.dataType))
        return value.alias(f.name)

    return df.select(*map(brought, schema))


def conform_or_reject(
    df: DataFrame, schema: StructType, limits: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``conform`` for rows that may break the contract: those that keep it, and those that don't.

    The second frame has a row for each column that a row breaks: ``column_name``, ``reason``
    ("does not cast", "NULL" or "too long", by ``limits``), the ``value`` as text, and ``record``, the whole
    row as JSON. Both frames read ``df``; hand in a written table to have it computed once.
    """
    limits = limits or {}
    tried = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}

    def broken(f: StructField) -> Column:
        value, given = tried[f.name], F.col(f.name).isNotNull()
        reason = F.when(given & value.isNull(), "does not cast")
        if not f.nullable:
            reason = reason.when(~given, "NULL")
        if f.name in limits:
            reason = reason.when(F.length(value) > limits[f.name], "too long")
        return F.struct(
            F.lit(f.name).alias("column_name"), reason.alias("reason"), F.col(f.name).cast("string").alias("value")
        )

    reasons = F.filter(F.array(*map(broken, schema.fields)), lambda x: x["reason"].isNotNull())
    kept = df.filter(F.size(reasons) == 0).select(*(tried[name].alias(name) for name in schema.names))
    record = F.to_json(F.struct(*df.columns))
    return conform(kept, schema), df.select(F.inline(reasons), record.alias("record"))
