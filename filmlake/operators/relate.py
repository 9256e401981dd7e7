"""Projection, lookup, unnesting, joins and unions of the film tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.functions.languages import LANGUAGE_LABELS
from filmlake.functions.predicates import DATE_FORMAT, parsed_date

FILM_NAMES = {
    "id": "id",
    "title": "titulo",
    "original_language": "idioma_original",
    "release_date": "data_lancamento",
    "popularity": "popularidade",
    "vote_average": "nota_media",
    "vote_count": "total_votos",
}


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns of ``names`` under their new names; the others are not read."""
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def label_of(code: Column | str, labels: Mapping[str, str] = LANGUAGE_LABELS) -> Column:
    """Label of a code from a literal map; NULL for a code it does not know."""
    pairs = F.create_map(*(F.lit(text) for pair in labels.items() for text in pair))
    return pairs[F.col(code) if isinstance(code, str) else code]


def films_of(
    records: DataFrame,
    labels: Mapping[str, str] = LANGUAGE_LABELS,
    date_format: str | None = DATE_FORMAT,
) -> DataFrame:
    """Film table of clean records: renamed, language labelled, date typed."""
    return renamed(records, FILM_NAMES).withColumns({
        "idioma_original": label_of("idioma_original", labels),
        "data_lancamento": parsed_date("data_lancamento", date_format),
    })


def unnest(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per array element; NULL and empty arrays give none."""
    rest = [column for column in df.columns if column != array]
    return df.select(*rest, F.explode(array).alias(name))


def film_genre_pairs(records: DataFrame, unique_ids: bool = True) -> DataFrame:
    """Distinct (film, genre) pairs.

    When ids are unique a pair can only repeat inside one array, so it is
    settled row by row, with no shuffle; otherwise by a distinct over all rows.
    """
    ids = F.array_distinct("genre_ids") if unique_ids else F.col("genre_ids")
    pairs = unnest(
        records.select(F.col("id").alias("id_filme"), ids.alias("genre_ids")),
        "genre_ids",
        "id_genero",
    )
    return pairs if unique_ids else pairs.distinct()


def films_by_genre(films: DataFrame, film_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """Films joined to their genres over the bridge; films without one drop out.

    Films and bridge meet on the film id. The genre table is far below the size
    at which Spark broadcasts a side by itself, and no hint forces it, so a
    large one is shuffled instead.
    """
    named = genres.select(F.col("id").alias("id_genero"), "genero")
    return (
        films.join(film_genres, films["id"] == film_genres["id_filme"])
        .drop("id_filme")
        .join(named, "id_genero")
        .select(*films.columns, "id_genero", "genero")
    )


def records_by_genre(records: DataFrame, genres: DataFrame) -> DataFrame:
    """The rows of ``films_by_genre`` straight from records with unique ids.

    The array still sits beside the film, so nothing has to be joined but the
    genre names.
    """
    named = genres.select(F.col("id").alias("id_genero"), "genero")
    pairs = records.withColumn("genre_ids", F.array_distinct("genre_ids"))
    return unnest(pairs, "genre_ids", "id_genero").join(named, "id_genero")


def matching(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key exists in ``parent``; none when it is empty."""
    keys = parent.select(F.col(parent_key).alias(key))
    return df.join(keys, key, "left_semi").select(*df.columns)


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows that break a foreign key: a key is given but ``parent`` lacks it."""
    keys = parent.select(F.col(parent_key).alias(key))
    given = df.filter(F.col(key).isNotNull())
    return given.join(keys, key, "left_anti").select(*df.columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
