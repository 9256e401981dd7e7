"""The contracts of the silver tables, checked in one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.operators.checks import key_violations, orphans, text_violations
from filmlake.operators.relate import union_all
from filmlake.plans.views import Silver
from filmlake.schemas import TEXT_LIMITS


def violations(silver: Silver) -> dict[str, DataFrame]:
    """The offending rows of each contract, by its name."""
    films, genres, pairs = silver.films, silver.genres, silver.film_genres
    return {
        "films key": key_violations(films, ["id"]),
        "genres key": key_violations(genres, ["id"]),
        "film_genres key": key_violations(pairs, ["id_filme", "id_genero"]),
        "films text": text_violations(films, "id", TEXT_LIMITS["films"]),
        "genres text": text_violations(genres, "id", TEXT_LIMITS["genres"]),
        "film_genres to films": orphans(pairs, "id_filme", films, "id"),
        "film_genres to genres": orphans(pairs, "id_genero", genres, "id"),
    }


def _excess(limits) -> Column:
    """How many of a row's texts are too long."""
    return sum((F.when(F.length(c) > most, 1).otherwise(0) for c, most in limits.items()), F.lit(0)).cast("long")


def _named(table: str, first: Column, second: Column, own: int, refers: int, long: Column) -> Column:
    """A key as it stands in a row: as the row's own, or as one that the row refers to."""
    return F.struct(
        F.lit(table).alias("table"), first.alias("first"), second.alias("second"),
        F.lit(own).cast("long").alias("own"), F.lit(refers).cast("long").alias("refers"), long.alias("long"),
    )


def contract_report(silver: Silver) -> DataFrame:
    """Number of violations of each contract; all are 0 in sound tables.

    Each table is scanned once: its rows become the keys that they hold or refer to, and one
    aggregation by table and key tells keys that are missing or repeated, and references to keys that no row
    holds. Counts are added up before the shuffle, so a genre that a third of all pairs refer to is a row a task.
    """
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    film, genre = F.col("id_filme"), F.col("id_genero")
    keys = union_all([
        silver.films.select(_named("films", F.col("id"), none, 1, 0, _excess(TEXT_LIMITS["films"])).alias("key")),
        silver.genres.select(_named("genres", F.col("id"), none, 1, 0, _excess(TEXT_LIMITS["genres"])).alias("key")),
        silver.film_genres.select(F.explode(F.array(
            _named("film_genres", film, genre, 1, 0, zero),
            _named("films", film, none, 0, 1, zero),
            _named("genres", genre, none, 0, 1, zero),
        )).alias("key")),
    ]).select("key.*")
    by_key = keys.groupBy("table", "first", "second").agg(
        F.sum("own").alias("own"), F.sum("refers").alias("refers"), F.sum("long").alias("long")
    )
    lacks = F.col("first").isNull() | ((F.col("table") == "film_genres") & F.col("second").isNull())
    wrong_key = F.when((F.col("own") > 1) | (lacks & (F.col("own") > 0)), 1).otherwise(0)
    astray = F.when((F.col("own") == 0) & F.col("first").isNotNull(), F.col("refers")).otherwise(0)

    def total(table: str, counted: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("table") == table, counted)), F.lit(0)).cast("long")

    sums = {
        "films key": total("films", wrong_key),
        "genres key": total("genres", wrong_key),
        "film_genres key": total("film_genres", wrong_key),
        "films text": total("films", F.col("long")),
        "genres text": total("genres", F.col("long")),
        "film_genres to films": total("films", astray),
        "film_genres to genres": total("genres", astray),
    }
    return by_key.agg(*(found.alias(name) for name, found in sums.items())).unpivot(
        [], list(sums), "contract", "violations"
    )
