"""The named results over the silver tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.operators.aggregate import (
    count_per,
    mean_per,
    means_per,
    rating_pattern,
    row_counts,
    text_per_group,
    yearly_ratings,
)
from filmlake.operators.ranking import ranked_top, top_with_ties
from filmlake.operators.relate import films_by_genre

TOP = 3
MIN_VOTES = 500


@dataclass
class Silver:
    """The three silver tables, and the films joined to their genres.

    ``by_genre`` may be given as a written table, so that the views do not join
    again; left out, each view joins for itself.
    """

    films: DataFrame
    genres: DataFrame
    film_genres: DataFrame
    by_genre: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.by_genre is None:
            self.by_genre = films_by_genre(self.films, self.film_genres, self.genres)

    def tables(self) -> dict[str, DataFrame]:
        """The tables by the names they have in SQL."""
        return {
            "filmes": self.films,
            "generos": self.genres,
            "filmes_generos": self.film_genres,
        }


def _release_year():
    return F.year("data_lancamento").alias("ano")


def films_per_year(films: DataFrame) -> DataFrame:
    return count_per(films, _release_year(), "numero_filmes").select("numero_filmes", "ano")


def votes_by_language(films: DataFrame) -> DataFrame:
    return (
        mean_per(films, F.col("idioma_original"), "total_votos", "media_votos")
        .select("media_votos", "idioma_original")
        .orderBy(F.col("media_votos").desc_nulls_last(), "idioma_original")
    )


def popularity_by_year(films: DataFrame) -> DataFrame:
    return mean_per(
        films, _release_year(), "popularidade", "media_popularidade", count="qtd_filmes"
    ).orderBy(F.col("media_popularidade").desc_nulls_last(), "ano")


def popularity_by_genre(by_genre: DataFrame) -> DataFrame:
    return mean_per(
        by_genre, F.col("genero"), "popularidade", "media_popularidade", count="qtd_filmes"
    ).orderBy(F.col("media_popularidade").desc_nulls_last(), "genero")


def genre_rating_pattern(by_genre: DataFrame) -> DataFrame:
    return rating_pattern(yearly_ratings(by_genre))


def top_films_by_genre(by_genre: DataFrame, min_votes: int = MIN_VOTES, k: int = TOP) -> DataFrame:
    """Best rated films per genre; ranked on the rating itself, printed rounded."""
    voted = by_genre.filter(F.col("total_votos") > min_votes)
    rows = voted.select("genero", "titulo", "nota_media")
    return top_with_ties(rows, ["genero"], "nota_media", k).select(
        "genero", "titulo", F.round("nota_media", 2).alias("nota_media"), "ranking"
    )


def top_genres_by_year(by_genre: DataFrame, k: int = TOP) -> DataFrame:
    """Best rated genres per year; ranked on the rounded mean, so ties abound.

    A year has at most one row per genre here, so a plain window will do.
    """
    yearly = means_per(by_genre, [_release_year(), F.col("genero")], "nota_media", "media_nota_ano", digits=1)
    return ranked_top(yearly, ["ano"], "media_nota_ano", k, rank="rank_do_genero").select(
        "ano", "rank_do_genero", "genero", "media_nota_ano"
    )


def genres_text_per_film(by_genre: DataFrame) -> DataFrame:
    return (
        text_per_group(
            by_genre, ["id", "titulo", "popularidade", "nota_media"], "genero", "generos"
        )
        .orderBy(F.col("popularidade").desc_nulls_last(), "id")
        .select("titulo", "popularidade", "nota_media", "generos")
    )


def genres_of_title(by_genre: DataFrame, title: str, collation: str | None = None) -> DataFrame:
    """Genres of the films with this title, byte for byte or by a collation."""
    titles = F.col("titulo")
    if collation is not None:
        titles = F.collate(titles, collation)
    return by_genre.filter(titles == F.lit(title)).select(
        F.col("id").alias("id_filme"), "titulo", "genero", "id_genero"
    )


def table_sizes(silver: Silver) -> DataFrame:
    return row_counts(silver.tables())


# The names the results are exported under
GOLD = (
    "filmes_lancados_por_ano",
    "padrao_avaliacao",
    "top_filmes_por_genero",
    "top_generos_por_ano",
    "popularidade_vs_nota_media",
    "popularidade_por_ano",
    "generos_por_popularidade",
)


def gold_results(silver: Silver, min_votes: int = MIN_VOTES, k: int = TOP) -> dict[str, DataFrame]:
    """Every result by its name; nothing is computed yet."""
    return dict(zip(GOLD, (
        films_per_year(silver.films),
        genre_rating_pattern(silver.by_genre),
        top_films_by_genre(silver.by_genre, min_votes, k),
        top_genres_by_year(silver.by_genre, k),
        genres_text_per_film(silver.by_genre),
        popularity_by_year(silver.films),
        popularity_by_genre(silver.by_genre),
    ), strict=True))


def register_tables(silver: Silver) -> list[str]:
    """Name the tables for ``spark.sql``; their names."""
    for name, df in silver.tables().items():
        df.createOrReplaceTempView(name)
    return list(silver.tables())


def register_views(silver: Silver, min_votes: int = MIN_VOTES, k: int = TOP) -> list[str]:
    """Name every result for ``spark.sql``, replacing older ones; their names."""
    for name, df in gold_results(silver, min_votes, k).items():
        df.createOrReplaceTempView(name)
    return list(GOLD)
