"""Grouped measures of the film tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.functions.measures import bin_sums, bins, mean, total
from filmlake.operators.relate import union_all


def grouped_sums(
    df: DataFrame,
    groups: Sequence[Column],
    sums: Mapping[str, Column],
    others: Mapping[str, tuple[Callable[[Column], Column], Column]] | None = None,
) -> DataFrame:
    """Per group, sums of doubles that no order of adding changes, and other measures.

    ``others`` maps a name to an aggregate and what it is taken of: a count is a sum of ones; sums, minima and
    maxima can be taken in two steps. First everything is added by group and power of two, in each task before
    the shuffle, so a group that fills the table is a few rows per task; then the powers of a group meet.
    """
    others = others or {}
    keys = df.select(*groups).columns
    rows = df.select(
        *groups,
        *(column for name, value in sums.items() for column in bins(value, name)),
        *(value.alias(name) for name, (_, value) in others.items()),
    )
    by_power = rows.groupBy(*keys, *(f"{name}_power" for name in sums)).agg(
        *(column for name in sums for column in bin_sums(name)),
        *(take(F.col(name)).alias(name) for name, (take, _) in others.items()),
    )
    return by_power.groupBy(*keys).agg(
        *(total(name).alias(name) for name in sums),
        *(take(F.col(name)).alias(name) for name, (take, _) in others.items()),
    )


def _number_of(value: Column) -> tuple[Callable[[Column], Column], Column]:
    """The non-null values, counted in two steps."""
    return F.sum, F.when(value.isNotNull(), 1).otherwise(0).cast("long")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def count_per(df: DataFrame, group: Column, count: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias(count))


def mean_per(
    df: DataFrame, group: Column, value: str, name: str, digits: int = 2, count: str | None = None
) -> DataFrame:
    """Rounded mean of ``value`` per group, and the group's size if it gets a name."""
    return means_per(df, [group], value, name, digits, count)


def means_per(
    df: DataFrame, groups: Sequence[Column], value: str, name: str, digits: int = 2, count: str | None = None
) -> DataFrame:
    """``mean_per`` by several columns."""
    found = grouped_sums(
        df, groups, {"_sum": F.col(value)},
        {"_values": _number_of(F.col(value)), "_rows": (F.sum, F.lit(1).cast("long"))},
    )
    measures = [F.round(mean("_sum", "_values"), digits).alias(name)]
    if count is not None:
        measures.append(F.col("_rows").alias(count))
    return found.select(*df.select(*groups).columns, *measures)


def yearly_ratings(by_genre: DataFrame, min_votes: int = 0) -> DataFrame:
    """Per year and genre, of films over ``min_votes``: films, weighted and simple mean."""
    rating, votes = F.col("nota_media"), F.col("total_votos")
    found = grouped_sums(
        by_genre.filter(votes > min_votes),
        [F.year("data_lancamento").alias("ano"), F.col("genero")],
        {"_rated": rating, "_weighted": rating * votes},
        {"filmes_por_genero": _number_of(F.col("id")), "_ratings": _number_of(rating), "_votes": (F.sum, votes)},
    )
    return found.select(
        "ano",
        "genero",
        "filmes_por_genero",
        F.round(mean("_weighted", "_votes"), 2).alias("media_ponderada_anual"),
        F.round(mean("_rated", "_ratings"), 2).alias("media_simples_anual"),
    )


def rating_pattern(yearly: DataFrame) -> DataFrame:
    """Per genre, means over the years of the rounded yearly means.

    The difference is taken before rounding, so it may differ by a cent from
    that of the two columns beside it.
    """
    films, simple = F.col("filmes_por_genero"), F.col("media_simples_anual")
    found = grouped_sums(
        yearly,
        [F.col("genero")],
        {"_weighted": F.col("media_ponderada_anual") * films, "_simple": simple},
        {
            "numero_filmes": (F.sum, films),
            "ano_inicial": (F.min, F.col("ano")),
            "ano_final": (F.max, F.col("ano")),
            "_years": _number_of(simple),
        },
    )
    overall, plain = mean("_weighted", "numero_filmes"), mean("_simple", "_years")
    return found.select(
        "genero",
        "numero_filmes",
        "ano_inicial",
        "ano_final",
        F.round(overall, 2).alias("media_ponderada_geral"),
        F.round(plain, 2).alias("media_simples_geral"),
        F.round(overall - plain, 2).alias("diferenca_medias"),
    )


def text_per_group(
    df: DataFrame, group: list[str], text: str, name: str, separator: str = ", "
) -> DataFrame:
    """The texts of each group joined in sorted order, NULLs left out.

    Meant for groups that are small by nature, such as the genres of one film.
    """
    joined = F.expr(f"listagg(`{text}`, '{separator}') WITHIN GROUP (ORDER BY `{text}`)")
    return df.groupBy(*group).agg(joined.alias(name))
