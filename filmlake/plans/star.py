"""The star-schema test tables seen as a film catalogue.

An order is a film, a nation a genre, and an order has the genres of the nations
its lines were supplied from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.operators.relate import unnest
from filmlake.plans.views import Silver

# an order has far fewer lines than a film has votes
MIN_VOTES = 150


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _film_columns(votes: Column) -> list[Column]:
    return [
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("titulo"),
        F.col("o_orderpriority").alias("idioma_original"),
        F.col("o_orderdate").cast("date").alias("data_lancamento"),
        (F.col("o_totalprice") / 1000).alias("popularidade"),
        (F.col("o_totalprice") / 50000).alias("nota_media"),
        F.coalesce(votes, F.lit(0)).cast("long").alias("total_votos"),
    ]


def films(spark: SparkSession, folder: str, with_votes: bool = True) -> DataFrame:
    """Film table; ``with_votes=False`` spares the lines and has no column of votes.

    The sum per order has already the partitioning the join to orders needs.
    """
    orders = table(spark, folder, "orders")
    if not with_votes:
        return orders.select(*_film_columns(F.lit(0))[:-1])
    votes = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("votes"))
    )
    return orders.join(votes, "o_orderkey", "left").select(*_film_columns(F.col("votes")))


def genres(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("genero")
    )


def _supplied_lines(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("genre")
    )
    return table(spark, folder, "lineitem").join(suppliers, "l_suppkey")


def film_genres(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (order, nation) pairs.

    Collected per order, which holds at most one entry per nation, so that the
    result stays partitioned by order and meets the films without a shuffle.
    """
    sets = (
        _supplied_lines(spark, folder)
        .groupBy(F.col("l_orderkey").alias("id_filme"))
        .agg(F.collect_set("genre").alias("genre_ids"))
    )
    return unnest(sets, "genre_ids", "id_genero")


def silver(spark: SparkSession, folder: str, with_votes: bool = True) -> Silver:
    return Silver(
        films(spark, folder, with_votes), genres(spark, folder), film_genres(spark, folder)
    )


def by_genre(spark: SparkSession, folder: str, with_votes: bool = False) -> DataFrame:
    return silver(spark, folder, with_votes).by_genre


def raw_films(spark: SparkSession, folder: str) -> DataFrame:
    """Lines seen as raw film records, in need of cleaning.

    Every line is a copy of the film of its order. What a line lacks makes a
    gap: no discount no rating, no tax no date, a discount of 10 % no title, one
    piece no genres. Line numbers lead to genres no nation has.
    """
    lines = _supplied_lines(spark, folder)
    title = F.concat_ws("/", F.lit("Line"), "l_orderkey", "l_linenumber")
    genre_ids = F.array("genre", "genre", F.col("l_linenumber").cast("long") + 22)
    return lines.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_discount") >= 0.1, "  ").otherwise(title).alias("title"),
        F.concat("l_linestatus", "l_returnflag").alias("original_title"),
        F.lower(F.concat("l_linestatus", "l_returnflag")).alias("original_language"),
        F.when(F.col("l_tax") == 0, "")
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("release_date"),
        F.when(F.col("l_quantity") > 1, genre_ids).alias("genre_ids"),
        (F.col("l_extendedprice") / 1000).alias("popularity"),
        F.col("l_extendedprice").cast("long").alias("revenue"),
        F.nullif(F.col("l_discount") * 100, F.lit(0.0)).alias("vote_average"),
        F.col("l_quantity").cast("long").alias("vote_count"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen as the records of a remote catalogue, to take extracts from."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("title"),
        F.col("o_orderpriority").alias("original_title"),
        F.col("o_orderdate").cast("date").cast("string").alias("release_date"),
        (F.col("o_totalprice") / 1000).alias("popularity"),
        F.col("o_totalprice").cast("long").alias("revenue"),
        (F.col("o_totalprice") / 50000).alias("vote_average"),
        F.col("o_custkey").alias("vote_count"),
    )
