"""Every operator as a query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmlake.functions.languages import LANGUAGE_LABELS
from filmlake.operators import clean, ranking, relate
from filmlake.operators.aggregate import row_counts as row_counts_of
from filmlake.operators.aggregate import yearly_ratings
from filmlake.operators.checks import key_violations, orphans, text_violations
from filmlake.plans import contracts, pipeline, star, views
from filmlake.schemas import FILMS, GENRES, TEXT_LIMITS, conform, conform_or_reject
from filmlake.sinks import (
    write_csv,
    write_json_array,
    write_json_lines,
    write_parquet,
    write_parquet_unless_empty,
)
from filmlake.sources import list_views, local_rows, read_films, read_genres
from filmlake.staging import discard, new_folder

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-01-01"
TITLE = "Order#42"
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """List a query under the name of its function."""
    QUERIES[run.__name__] = run
    return run


def _text_date(df: DataFrame, column: str = "data_lancamento") -> DataFrame:
    """Dates as text, which compares alike everywhere."""
    return df.withColumn(column, F.col(column).cast("string"))


# grouped measures and rankings


@query
def films_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return views.films_per_year(star.films(spark, folder, with_votes=False))


@query
def votes_by_language(spark: SparkSession, folder: str) -> DataFrame:
    return views.votes_by_language(star.films(spark, folder))


@query
def popularity_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return views.popularity_by_year(star.films(spark, folder, with_votes=False))


@query
def popularity_by_genre(spark: SparkSession, folder: str) -> DataFrame:
    return views.popularity_by_genre(star.by_genre(spark, folder))


@query
def yearly_genre_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return yearly_ratings(star.by_genre(spark, folder, with_votes=True))


@query
def rating_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return views.genre_rating_pattern(star.by_genre(spark, folder, with_votes=True))


@query
def top_films_by_genre(spark: SparkSession, folder: str) -> DataFrame:
    return views.top_films_by_genre(star.by_genre(spark, folder, with_votes=True), star.MIN_VOTES)


@query
def top_genres_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return views.top_genres_by_year(star.by_genre(spark, folder))


@query
def top_events_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Top-k over few, large groups with many equal values."""
    events = star.table(spark, folder, "events").select(
        "event_id", "event_type", F.round("value").alias("value")
    )
    return ranking.top_with_ties(events, ["event_type"], "value", 3)


@query
def top_lines_by_order(spark: SparkSession, folder: str) -> DataFrame:
    """Top-k over as many groups as there are orders."""
    lines = star.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ranking.top_with_ties(lines, ["l_orderkey"], "l_quantity", 2)


@query
def genres_text_per_film(spark: SparkSession, folder: str) -> DataFrame:
    return views.genres_text_per_film(star.by_genre(spark, folder))


# scans, counts and lookups


@query
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return views.table_sizes(star.silver(spark, folder, with_votes=False))


@query
def first_films(spark: SparkSession, folder: str) -> DataFrame:
    return _text_date(ranking.first_rows(star.films(spark, folder), 20, ["id"]))


@query
def first_genres(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_rows(star.genres(spark, folder), 20, ["id"])


@query
def first_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_rows(star.film_genres(spark, folder), 20, ["id_filme", "id_genero"])


@query
def schema_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Name and type of each column, and how many rows lack it."""
    orders = star.table(spark, folder, "orders")
    lacking = orders.select(*(F.count_if(F.col(name).isNull()).alias(name) for name in orders.columns))
    counts = lacking.unpivot([], orders.columns, "column_name", "null_count")
    return ranking.schema_rows(orders).join(counts, "column_name")


@query
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_rows(star.table(spark, folder, "documents"), 5, ["doc_id"])


@query
def genres_of_title(spark: SparkSession, folder: str) -> DataFrame:
    return views.genres_of_title(star.by_genre(spark, folder), TITLE)


@query
def genres_of_title_any_case(spark: SparkSession, folder: str) -> DataFrame:
    by_genre = star.by_genre(spark, folder)
    return views.genres_of_title(by_genre, TITLE.upper(), collation="UNICODE_CI_AI")


@query
def language_label(spark: SparkSession, folder: str) -> DataFrame:
    """Labels from the whole map, and from one that lacks most codes."""
    partial = {code: LANGUAGE_LABELS[code] for code in ("en", "fr")}
    return star.table(spark, folder, "documents").select(
        "doc_id",
        relate.label_of("lang").alias("label"),
        relate.label_of("lang", partial).alias("partial_label"),
    )


@query
def local_row_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Orders joined to a few rows held by the program."""
    labels = local_rows(
        spark, [("F", "filled"), ("O", "open"), ("P", "part")], "o_orderstatus string, label string"
    )
    return (
        star.table(spark, folder, "orders")
        .join(labels, "o_orderstatus")
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


@query
def sql_over_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The tables and results by name in SQL text, with nested CTEs."""
    silver = star.silver(spark, folder, with_votes=False)
    views.register_tables(silver)
    views.films_per_year(silver.films).createOrReplaceTempView("filmes_lancados_por_ano")
    return spark.sql("""
        WITH per_film AS (
            SELECT f.id, year(f.data_lancamento) AS ano, count(*) AS genre_count
            FROM filmes f JOIN filmes_generos b ON b.id_filme = f.id
            GROUP BY f.id, ano
        ), per_year AS (
            SELECT ano, max(genre_count) AS most_genres, count(*) AS with_genres
            FROM per_film GROUP BY ano
        )
        SELECT y.ano, y.numero_filmes, p.with_genres, p.most_genres
        FROM filmes_lancados_por_ano y JOIN per_year p ON p.ano = y.ano
    """)


# cleaning and unnesting


@query
def dedupe_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.table(spark, folder, "lineitem")
    kept = clean.keep_one(lines, ["l_orderkey"], ["l_extendedprice"])
    return _text_date(kept, "l_shipdate")


@query
def dedupe_any(spark: SparkSession, folder: str) -> DataFrame:
    """Any one line per order: how many are kept of each, and how many of these are whole lines of the input."""
    lines = star.table(spark, folder, "lineitem")
    row = F.xxhash64(*lines.columns).alias("row")
    kept = clean.keep_any(lines, ["l_orderkey"]).select("l_orderkey", row)
    given = lines.select(F.col("l_orderkey").alias("order"), row.alias("line")).distinct()
    found = kept.join(given, (F.col("l_orderkey") == F.col("order")) & (F.col("row") == F.col("line")), "left")
    return found.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("kept"), F.count("line").alias("whole"))


@query
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return relate.film_genre_pairs(star.raw_films(spark, folder), unique_ids=False)


@query
def clean_valid(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_films(star.raw_films(spark, folder), AS_OF).drop("genre_ids")


@query
def clean_after_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """A copy is chosen first, so a film may be lost to an invalid one."""
    raw = star.raw_films(spark, folder)
    return clean.clean_films(raw, AS_OF, strict_reference_order=True).drop("genre_ids")


@query
def cleaning_audit(spark: SparkSession, folder: str) -> DataFrame:
    return clean.cleaning_audit(star.raw_films(spark, folder), AS_OF)


@query
def explode_genres(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of clean records, whose ids are unique, without a shuffle of pairs."""
    return relate.film_genre_pairs(clean.clean_films(star.raw_films(spark, folder), AS_OF))


@query
def clean_by_genre(spark: SparkSession, folder: str) -> DataFrame:
    """Films by genre straight from the records; unknown genres drop out."""
    records = clean.clean_films(star.raw_films(spark, folder), AS_OF)
    return relate.records_by_genre(records, star.genres(spark, folder)).select(
        "id", "title", "id_genero", "genero"
    )


# joins and table contracts


def _genres_in(spark: SparkSession, folder: str, region: str, keep: bool) -> DataFrame:
    chosen = (F.col("r_name") == region) if keep else (F.col("r_name") != region)
    regions = star.table(spark, folder, "region").filter(chosen)
    nations = star.table(spark, folder, "nation")
    return nations.join(
        regions, nations["n_regionkey"] == regions["r_regionkey"], "left_semi"
    ).select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("genero"))


@query
def valid_genre_pairs(spark: SparkSession, folder: str) -> DataFrame:
    known = _genres_in(spark, folder, "ASIA", keep=True)
    return relate.matching(star.film_genres(spark, folder), "id_genero", known, "id")


@query
def no_valid_genres(spark: SparkSession, folder: str) -> DataFrame:
    """Without a known genre no pair is left, beside the number there were."""
    pairs = star.film_genres(spark, folder)
    known = _genres_in(spark, folder, "ATLANTIS", keep=True)
    left = relate.matching(pairs, "id_genero", known, "id")
    return relate.union_all([
        frame.agg(F.count(F.lit(1)).alias("pair_count")).select(F.lit(name).alias("step"), "pair_count")
        for name, frame in (("read", pairs), ("kept", left))
    ])


@query
def fk_violations(spark: SparkSession, folder: str) -> DataFrame:
    known = _genres_in(spark, folder, "ASIA", keep=False)
    return orphans(star.film_genres(spark, folder), "id_genero", known, "id")


@query
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return key_violations(star.table(spark, folder, "lineitem"), ["l_orderkey"])


@query
def composite_pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.table(spark, folder, "lineitem")
    return key_violations(lines, ["l_orderkey", "l_linenumber"])


@query
def length_violations(spark: SparkSession, folder: str) -> DataFrame:
    limits = {"text": 255, "source": 4, "lang": 50}
    return text_violations(star.table(spark, folder, "documents"), "doc_id", limits)


@query
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.contract_report(star.silver(spark, folder, with_votes=False))


@query
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    """A film table of texts, in another order, brought to its contract."""
    films = star.films(spark, folder)
    texts = films.select(*(F.col(name).cast("string") for name in reversed(films.columns)))
    return _text_date(conform(texts.withColumn("extra", F.lit("x")), FILMS))


@query
def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A film table with values that break its contract: rows kept, and rows rejected by column and reason."""
    films = star.films(spark, folder, with_votes=False).withColumn("total_votos", F.lit("1"))
    at = F.col("at")
    texts = films.withColumn("at", F.col("id")).select("at", *(F.col(name).cast("string") for name in films.columns))
    dirty = texts.withColumns({
        "id": F.when(at % 97 == 0, "x").when(at % 89 != 0, F.col("id")),
        "titulo": F.when(at % 83 == 0, F.repeat("titulo", 60)).otherwise(F.col("titulo")),
        "data_lancamento": F.when(at % 79 == 0, "2001-13-45").otherwise(F.col("data_lancamento")),
        "nota_media": F.when(at % 73 != 0, F.col("nota_media")).when(at % 2 == 0, "n/a"),
    })
    kept, rejected = conform_or_reject(dirty, FILMS, TEXT_LIMITS["films"])
    return relate.union_all([
        rejected.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("row_count")),
        kept.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("").alias("column_name"), F.lit("kept").alias("reason"), "row_count"
        ),
    ])


@query
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables with other column orders, one lacking a column."""
    customers = relate.renamed(
        star.table(spark, folder, "customer"),
        {
            "c_mktsegment": "segment",
            "c_custkey": "id",
            "c_nationkey": "nation",
            "c_name": "name",
            "c_acctbal": "balance",
        },
    )
    suppliers = relate.renamed(
        star.table(spark, folder, "supplier"),
        {"s_name": "name", "s_suppkey": "id", "s_acctbal": "balance", "s_nationkey": "nation"},
    )
    return relate.union_all([customers, suppliers])


# sorted extracts


@query
def sorted_page(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.sorted_page(
        star.catalogue(spark, folder), "primary_release_date.desc", first_page=3, pages=10
    )


@query
def extract_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The first two pages of each extract."""
    return ranking.union_of_extracts(star.catalogue(spark, folder), pages=2)


@query
def last_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The last page of each extract."""
    catalogue = star.catalogue(spark, folder)
    last = -(-catalogue.count() // ranking.PAGE_SIZE)
    return ranking.union_of_extracts(catalogue, pages=1, first_page=max(1, last))


@query
def union_of_extracts(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the catalogue with its position in each of thirteen orders."""
    return ranking.union_of_extracts(star.catalogue(spark, folder))


# sources and sinks, written and read back


@query
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records appended as JSON lines; blanks, NULLs and arrays survive."""
    path = new_folder(spark, "jsonl")
    write_json_lines(star.raw_films(spark, folder), path)
    return read_films(spark, path, "*.json").select(
        "id",
        "title",
        "original_language",
        "release_date",
        F.array_join("genre_ids", ",").alias("genre_ids"),
        "popularity",
        "vote_average",
        "vote_count",
    )


@query
def collected_extracts(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping extracts on disk, read as one table, settled to one row per id."""
    path = new_folder(spark, "extracts")
    pipeline.collect_extracts(star.catalogue(spark, folder), path)
    extracts = read_films(spark, path, "*.json").select("id", "title", "popularity", "vote_count")
    return clean.keep_one(extracts, ["id"], ["popularity"])


@query
def json_array_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "genres")
    genres = star.genres(spark, folder)
    write_json_array(genres.select(F.col("id").cast("string").alias("id"), "genero"), path)
    pairs = star.film_genres(spark, folder).groupBy("id_genero").agg(F.count(F.lit(1)).alias("film_count"))
    return read_genres(spark, path).join(pairs, F.col("id") == F.col("id_genero")).drop("id_genero")


@query
def json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """A table of many JSON documents."""
    path = new_folder(spark, "arrays")
    orders = star.table(spark, folder, "orders")
    write_json_array(
        orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("genero")),
        path,
        document_rows=1000,
    )
    return read_genres(spark, path)


@query
def empty_input(spark: SparkSession, folder: str) -> DataFrame:
    """Records counted by a file pattern that matches, and by one that does not."""
    path = new_folder(spark, "patterns")
    write_json_lines(star.raw_films(spark, folder), path)
    return row_counts_of({name: read_films(spark, path, name) for name in ("*.json", "*.none")})


@query
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Overwritten in three files, appended to, and left alone by an empty table."""
    path = new_folder(spark, "parquet")
    pairs = star.film_genres(spark, folder)
    write_parquet(pairs, path, num_files=3)
    write_parquet(pairs, path, mode="append")
    write_parquet_unless_empty(pairs.filter(F.lit(False)), path)
    return spark.read.schema(pairs.schema).parquet(path)


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, line breaks and quotes included, through CSV."""
    path = new_folder(spark, "csv")
    documents = star.table(spark, folder, "documents").select("doc_id", "text", "lang")
    write_csv(documents, path)
    return (
        spark.read.schema(documents.schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


# whole flows


def _sized_films(silver: views.Silver) -> DataFrame:
    """Films with the number and sum of the ids of their genres."""
    sizes = silver.film_genres.groupBy("id_filme").agg(
        F.count(F.lit(1)).alias("genre_count"), F.sum("id_genero").alias("genre_id_sum")
    )
    films = silver.films.join(sizes, F.col("id") == F.col("id_filme"), "left").drop("id_filme")
    return _text_date(films)


def _genre_file(spark: SparkSession, folder: str, root: str) -> str:
    genres = star.genres(spark, folder)
    write_json_array(genres.select(F.col("id").cast("string").alias("id"), "genero"), f"{root}/genres")
    return f"{root}/genres"


@query
def silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze JSON to silver tables, shown as films with the ids of their genres."""
    root = new_folder(spark, "bronze")
    write_json_lines(star.raw_films(spark, folder), f"{root}/films")
    genres = _genre_file(spark, folder, root)
    pipeline.build_silver(spark, f"{root}/films", genres, f"{root}/silver", as_of=AS_OF, pattern="*.json")
    discard(spark, f"{root}/films")
    return _sized_films(pipeline.read_silver(spark, f"{root}/silver"))


@query
def silver_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Records that come in two batches of files; the second adds only films the first lacks."""
    root = new_folder(spark, "batches")
    genres = _genre_file(spark, folder, root)
    for batch in (0, 1):
        write_json_lines(star.raw_films(spark, folder).filter(F.col("revenue") % 2 == batch), f"{root}/films")
        pipeline.append_silver(spark, f"{root}/films", genres, f"{root}/silver", as_of=AS_OF, pattern="*.json")
    return _sized_films(pipeline.read_silver(spark, f"{root}/silver"))


def _gold(spark: SparkSession, folder: str, root: str) -> DataFrame:
    silver = star.silver(spark, folder)
    write_parquet(conform(silver.films, FILMS), f"{root}/silver/films")
    write_parquet(conform(silver.genres, GENRES), f"{root}/silver/genres")
    write_parquet(silver.film_genres, f"{root}/silver/film_genres")
    return pipeline.build_gold(spark, f"{root}/silver", f"{root}/gold", min_votes=star.MIN_VOTES)


@query
def gold_export_status(spark: SparkSession, folder: str) -> DataFrame:
    """Silver tables to every named result as CSV; how each export went."""
    root = new_folder(spark, "lake")
    status = _gold(spark, folder, root)
    discard(spark, root)
    return status.drop("error")


# of each result, the columns that name a row and the one that is compared as a number
GOLD_COLUMNS = {
    "filmes_lancados_por_ano": (["ano"], "numero_filmes"),
    "padrao_avaliacao": (["genero", "numero_filmes", "ano_inicial", "ano_final"], "diferenca_medias"),
    "top_filmes_por_genero": (["genero", "titulo", "ranking"], "nota_media"),
    "top_generos_por_ano": (["ano", "rank_do_genero", "genero"], "media_nota_ano"),
    "popularidade_vs_nota_media": (["titulo", "nota_media", "generos"], "popularidade"),
    "popularidade_por_ano": (["ano", "qtd_filmes"], "media_popularidade"),
    "generos_por_popularidade": (["genero", "qtd_filmes"], "media_popularidade"),
}


@query
def gold_contents(spark: SparkSession, folder: str) -> DataFrame:
    """What the CSV files of every result hold."""
    root = new_folder(spark, "contents")
    _gold(spark, folder, root)
    parts = []
    for name, (labels, number) in GOLD_COLUMNS.items():
        schema = spark.table(name).schema
        rows = spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{root}/gold/{name}")
        texts = (F.round(c, 2) if schema[c].dataType.typeName() == "double" else F.col(c) for c in labels)
        parts.append(rows.select(
            F.lit(name).alias("result"),
            F.concat_ws("|", *(text.cast("string") for text in texts)).alias("label"),
            F.col(number).cast("double").alias("number"),
        ))
    return relate.union_all(parts)


# of each sorted result, the column it falls by
GOLD_ORDER = {
    "popularidade_por_ano": "media_popularidade",
    "generos_por_popularidade": "media_popularidade",
    "popularidade_vs_nota_media": "popularidade",
}


@query
def gold_order(spark: SparkSession, folder: str) -> DataFrame:
    """Of each sorted result, the rows in its CSV files, and those that stand below a smaller value."""
    root = new_folder(spark, "order")
    _gold(spark, folder, root)
    parts = []
    for name, number in GOLD_ORDER.items():
        schema = spark.table(name).schema
        rows = spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{root}/gold/{name}")
        placed = rows.select(
            F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"), F.col(number).alias("value")
        )
        in_file = Window.partitionBy("file").orderBy("at")
        by_file = placed.withColumn("above", F.lag("value").over(in_file)).groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("above") < F.col("value")).alias("astray"),
            F.max_by("value", F.struct(-F.col("at"))).alias("first"),
            F.max_by("value", "at").alias("last"),
        )
        # files follow each other by name; there are few
        before = F.lag("last").over(Window.orderBy("file"))
        parts.append(
            by_file.withColumn("step", F.when(before < F.col("first"), 1).otherwise(0))
            .agg(F.sum("rows").alias("row_count"), F.sum(F.col("astray") + F.col("step")).alias("astray"))
            .select(F.lit(name).alias("result"), "row_count", "astray")
        )
    return relate.union_all(parts)


@query
def export_without_views(spark: SparkSession, folder: str) -> DataFrame:
    """How many views an export of none, and one of a single view, report, and the rows of these."""
    view = "export_alone"
    star.table(spark, folder, "orders").groupBy("o_orderpriority").count().createOrReplaceTempView(view)
    root = new_folder(spark, "alone")
    out = relate.union_all([
        pipeline.export_views(spark, root, names)
        .agg(F.count(F.lit(1)).alias("views"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
        .select(F.lit(len(names)).alias("given"), "views", "row_count")
        for names in ([], [view])
    ])
    spark.catalog.dropTempView(view)
    discard(spark, root)
    return out


@query
def export_isolation(spark: SparkSession, folder: str) -> DataFrame:
    """A view that fails while it is exported, and one beside it that does not."""
    orders = star.table(spark, folder, "orders")
    made = {
        "isolated_fails": orders.select(F.col("o_orderpriority").cast("int").alias("number")),
        "isolated_works": orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders")),
    }
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    root = new_folder(spark, "isolation")
    names = [name for name in list_views(spark) if name in made]
    status = pipeline.export_views(spark, root, names)
    for name in made:
        spark.catalog.dropTempView(name)
    discard(spark, root)
    return status.drop("error")
