"""Bronze to silver, silver to gold, and the optional relational copy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filmlake import snapshots
from filmlake.functions.languages import LANGUAGE_LABELS
from filmlake.functions.predicates import DATE_FORMAT
from filmlake.operators.clean import audit_columns, clean_films, corrupt_column, with_checks
from filmlake.operators.ranking import EXTRACTS, PAGE_SIZE, union_of_extracts
from filmlake.operators.relate import film_genre_pairs, films_of, matching
from filmlake.plans.views import MIN_VOTES, TOP, Silver, register_tables, register_views
from filmlake.schemas import FILM_GENRES, FILM_RAW, FILMS, GENRES, conform
from filmlake.sinks import (
    write_csv,
    write_jdbc,
    write_json_lines,
    write_parquet,
)
from filmlake.sources import FILM_FILES, SOURCES, list_files, list_views, read_films, read_genres
from filmlake.staging import discard, new_folder, stage

EXPORT_STATUS = "name string, ok boolean, row_count long, error string"


def collect_extracts(
    catalogue: DataFrame,
    folder: str,
    sort_keys=EXTRACTS,
    pages: int | None = None,
    page_size: int = PAGE_SIZE,
) -> int:
    """Append extracts of the catalogue, one per sort key; rows written.

    Extracts of some pages are folders of their own. They overlap, and so do repeated
    collections; ``build_silver`` settles that. Whole extracts all hold the same rows, so without
    ``pages`` the catalogue is written once, each row with the list of the extracts it is in.
    """
    if pages is None:
        tags = F.array(*map(F.lit, sort_keys))
        return write_json_lines(catalogue.withColumn("extracts", tags), folder)
    extracts = union_of_extracts(catalogue, sort_keys, pages, page_size)
    return write_json_lines(extracts, folder, split_by="extract")


def _written(df: DataFrame, silver: str, table: str, num_files: int | None = None) -> tuple[str, int]:
    """Rows of a table in a folder that no version names yet; its name and the rows written."""
    name, path = snapshots.new_table(silver, table)
    return name, write_parquet(df, path, num_files=num_files)


def _valid_records(
    spark: SparkSession, films, pattern: str, as_of, date_format: str | None, scratch: str
) -> tuple[DataFrame, dict[str, int]]:
    """Valid raw records, staged, and the audit of all of them.

    The job has no shuffle, so the audit it counts is exact even when tasks run twice. Observed counts are
    interpreted row by row, so they get the outcome of each rule and not the rule.
    """
    audit = Observation()
    raw = read_films(spark, films, pattern).drop("source_file")
    checked = with_checks(raw, as_of, date_format).observe(audit, *audit_columns(), corrupt_column())
    valid = checked.filter("_valid").select(*FILM_RAW.names)
    return stage(valid, f"{scratch}/valid"), audit.get


def build_silver(
    spark: SparkSession,
    film_folder: str,
    genre_file: str,
    silver: str,
    as_of: dt.date | str | None = None,
    pattern: str = FILM_FILES,
    labels: Mapping[str, str] = LANGUAGE_LABELS,
    date_format: str | None = DATE_FORMAT,
    film_files: int | None = None,
    pair_files: int | None = None,
) -> dict[str, int]:
    """Bronze JSON to a new version of the tables ``films``, ``genres`` and ``film_genres``.

    The JSON is parsed once, and its valid records are staged. The clean
    records are staged too: the duplicates are settled once, and films and pairs
    come from the same survivors without a further shuffle.

    The tables are written beside the present ones and become current together, in one step
    (see ``filmlake.snapshots``); the version also knows which files it was read from. Without a valid
    film, or when a build fails, the present version stays. Two older versions stay readable.
    Returns the audit, and the rows of each table that was built.
    """
    scratch = new_folder(spark, "silver")
    base = snapshots.current(spark, silver) or snapshots.Snapshot(silver)
    made: list[str] = []
    try:
        sources = stage(list_files(spark, film_folder, pattern), f"{scratch}/sources")
        genres, report = conform(read_genres(spark, genre_file), GENRES), {}
        name, report["genres"] = _written(genres, silver, "genres")
        made.append(name)
        valid, audit = _valid_records(spark, film_folder, pattern, as_of, date_format, scratch)
        report |= audit
        if report["rows_valid"] == 0:
            return report | {"films": 0, "film_genres": 0}

        records = stage(clean_films(valid, as_of, date_format, all_valid=True), f"{scratch}/records")
        films = conform(films_of(records, labels, date_format), FILMS)
        name, report["films"] = _written(films, silver, "films", film_files)
        made.append(name)
        genres = spark.read.schema(GENRES).parquet(f"{silver}/tables/{made[0]}")
        pairs = matching(film_genre_pairs(records), "id_genero", genres, "id")
        name, report["film_genres"] = _written(conform(pairs, FILM_GENRES), silver, "film_genres", pair_files)
        made.append(name)
        made.append(_written(sources, silver, "sources")[0])
        snapshots.commit(spark, base, {x.rpartition("-")[0]: [x] for x in made})
        made.clear()
        snapshots.expire(spark, silver)
        report["rows_removed"] = report["rows_in"] - report["films"]
        return report
    finally:
        discard(spark, scratch)
        for name in made:
            discard(spark, f"{silver}/tables/{name}")


def append_silver(
    spark: SparkSession,
    film_folder: str,
    genre_file: str,
    silver: str,
    as_of: dt.date | str | None = None,
    pattern: str = FILM_FILES,
    labels: Mapping[str, str] = LANGUAGE_LABELS,
    date_format: str | None = DATE_FORMAT,
) -> dict[str, int]:
    """Add to the silver tables what files that no version has read yet hold.

    Only new files are opened; one that has changed since counts as new. A film or genre whose id is
    there already is not added, so the first one stays, as a primary key would have it. Pairs are
    those of the added films, with any genre known by now. Earlier folders stay as they are: the new
    version names them and one more for each table. Without a version yet this is ``build_silver``.
    Returns the audit of the new files, their number, and the rows added to each table.
    """
    base = snapshots.current(spark, silver)
    if base is None:
        return build_silver(spark, film_folder, genre_file, silver, as_of, pattern, labels, date_format)
    scratch = new_folder(spark, "silver")
    made: dict[str, str] = {}
    try:
        listed = list_files(spark, film_folder, pattern)
        known = base.read(spark, "sources", SOURCES)
        sources = stage(listed.join(known, SOURCES.names, "left_anti"), f"{scratch}/sources")
        paths = [row.path for row in sources.select("path").collect()]  # the reader takes names
        report = {"files": len(paths)}

        def added(rows: DataFrame, table: str, schema, key: str) -> DataFrame:
            """Rows whose key the table lacks; the keys of the few new rows go to the many old ones."""
            old = base.read(spark, table, schema).select(F.col(key).alias("_key"))
            there = old.join(rows.select(F.col(key).alias("_key")), "_key", "left_semi").distinct()
            return rows.join(there, rows[key] == there["_key"], "left_anti")

        genres = added(conform(read_genres(spark, genre_file), GENRES).dropDuplicates(["id"]), "genres", GENRES, "id")
        made["genres"], report["genres"] = _written(genres, silver, "genres")
        report["films"] = report["film_genres"] = 0
        if paths:
            valid, audit = _valid_records(spark, paths, pattern, as_of, date_format, scratch)
            report |= audit
            records = stage(added(clean_films(valid, as_of, date_format, all_valid=True), "films", FILMS, "id"), f"{scratch}/records")
            films = conform(films_of(records, labels, date_format), FILMS)
            made["films"], report["films"] = _written(films, silver, "films")
            genres = base.read(spark, "genres", GENRES).union(
                spark.read.schema(GENRES).parquet(f"{silver}/tables/{made['genres']}")
            )
            pairs = matching(film_genre_pairs(records), "id_genero", genres, "id")
            made["film_genres"], report["film_genres"] = _written(conform(pairs, FILM_GENRES), silver, "film_genres")
            made["sources"], _ = _written(sources, silver, "sources")
        if not paths and not report["genres"]:
            return report
        # a folder without rows is left out of the version
        grown = {name: [made[name]] for name in made if report.get(name, 1)}
        snapshots.commit(spark, base, {
            name: [*base.tables.get(name, ()), *grown.get(name, ())] for name in {*base.tables, *grown}
        })
        for name in grown:
            del made[name]
        snapshots.expire(spark, silver)
        return report
    finally:
        discard(spark, scratch)
        for name in made.values():
            discard(spark, f"{silver}/tables/{name}")


SILVER_SCHEMAS = {"films": FILMS, "genres": GENRES, "film_genres": FILM_GENRES, "sources": SOURCES}


def compact_silver(spark: SparkSession, silver: str) -> dict[str, int]:
    """A version with the same rows, each table in one folder again; rows of each."""
    base = snapshots.current(spark, silver)
    if base is None:
        raise ValueError(f"{silver} has no version")
    made = {name: _written(base.read(spark, name, SILVER_SCHEMAS[name]), silver, name) for name in base.tables}
    try:
        snapshots.commit(spark, base, {name: [folder] for name, (folder, _) in made.items()})
    except snapshots.Conflict:
        for folder, _ in made.values():
            discard(spark, f"{silver}/tables/{folder}")
        raise
    snapshots.expire(spark, silver)
    return {name: rows for name, (_, rows) in made.items()}


def read_silver(spark: SparkSession, silver: str) -> Silver:
    """The current version of the tables; plain Parquet folders of their names where there are no versions."""
    version = snapshots.current(spark, silver)
    if version is None:
        return Silver(
            films=spark.read.schema(FILMS).parquet(f"{silver}/films"),
            genres=spark.read.schema(GENRES).parquet(f"{silver}/genres"),
            film_genres=spark.read.schema(FILM_GENRES).parquet(f"{silver}/film_genres"),
        )
    return Silver(*(version.read(spark, name, SILVER_SCHEMAS[name]) for name in ("films", "genres", "film_genres")))


def join_silver(spark: SparkSession, tables: Silver) -> Silver:
    """Write films joined to their genres once, for the five results that use it.

    The views read that table, so it goes when the session's driver ends.
    """
    written = stage(tables.by_genre, f"{new_folder(spark, 'gold')}/films_by_genre")
    return Silver(tables.films, tables.genres, tables.film_genres, written)


def export_views(spark: SparkSession, gold: str, names: list[str] | None = None) -> DataFrame:
    """Each view of the session, or each of ``names``, to a CSV dataset of its name.

    A view that fails does not stop the others. Returns name, success, rows and
    error of each; without views, an empty table.
    """
    status = []
    for name in list_views(spark) if names is None else names:
        try:
            rows = write_csv(spark.table(name), f"{gold}/{name}")
            status.append((name, True, rows, None))
        except Exception as error:  # noqa: BLE001 - reported, not hidden
            status.append((name, False, None, str(error)))
    return spark.createDataFrame(status, EXPORT_STATUS)


def build_gold(
    spark: SparkSession, silver: str, gold: str, min_votes: int = MIN_VOTES, k: int = TOP
) -> DataFrame:
    """Silver tables to named views and one CSV dataset per view; export status."""
    tables = join_silver(spark, read_silver(spark, silver))
    register_tables(tables)
    return export_views(spark, gold, register_views(tables, min_votes, k))


def load_relational(
    tables: Silver,
    url: str,
    properties: Mapping[str, str],
    writers: int,
    batch_size: int = 1000,
    timeout: int = 3600,
) -> None:
    """Append the silver tables to a relational schema, parents before the bridge."""
    write_jdbc(tables.genres, url, "generos", properties)
    for name in ("filmes", "filmes_generos"):
        write_jdbc(tables.tables()[name], url, name, properties, batch_size, timeout, writers)
