"""Projection, lookup, joins, unions and contract checks."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from filmlake.functions.languages import LANGUAGE_LABELS
from filmlake.operators import relate
from filmlake.operators.checks import key_violations, text_violations
from filmlake.plans.contracts import contract_report, violations
from filmlake.plans.views import Silver, genres_of_title
from filmlake.schemas import FILM_GENRES, FILMS, GENRES, TEXT_LIMITS, conform, conform_or_reject


@pytest.fixture
def silver(spark):
    day = dt.date(2000, 1, 1)
    films = [(i, t, "Inglês", day, 1.0, 5.0, 10) for i, t in ((1, "Ação"), (2, "B"), (3, "C"))]
    return Silver(
        spark.createDataFrame(films, FILMS),
        spark.createDataFrame([(28, "Ação"), (18, "Drama")], GENRES),
        spark.createDataFrame([(1, 28), (1, 18), (2, 18)], FILM_GENRES),
    )


def test_label_of_every_code(spark):
    codes = [*LANGUAGE_LABELS, "??", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = {r["code"]: r["label"] for r in df.select("code", relate.label_of("code").alias("label")).collect()}
    assert got == {**LANGUAGE_LABELS, "??": None, None: None}
    assert len(LANGUAGE_LABELS) == 124
    assert got["cn"] == got["zh"] == "Chinês"


def test_unnest_skips_null_and_empty(spark, rows):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None)], "id long, a array<long>")
    assert rows(relate.unnest(df, "a", "x")) == [(1, 5), (1, 6)]


def test_films_by_genre_drops_films_without_one(silver, rows):
    assert rows(silver.by_genre.select("id", "genero")) == [(1, "Ação"), (1, "Drama"), (2, "Drama")]


def test_both_ways_to_films_by_genre(spark, silver, rows):
    records = spark.createDataFrame([(1, [28, 18, 28]), (2, [18]), (3, [])], "id long, genre_ids array<long>")
    direct = relate.records_by_genre(records, silver.genres)
    assert rows(direct.select("id", "id_genero", "genero")) == rows(
        silver.by_genre.select("id", "id_genero", "genero")
    )


def test_title_by_bytes_and_by_collation(silver):
    assert genres_of_title(silver.by_genre, "Ação").count() == 2
    assert genres_of_title(silver.by_genre, "acao").count() == 0
    assert genres_of_title(silver.by_genre, "acao", "UNICODE_CI_AI").count() == 2


def test_matching_and_orphans_part_the_rows(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 10)], "id long, k long")
    parent = spark.createDataFrame([(10,), (10,), (20,)], "p long")
    assert rows(relate.matching(child, "k", parent, "p")) == [(1, 10), (4, 10)]
    assert rows(relate.orphans(child, "k", parent, "p")) == [(2, 99)]
    assert rows(relate.matching(child, "k", parent.limit(0), "p")) == []


def test_union_goes_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    b = spark.createDataFrame([("y", 2)], "t string, id long")
    c = spark.createDataFrame([(3,)], "id long")
    assert rows(relate.union_all([a, b, c])) == [(1, "x"), (2, "y"), (3, None)]


def test_renamed_prunes(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a long, b string, c double")
    assert relate.renamed(df, {"c": "z", "a": "y"}).columns == ["z", "y"]


def test_key_violations(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (2, None)], "a long, b long")
    assert rows(key_violations(df, ["a"])) == sorted([(1, 3), (None, 1)], key=repr)
    assert rows(key_violations(df, ["a", "b"])) == sorted([(1, 1, 2), (None, 3, 1), (2, None, 1)], key=repr)


def test_text_violations_count_characters(spark, rows):
    df = spark.createDataFrame([(1, "çççç", "ab"), (2, "ç" * 5, "abc"), (3, None, None)], "id long, t string, u string")
    assert rows(text_violations(df, "id", {"t": 4, "u": 2})) == [(2, "t", 5, 4), (2, "u", 3, 2)]


def test_sound_tables_have_no_violations(silver):
    assert {r["violations"] for r in contract_report(silver).collect()} == {0}


def test_each_contract_can_break(spark, silver):
    day = dt.date(2000, 1, 1)
    films = silver.films.union(
        spark.createDataFrame([(1, "x" * 256, "y" * 51, day, 1.0, 1.0, 1)], FILMS)
    )
    genres = silver.genres.union(spark.createDataFrame([(28, "z" * 26)], GENRES))
    pairs = silver.film_genres.union(
        spark.createDataFrame([(1, 28), (77, 28), (1, 88)], FILM_GENRES)
    )
    found = {name: df.count() for name, df in violations(Silver(films, genres, pairs)).items()}
    assert found == {
        "films key": 1,
        "genres key": 1,
        "film_genres key": 1,
        "films text": 2,
        "genres text": 1,
        "film_genres to films": 1,
        "film_genres to genres": 1,
    }


def test_conform(spark):
    df = spark.createDataFrame([("Drama", "18", 1)], "genero string, id string, extra int")
    assert conform(df, GENRES).dtypes == [("id", "bigint"), ("genero", "string")]
    with pytest.raises(AnalysisException):
        conform(df.drop("genero"), GENRES)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df.withColumn("id", F.lit("x")), GENRES).collect()


def test_the_report_counts_the_offending_rows(spark):
    """Random broken tables: missing, repeated and unknown keys, long texts."""
    rng = random.Random(3)
    for _ in range(3):
        ids = [None, *range(6)]
        text = lambda most: "x" * rng.choice([0, most, most + 1])
        films = [(rng.choice(ids), text(255), text(50), None, None, None, None) for _ in range(rng.randint(0, 9))]
        genres = [(rng.choice(ids), text(25)) for _ in range(rng.randint(0, 6))]
        pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(rng.randint(0, 20))]
        frames = [
            spark.createDataFrame(data, StructType([StructField(f.name, f.dataType) for f in schema]))
            for data, schema in ((films, FILMS), (genres, GENRES), (pairs, FILM_GENRES))
        ]
        silver = Silver(*frames)
        expected = {name: df.count() for name, df in violations(silver).items()}
        assert {r["contract"]: r["violations"] for r in contract_report(silver).collect()} == expected


def test_the_report_scans_each_table_once(spark, plan):
    sf = "/root/testdata/sf0.001"
    frames = [
        spark.read.parquet(f"{sf}/{table}.parquet").select(*(F.col(a).cast(b).alias(c) for a, b, c in columns))
        for table, columns in (
            ("orders", [("o_orderkey", "long", "id"), ("o_orderpriority", "string", "titulo"), ("o_orderstatus", "string", "idioma_original")]),
            ("nation", [("n_nationkey", "long", "id"), ("n_name", "string", "genero")]),
            ("lineitem", [("l_orderkey", "long", "id_filme"), ("l_suppkey", "long", "id_genero")]),
        )
    ]
    frames[0] = frames[0].withColumn("x", F.lit(1))
    text = plan(contract_report(Silver(*frames, by_genre=frames[0])))
    assert text.count("FileScan") == 3
    assert text.count("Exchange hashpartitioning") == 1


def test_rows_that_break_a_contract_are_told(spark, rows):
    df = spark.createDataFrame(
        [("1", "a"), ("x", "b"), (None, None), ("2", "y" * 26), ("z", "y" * 26)], "id string, genero string"
    ).withColumn("extra", F.lit(1))
    kept, rejected = conform_or_reject(df, GENRES, TEXT_LIMITS["genres"])
    assert rows(kept) == [(1, "a")]
    assert kept.schema == conform(df, GENRES).schema
    assert rows(rejected.select("column_name", "reason", "value")) == sorted([
        ("id", "does not cast", "x"), ("id", "NULL", None), ("genero", "too long", "y" * 26),
        ("id", "does not cast", "z"), ("genero", "too long", "y" * 26),
    ], key=repr)
    record = rejected.filter("value = 'x'").first()["record"]
    assert json.loads(record) == {"id": "x", "genero": "b", "extra": 1}
    assert rows(conform_or_reject(df, GENRES)[0]) == [(1, "a"), (2, "y" * 26)]
