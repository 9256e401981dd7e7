"""Cleaning: edge records, the surviving copy, the audit."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmlake.functions.predicates import DATE_FORMAT, is_valid_film, parsed_date
from filmlake.operators.clean import clean_films, cleaning_audit, keep_any, keep_one, with_checks
from filmlake.operators.relate import film_genre_pairs, films_of, matching
from filmlake.schemas import FILM_RAW

AS_OF = "2026-01-01"
# id, title, language, date, genres, popularity, rating, votes
EDGES = [
    (1, "A", "en", "1999-03-31", [28, 878], 1.5, 8.0, 10),
    (1, "A", "en", "1999-03-31", [28, 878], 1.5, 8.0, 10),
    (2, "B", "zz", "2001-01-01", [], None, None, None),
    (3, "  ", "fr", "2001-01-01", [18], 1.0, 5.0, 1),
    (4, "D", "fr", "", [18], 1.0, 5.0, 1),
    (5, "E", "fr", "2999-01-01", [18], 1.0, 5.0, 1),
    (6, "F", "fr", "2001-02-01", None, 1.0, 5.0, 1),
    (7, "G", "cn", "2026-01-01", [18, 18], 1.0, 5.0, 1),
    (8, "H", "zh", "2001-13-45", [18], 1.0, 5.0, 1),
    (9, "I", "de", None, [99], 9.0, 5.0, 3),
    (9, "I", "de", "2000-05-05", [99], 1.0, 5.0, 3),
    (10, "J", "it", "2000-01-01", [28, 424242], 1.0, 5.0, 5),
    (11, None, "pt", "2000-01-01", [35], 1.0, 5.0, 2),
]


def record(edge) -> tuple:
    id_, title, language, date, genres, popularity, rating, votes = edge
    return (id_, title, title, language, date, genres, popularity, 0, rating, votes)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([record(edge) for edge in EDGES], FILM_RAW)


def test_which_films_live(raw):
    kept = {row["id"]: row for row in clean_films(raw, AS_OF).collect()}
    assert sorted(kept) == [1, 2, 7, 9, 10]
    assert (kept[2]["vote_count"], kept[2]["vote_average"], kept[2]["popularity"]) == (0, 0.0, None)
    assert kept[9]["release_date"] == "2000-05-05"


def test_copy_chosen_before_validity(raw):
    kept = clean_films(raw, AS_OF, strict_reference_order=True)
    assert sorted(row["id"] for row in kept.collect()) == [1, 2, 7, 10]


def test_film_table(raw):
    films = {row["id"]: row for row in films_of(clean_films(raw, AS_OF)).collect()}
    assert films[7]["idioma_original"] == "Chinês"
    assert films[2]["idioma_original"] is None
    assert films[1]["data_lancamento"] == dt.date(1999, 3, 31)


def test_pairs(spark, raw, rows):
    pairs = film_genre_pairs(clean_films(raw, AS_OF))
    assert rows(pairs) == sorted(
        [(1, 28), (1, 878), (7, 18), (9, 99), (10, 28), (10, 424242)], key=repr
    )
    known = spark.createDataFrame([(28,), (878,), (18,), (99,)], "id long")
    assert (10, 424242) not in rows(matching(pairs, "id_genero", known, "id"))
    assert rows(matching(pairs, "id_genero", known.limit(0), "id")) == []


def test_pairs_of_repeated_ids(raw, rows):
    pairs = film_genre_pairs(raw, unique_ids=False)
    assert rows(pairs) == rows(pairs.distinct())
    assert (1, 28) in rows(pairs)


def test_audit(raw):
    assert cleaning_audit(raw, AS_OF).first().asDict() == {
        "rows_in": 13,
        "rows_valid": 6,
        "no_id": 0,
        "no_title": 2,
        "no_genres": 1,
        "no_date": 2,
        "bad_date": 1,
        "future_date": 1,
    }


def test_default_day_is_today(spark):
    tomorrow = (dt.date.today() + dt.timedelta(days=2)).isoformat()
    edges = [(1, "A", "en", tomorrow, [1], 1.0, 1.0, 1), (2, "B", "en", "2020-01-01", [1], 1.0, 1.0, 1)]
    raw = spark.createDataFrame([record(edge) for edge in edges], FILM_RAW)
    assert [row["id"] for row in clean_films(raw).collect()] == [2]


def test_date_spelling(spark):
    texts = spark.createDataFrame([("2001",), ("2001-02-03",), ("x",), (None,)], "t string")
    strict = [row[0] for row in texts.select(parsed_date("t")).collect()]
    assert strict == [None, dt.date(2001, 2, 3), None, None]
    lenient = [row[0] for row in texts.select(parsed_date("t", None)).collect()]
    assert lenient == [dt.date(2001, 1, 1), dt.date(2001, 2, 3), None, None]


DATE_TEXTS = st.one_of(
    st.dates(dt.date(1, 1, 1)).map(str),
    st.from_regex(r"[ +0-9]?[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}[ T\n]?", fullmatch=True),
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(texts=st.lists(DATE_TEXTS, min_size=50, max_size=200))
def test_date_shape_and_cast_equal_the_formatter(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").filter("t NOT LIKE '0000%'")
    both = df.select("t", parsed_date("t").alias("a"), F.try_to_date("t", "yyyy-MM-dd").alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


ROWS = st.lists(
    st.tuples(
        st.integers(0, 4),
        st.one_of(st.none(), st.sampled_from([0.5, 1.0, 2.0])),
        st.one_of(st.none(), st.sampled_from(["a", "b", "ç"])),
    ),
    min_size=1,
    max_size=30,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=ROWS, seed=st.integers(0, 9))
def test_keep_one_is_settled_by_content(spark, rows, data, seed):
    """Same survivors for any order and split; keeping again changes nothing."""
    shuffled = random.Random(seed).sample(data, len(data))
    schema = "id int, score double, name string"
    one = keep_one(spark.createDataFrame(data, schema).coalesce(1), ["id"], ["score"])
    other = keep_one(spark.createDataFrame(shuffled, schema).repartition(5), ["id"], ["score"])
    expected = {}
    for row in data:
        rank = (row[1] is not None, row[1] or 0, row[2] is not None, row[2] or "")
        if row[0] not in expected or rank > expected[row[0]][0]:
            expected[row[0]] = (rank, row)
    assert rows(one) == rows(other) == sorted((v[1] for v in expected.values()), key=repr)
    assert rows(keep_one(one, ["id"], ["score"])) == rows(one)


def test_keep_one_with_a_third_of_all_rows_on_one_key(spark):
    ids = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        (F.col("id") * 7919 % 10_007).alias("score"),
    )
    kept = {row["id"]: row["score"] for row in keep_one(ids, ["id"], ["score"]).collect()}
    assert len(kept) == 40_001
    assert kept[0] == max(i * 7919 % 10_007 for i in range(0, 60_000, 3))
    assert keep_any(ids, ["id"]).count() == 40_001


def test_checks_are_the_rules_of_a_valid_film(spark):
    """Every mix of what a record may lack, against the predicate itself, by day and by date format."""
    ids, titles, genres = (None, 1), (None, " ", "t"), (None, [], [1])
    dates = (None, "", "  ", "2000-01-01", "2001-01-01", "2001-01-02", "2001-02-30", "2001", "x", "2001-01-01 ")
    data = [(i, t, g, d) for i in ids for t in titles for g in genres for d in dates]
    raw = spark.createDataFrame(data, "id long, title string, genre_ids array<long>, release_date string")
    for as_of, date_format in (("2001-01-01", DATE_FORMAT), ("2001-01-01", None), (None, DATE_FORMAT), (None, "yyyy")):
        checked = with_checks(raw, as_of, date_format).withColumn("_told", is_valid_film(as_of, date_format))
        assert checked.filter(~F.col("_valid").eqNullSafe(F.col("_told"))).count() == 0
        assert 0 < checked.filter("_valid").count() < len(data)


def test_records_known_as_valid_are_not_read_again(spark, plan):
    raw = spark.createDataFrame(
        [(1, "t", [1], "2000-01-01", 1.0, None, None), (1, "u", [1], "2000-01-01", 2.0, 5.0, 7)],
        "id long, title string, genre_ids array<long>, release_date string, popularity double, "
        "vote_average double, vote_count long",
    )
    found = clean_films(raw, "2001-01-01", all_valid=True)
    assert "RLIKE" not in plan(found)
    assert found.collect() == clean_films(raw, "2001-01-01").collect()
