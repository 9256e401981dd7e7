"""Top-k with ties, first rows, pages and extracts."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmlake.operators import ranking
from filmlake.plans.views import top_films_by_genre, top_genres_by_year

def films(spark, rated):
    return spark.createDataFrame(
        [(i, f"t{i}", genre, rating, 1000) for i, (genre, rating) in enumerate(rated)],
        "id long, titulo string, genero string, nota_media double, total_votos long",
    )


def test_rank_on_the_unrounded_rating(spark):
    got = top_films_by_genre(films(spark, [("g", 8.504), ("g", 8.496)])).collect()
    assert sorted((r["nota_media"], r["ranking"]) for r in got) == [(8.5, 1), (8.5, 2)]


def test_gap_after_a_tie(spark):
    got = top_films_by_genre(films(spark, [("g", 8.5), ("g", 8.5), ("g", 8.4), ("g", 8.3)])).collect()
    assert sorted(r["ranking"] for r in got) == [1, 1, 3]


def test_all_ties_at_the_last_place(spark):
    rated = [("g", 9.0), ("g", 8.9)] + [("g", 8.4)] * 4 + [("g", 8.3)]
    got = top_films_by_genre(films(spark, rated)).collect()
    assert sorted(r["ranking"] for r in got) == [1, 2, 3, 3, 3, 3]


def test_threshold_is_strict(spark):
    df = films(spark, [("g", 9.0)]).withColumn("total_votos", F.lit(500).cast("long"))
    assert top_films_by_genre(df).count() == 0
    assert top_films_by_genre(df, min_votes=499).count() == 1


def test_genres_ranked_on_the_rounded_mean(spark):
    df = films(spark, [("a", 6.04), ("b", 5.96), ("c", 5.0), ("d", 4.0)]).withColumn(
        "data_lancamento", F.lit("2000-05-05").cast("date")
    )
    got = {r["genero"]: r["rank_do_genero"] for r in top_genres_by_year(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def brute_top(data, k):
    kept = []
    for group, value in data:
        better = sum(
            1 for g, v in data if g == group and v is not None and (value is None or v > value)
        )
        if better + 1 <= k:
            kept.append((group, value, better + 1))
    return sorted(kept, key=repr)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    data=st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from("xy")),
            st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 7.0])),
        ),
        min_size=1,
        max_size=25,
    ),
    k=st.integers(1, 4),
)
def test_top_with_ties_is_the_rank_window(spark, rows, data, k):
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    expected = brute_top(data, k)
    assert rows(ranking.top_with_ties(df, ["g"], "v", k)) == expected
    assert rows(ranking.ranked_top(df, ["g"], "v", k)) == expected


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_a_third_of_all_rows_tied_in_one_group(spark, setting, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 3 == 0, 10.0).otherwise((F.col("id") % 997).cast("double")).alias("v"),
    )
    got = ranking.top_with_ties(df, ["g"], "v", 3)
    assert got.filter("g = 'hot'").count() == 30_000
    assert got.exceptAll(ranking.ranked_top(df, ["g"], "v", 3)).count() == 0
    assert got.count() == ranking.ranked_top(df, ["g"], "v", 3).count()


def test_candidates_are_counted_without_a_hash_map(spark, plan):
    """Over many small groups nearly every row is a candidate, and a map of them took most of a task's memory."""
    df = spark.range(100).select((F.col("id") % 40).alias("g"), F.col("id").alias("line"), (F.col("id") % 7).alias("v"))
    found = ranking.top_with_ties(df, ["g"], "v", 2)
    text = plan(found)
    assert "Aggregate" not in text
    # one sort before the shuffle and one after it, for each side; one for the places of all parts
    assert text.count("+- Sort [") <= 5
    expected = ranking.ranked_top(df, ["g"], "v", 2)
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 2000])
def test_places_of_odd_values_and_whole_copies(spark, k):
    """Zeros of both signs are one value, so are all NaN and all NULL; rows may come many times."""
    values = [0.0, -0.0, float("nan"), None, 1.5, float("inf")]
    data = [(g, v, i % 2) for i in range(9) for g in ("a", "b", None) for v in values]
    df = spark.createDataFrame(data, "g string, v double, line int").repartition(5)
    found, expected = ranking.top_with_ties(df, ["g"], "v", k), ranking.ranked_top(df, ["g"], "v", k)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


CATALOGUE = (
    "id long, title string, original_title string, release_date string, "
    "popularity double, revenue long, vote_average double, vote_count long"
)


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame(
        [
            (i, f"t{i % 7}", f"o{i % 5}", f"20{i % 30:02d}-01-01", float(i % 11), i % 13, i / 10, i % 3)
            for i in range(100)
        ],
        CATALOGUE,
    )


def test_fourteen_sort_keys_thirteen_extracts():
    assert len(ranking.SORT_KEYS) == 14
    assert set(ranking.SORT_KEYS) - set(ranking.EXTRACTS) == {"popularity.desc"}
    assert len(ranking.EXTRACTS) == 13


@pytest.mark.parametrize("sort_by", ranking.SORT_KEYS)
def test_pages_follow_each_other(catalogue, sort_by):
    whole = [r["id"] for r in ranking.sorted_page(catalogue, sort_by, pages=5).collect()]
    paged = [
        r["id"]
        for page in range(1, 8)
        for r in ranking.sorted_page(catalogue, sort_by, first_page=page, pages=1).collect()
    ]
    assert whole == paged and len(whole) == 100
    field, way = sort_by.split(".")
    column = ranking.FIELD_COLUMNS.get(field, field)
    by_id = {r["id"]: r[column] for r in catalogue.collect()}
    assert whole == sorted(
        sorted(by_id), key=lambda i: by_id[i], reverse=way == "desc"
    )


@pytest.mark.parametrize("sort_by", ["original_title.desc", "vote_count.asc"])
def test_deep_pages_are_those_of_the_whole_order(catalogue, monkeypatch, plan, sort_by):
    whole = [r["id"] for r in ranking.sorted_page(catalogue, sort_by).collect()]
    monkeypatch.setattr(ranking, "SHALLOW", 30)
    for page in (3, 5, 6):
        deep = ranking.sorted_page(catalogue, sort_by, first_page=page, pages=1)
        assert [r["id"] for r in deep.collect()] == whole[(page - 1) * 20 : page * 20]
        assert deep.columns == catalogue.columns
        assert "TakeOrdered" not in plan(deep)


def test_positions_of_all_orders(spark, catalogue):
    """Every order against a sort of plain rows: ties by id, NULLs last, an id that is NULL last of its ties."""
    odd = spark.createDataFrame(
        [(None, None, "o", None, 1.0, None, 0.5, 1), (200, "t1", None, "2001-01-01", None, 3, None, None)], CATALOGUE
    )
    both = catalogue.union(odd)
    data = both.collect()
    found = {}
    for r in ranking.union_of_extracts(both).collect():
        found.setdefault(r["extract"], []).append((r["position"], r["id"]))
    assert set(found) == set(ranking.EXTRACTS)
    for sort_by, placed in found.items():
        field, way = sort_by.split(".")
        column = ranking.FIELD_COLUMNS.get(field, field)
        by_id = sorted(data, key=lambda r: (r["id"] is not None, r["id"] or 0))  # NULL first
        given = [r for r in by_id if r[column] is not None]
        given.sort(key=lambda r: r[column], reverse=way == "desc")
        expected = given + [r for r in by_id if r[column] is None]
        assert sorted(placed) == [(i + 1, r["id"]) for i, r in enumerate(expected)]


def test_many_groups_at_many_partitions(spark, setting):
    """Places are no more than candidates, so groups times partitions is never built."""
    setting("spark.sql.shuffle.partitions", "200")
    df = spark.range(0, 200_000, 1, 8).select(
        (F.col("id") % 50_000).alias("g"), (F.xxhash64("id") % 7).alias("v"), "id"
    )
    got = ranking.top_with_ties(df, ["g"], "v", 2)
    assert got.exceptAll(ranking.ranked_top(df, ["g"], "v", 2)).count() == 0
    assert got.count() == ranking.ranked_top(df, ["g"], "v", 2).count()


def test_unknown_sort_key(catalogue):
    with pytest.raises(ValueError, match="unknown sort key"):
        ranking.sorted_page(catalogue, "budget.desc")


def test_nulls_come_last_either_way(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, 1.0)], "id long, popularity double")
    for sort_by, order in (("popularity.desc", [2, 3, 1]), ("popularity.asc", [3, 2, 1])):
        assert [r["id"] for r in ranking.sorted_page(df, sort_by).collect()] == order


def test_whole_extracts_hold_every_row(catalogue, rows):
    union = ranking.union_of_extracts(catalogue)
    assert union.count() == 13 * 100
    assert rows(union.filter("extract = 'title.asc'").drop("extract", "position")) == rows(catalogue)
    with pytest.raises(ValueError, match="unknown sort key"):
        ranking.union_of_extracts(catalogue, ["budget.desc"])
    with pytest.raises(ValueError, match="start with the first"):
        ranking.sorted_page(catalogue, "title.asc", first_page=2)


def test_union_of_extracts_holds_each_extract(catalogue, rows):
    union = ranking.union_of_extracts(catalogue, pages=1)
    assert union.count() == 13 * 20
    for sort_by in ranking.EXTRACTS:
        one = union.filter(F.col("extract") == sort_by).drop("extract", "position")
        assert rows(one) == rows(ranking.sorted_page(catalogue, sort_by, pages=1))


def test_first_rows_and_schema_rows(catalogue, rows):
    assert [r["id"] for r in ranking.first_rows(catalogue, 5, ["id"]).collect()] == [0, 1, 2, 3, 4]
    assert ranking.first_rows(catalogue, 20).count() == 20
    assert ("id", "bigint") in rows(ranking.schema_rows(catalogue))
