"""The physical plans, as planned before the run."""

from __future__ import annotations

import pytest

from filmlake.operators.clean import clean_films, keep_one
from filmlake.operators.ranking import top_with_ties, union_of_extracts
from filmlake.operators.relate import film_genre_pairs
from filmlake.plans import star, views

SF = "/root/testdata/sf0.001"
NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_scan_reads_only_what_is_used(spark, plan):
    text = plan(views.films_per_year(star.films(spark, SF, with_votes=False)))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    assert text.count("FileScan") == 1


def test_small_genres_are_broadcast_without_a_hint(spark, plan, setting):
    by_genre = views.popularity_by_genre(star.by_genre(spark, SF))
    assert "BroadcastHashJoin [id_genero" in plan(by_genre)
    setting(*NO_BROADCAST)
    assert "Broadcast" not in plan(views.popularity_by_genre(star.by_genre(spark, SF)))


def test_films_and_bridge_meet_where_they_lie(spark, plan, setting):
    """The set per order is shuffled once; neither the explode nor the join moves it again."""
    setting(*NO_BROADCAST)
    silver = star.silver(spark, SF, with_votes=True)
    joined = silver.films.join(silver.film_genres, silver.films["id"] == silver.film_genres["id_filme"])
    # supplier and lines for the supplier join, lines per order twice, orders
    assert plan(joined).count("Exchange hashpartitioning") == 5


def test_duplicates_are_dropped_before_the_shuffle(spark, plan):
    text = plan(keep_one(star.table(spark, SF, "lineitem"), ["l_orderkey"], ["l_extendedprice"]))
    assert text.count("Exchange") == 1
    assert "partial_max" in text


def test_validity_is_checked_before_the_shuffle(spark, plan):
    text = plan(clean_films(star.raw_films(spark, SF), "2001-01-01"))
    assert text.index("Exchange hashpartitioning") < text.index("RLIKE")


def test_pairs_of_unique_ids_need_no_shuffle(spark, plan):
    records = spark.read.schema("id long, genre_ids array<long>").json("/root/testdata/sf0.001")
    assert "Exchange" not in plan(film_genre_pairs(records))


def test_top_limits_each_task(spark, plan, setting):
    events = star.table(spark, SF, "events")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(top_with_ties(events, ["event_type"], "value", 3))
    # rows travel only after a task has kept its best of each group and part
    assert text.count("rank(value#") >= 2 and "3, Partial" in text
    assert "hashpartitioning(event_type" in text
    for part in text.split("Scan parquet")[:-1]:
        above = part[part.rindex("Exchange") :] if "Exchange" in part else part
        assert "Partial" in above


def test_a_large_top_deals_a_group_over_parts(spark, plan):
    events = star.table(spark, SF, "events")
    text = plan(top_with_ties(events, ["event_type"], "value", 2000))
    assert "hashpartitioning(event_type" in text and "_part" in text


def test_yearly_top_uses_the_group_limit(spark, plan):
    assert "WindowGroupLimit" in plan(views.top_genres_by_year(star.by_genre(spark, SF)))


def test_genre_text_reuses_the_partitioning_by_film(spark, plan, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "10000")
    text = plan(views.genres_text_per_film(star.by_genre(spark, SF)))
    assert text.count("Exchange hashpartitioning") == plan(star.by_genre(spark, SF)).count(
        "Exchange hashpartitioning"
    )


def test_extracts_are_settled_at_once(spark, plan):
    """All orders are written by one shuffle; what is left joins a page's keys to one scan."""
    text = plan(union_of_extracts(star.catalogue(spark, SF), pages=2))
    assert "TakeOrdered" not in text and "rangepartitioning" not in text
    assert text.count("FileScan parquet [o_orderkey") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_shuffles_candidates_once(spark):
    """Rows and places read the same shuffled candidates."""
    top = views.top_films_by_genre(star.by_genre(spark, SF, with_votes=True), 150)
    top.collect()
    final = top._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan")[0]
    assert final.count("ReusedExchange") == 1
    assert final.count("FileScan parquet") == 5


@pytest.mark.parametrize("name", ["rating_pattern", "top_films_by_genre", "genres_of_title"])
def test_no_cross_joins_and_no_python(spark, plan, name):
    from filmlake.plans.queries import QUERIES

    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in text
