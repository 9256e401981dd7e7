"""Means: weights, NULLs, rounding, and independence of order."""

from __future__ import annotations

import math
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmlake.operators.aggregate import (
    grouped_sums,
    mean_per,
    rating_pattern,
    row_counts,
    text_per_group,
    yearly_ratings,
)


def mean_of(df, digits=2):
    return mean_per(df, F.lit(1).alias("g"), "x", "m", digits).first()["m"]


def sum_of(df):
    return grouped_sums(df, [F.lit(1).alias("g")], {"s": F.col("x")}).first()["s"]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_mean_leaves_nulls_out(spark):
    df = frame(spark, [1.0, None, 2.0])
    assert mean_of(df) == 1.5
    assert mean_of(df.filter("x is null")) is None
    assert sum_of(df.filter("x is null")) is None


def test_weights_that_add_up_to_nothing(spark):
    yearly = spark.createDataFrame(
        [("X", 0, 2000, 5.0, 5.0)],
        "genero string, filmes_por_genero long, ano int, media_ponderada_anual double, media_simples_anual double",
    )
    row = rating_pattern(yearly).first()
    assert (row["media_ponderada_geral"], row["media_simples_geral"], row["diferenca_medias"]) == (None, 5.0, None)


@pytest.mark.parametrize("values", [(1.0, math.nan), (1.0, math.inf), (math.inf, -math.inf), (-math.inf, 2.0), (math.nan, math.inf)])
def test_values_that_are_no_numbers(spark, values):
    df = frame(spark, values)
    assert str(sum_of(df)) == str(df.agg(F.sum("x")).first()[0])


EXTREMES = [5e-324, 2.2250738585072014e-308, 1e-300, 1e300, -1e300, 8e307, 0.0, -0.0, 1.0, 0.1, 1e15, -4e12, 0.25, 2.0**53 + 2]


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    values=st.lists(
        st.one_of(st.sampled_from(EXTREMES), st.floats(-1e6, 1e6), st.floats(-1e300, 1e300)), min_size=1, max_size=40
    ),
    parts=st.integers(1, 6),
)
def test_sums_are_exact_whatever_the_split(spark, values, parts):
    """Equal to the rounded sum of fractions, for any order and split."""
    want = math.fsum(values)
    found = {sum_of(frame(spark, order).repartition(n)) for order, n in ((values, parts), (values[::-1], 1), (sorted(values), parts))}
    assert len(found) == 1
    assert found.pop() == pytest.approx(want, rel=1e-15, abs=5e-324)


def test_sums_of_many_values_that_cancel(spark):
    values = [1e16, 1.0, -1e16, 0.1] * 500 + [3.0**i for i in range(-200, 200)]
    assert sum_of(frame(spark, values).repartition(7)) == math.fsum(values)


def test_every_power_of_two_is_exact(spark):
    values = [2.0**i for i in range(-1074, 1000)]
    got = grouped_sums(frame(spark, values), [F.col("x")], {"s": F.col("x")}).collect()
    assert all(r["x"] == r["s"] for r in got) and len(got) == len(values)


def test_mean_at_the_rounding_boundary_does_not_depend_on_order(spark):
    values = [6.1, 6.0, 5.9, 6.2, 6.05, 0.1, 12.0] * 50
    results = {mean_of(frame(spark, order).repartition(7), 6) for order in (values, sorted(values), values[::-1])}
    assert results == {round(float(sum(Fraction(str(v)) for v in values) / len(values)), 6)}


def test_a_mean_is_rounded_once(spark):
    """Half up on the printed number; just below a half goes down however close it is."""
    assert mean_of(frame(spark, [2.675])) == 2.68
    assert mean_of(frame(spark, [1.005])) == 1.01
    assert mean_of(frame(spark, [0.12499999])) == 0.12
    assert mean_of(frame(spark, [0.124999999999])) == 0.12
    assert mean_of(frame(spark, [0.125])) == 0.13


def test_a_group_that_fills_the_table_is_a_few_rows_a_task(spark, plan):
    df = spark.range(0, 100_000, 1, 8).select(F.lit("hot").alias("g"), (F.col("id") / 7).alias("x"))
    text = plan(mean_per(df, F.col("g"), "x", "m"))
    assert "partial_sum" in text and "SortAggregate" not in text
    assert mean_per(df, F.col("g"), "x", "m").first()["m"] == round(99_999 / 14, 2)


def by_genre(spark, films):
    return spark.createDataFrame(films, "id long, d string, genero string, nota_media double, total_votos long").select(
        "id", F.col("d").cast("date").alias("data_lancamento"), "genero", "nota_media", "total_votos"
    )


def test_two_level_rating_pattern(spark):
    frame = by_genre(spark, [
        (1, "2000-01-01", "X", 8.0, 100),
        (2, "2000-06-01", "X", 4.0, 1),
        (3, "2001-01-01", "X", 5.555, 7),
        (4, "2001-01-01", "X", 9.0, 0),
        (5, "2002-01-01", "X", None, 3),
    ])
    yearly = {r["ano"]: r for r in yearly_ratings(frame).collect()}
    assert yearly[2000]["media_ponderada_anual"] == 7.96
    assert yearly[2000]["media_simples_anual"] == 6.0
    assert yearly[2001]["filmes_por_genero"] == 1
    assert yearly[2002]["media_simples_anual"] is None
    row = rating_pattern(yearly_ratings(frame)).first()
    assert (row["numero_filmes"], row["ano_inicial"], row["ano_final"]) == (4, 2000, 2002)
    weighted = (7.96 * 2 + 5.56) / 4
    assert row["media_ponderada_geral"] == 5.37 == round(weighted + 1e-12, 2)
    assert row["media_simples_geral"] == 5.78
    assert row["diferenca_medias"] == round(weighted - 5.78, 2)


def test_difference_is_rounded_last(spark):
    yearly = spark.createDataFrame(
        [("X", 1, 2000, 6.694, 6.146)],
        "genero string, filmes_por_genero long, ano int, media_ponderada_anual double, media_simples_anual double",
    )
    row = rating_pattern(yearly).first()
    assert (row["media_ponderada_geral"], row["media_simples_geral"]) == (6.69, 6.15)
    assert row["diferenca_medias"] == 0.55


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 3.0), ("a", 4.0)], "g string, x double")
    got = {r["g"]: (r["m"], r["n"]) for r in mean_per(df, F.col("g"), "x", "m", count="n").collect()}
    assert got == {None: (1.0, 1), "a": (3.5, 2)}


@pytest.mark.parametrize(("texts", "joined"), [(["b", "a", None], "a, b"), ([None], None)])
def test_text_per_group(spark, texts, joined):
    df = spark.createDataFrame([(1, t) for t in texts], "id int, t string")
    assert text_per_group(df, ["id"], "t", "all").first()["all"] == joined


def test_row_counts(spark, rows):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
