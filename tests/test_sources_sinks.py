"""Readers and writers on files, and the calls made for relational tables."""

from __future__ import annotations

import json
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from filmlake import staging
from filmlake.plans.pipeline import load_relational
from filmlake.plans.views import Silver
from filmlake.schemas import CORRUPT, FILM_RAW
from filmlake.session import shuffle_partitions
from filmlake.sinks import (
    write_csv,
    write_jdbc,
    write_json_array,
    write_json_lines,
    write_parquet,
    write_parquet_unless_empty,
)
from filmlake.sources import (
    list_views,
    local_rows,
    read_films,
    read_genres,
    read_jdbc,
    read_table,
)


def test_films_of_two_files_by_name(spark, tmp_path, rows):
    """Other field order, a missing field, an unknown one, and a broken line."""
    (tmp_path / "a.jsonl").write_text(
        '{"id": 1, "title": "A", "genre_ids": [28], "vote_count": 3}\nnot json\n', "utf-8"
    )
    (tmp_path / "b.jsonl").write_text(
        '{"overview": "?", "title": "Ação", "id": 2, "vote_average": 7.5}\n', "utf-8"
    )
    (tmp_path / "c.json").write_text('{"id": 3}\n', "utf-8")
    films = read_films(spark, str(tmp_path)).cache()
    assert rows(films.filter("id is not null").select("id", "title", "genre_ids", "vote_average")) == [
        (1, "A", [28], None),
        (2, "Ação", None, 7.5),
    ]
    assert [r[0] for r in films.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT).collect()] == ["not json"]
    assert {r[0].rsplit("/", 1)[1] for r in films.select("source_file").collect()} == {"a.jsonl", "b.jsonl"}
    films.unpersist()


def test_reading_leaves_the_schema_alone(spark, tmp_path):
    before = FILM_RAW.fieldNames()
    read_films(spark, str(tmp_path))
    read_films(spark, str(tmp_path))
    assert FILM_RAW.fieldNames() == before


def test_folder_without_films(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    assert read_films(spark, str(tmp_path)).count() == 0


def test_genre_array_over_many_lines(spark, tmp_path, rows):
    path = tmp_path / "genres.json"
    path.write_text(json.dumps([{"id": "28", "genero": "Ação"}, {"id": "18", "genero": "Drama"}], indent=2, ensure_ascii=False), "utf-8")
    assert rows(read_genres(spark, str(path))) == [(18, "Drama"), (28, "Ação")]


def test_json_lines_append_and_keep_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "Ação"), (2, None)], "id long, title string")
    assert write_json_lines(df, path) == 2
    assert write_json_lines(df.limit(1), path) == 1
    lines = [line for part in (tmp_path / "out").glob("*.json") for line in part.read_text("utf-8").splitlines()]
    assert sorted(lines) == ['{"id":1,"title":"Ação"}', '{"id":1,"title":"Ação"}', '{"id":2,"title":null}']


def test_json_lines_split_by_a_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, extract string")
    write_json_lines(df, str(tmp_path / "out"), split_by="extract")
    assert sorted(p.name for p in (tmp_path / "out").glob("extract=*")) == ["extract=a", "extract=b"]


def test_json_array_is_one_document(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("9", "b"), ("28", "Ação"), ("5", None)], "id string, genero string")
    write_json_array(df, path)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text) == [
        {"id": "28", "genero": "Ação"}, {"id": "5", "genero": None}, {"id": "9", "genero": "b"}
    ]
    assert rows(read_genres(spark, path)) == [(28, "Ação"), (5, None), (9, "b")]


def test_a_large_table_is_many_json_documents(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    same = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(3000).select(F.when(same == "hot", "7").otherwise(same).alias("id"), F.lit("g").alias("genero"))
    write_json_array(df, path, document_rows=100)
    documents = [json.loads(p.read_text("utf-8")) for p in (tmp_path / "out").glob("part-*")]
    assert len(documents) >= 30 and max(map(len, documents)) == 100
    assert rows(read_genres(spark, path)) == rows(df.select(F.col("id").cast("long"), "genero"))


def test_equal_rows_go_over_many_documents_and_tasks(spark, tmp_path):
    """A third of all rows are alike; no file holds more than its rows, no task more than its share."""
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("id"), F.lit("g").alias("genero")
    )
    write_json_array(df, str(tmp_path / "out"), document_rows=1000)
    documents = [json.loads(p.read_text("utf-8")) for p in (tmp_path / "out").glob("part-*")]
    assert max(map(len, documents)) == 1000 and sum(map(len, documents)) == 60_000
    order = [*df.columns, "_number"]
    dealt = df.withColumn("_number", F.monotonically_increasing_id()).repartitionByRange(8, *order)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 60_000 / 8


def test_an_empty_table_reads_back_as_no_genres(spark, tmp_path):
    path = str(tmp_path / "out")
    write_json_array(spark.createDataFrame([], "id string, genero string"), path)
    assert read_genres(spark, path).count() == 0


def test_parquet_save_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10)
    assert write_parquet(df, path, mode="error") == 10
    with pytest.raises(AnalysisException):
        write_parquet(df, path, mode="error")
    assert write_parquet(df, path, mode="ignore") == 0
    assert write_parquet(df, path, mode="append") == 10
    assert spark.read.parquet(path).count() == 20
    assert write_parquet(df, path, num_files=3) == 10
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 3


def test_empty_table_leaves_parquet_alone(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_parquet_unless_empty(spark.range(4), path, 2) == 4
    assert write_parquet_unless_empty(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 4


def test_csv_quotes_and_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, None)], "id long, t string")
    assert write_csv(df, str(tmp_path / "out"), num_files=1) == 2
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text("utf-8") == 'id,t\n1,"say ""hi"", ok"\n2,\n'


def test_small_sorted_result_is_one_csv_file(spark, tmp_path):
    df = spark.range(0, 5000, 1, 8).groupBy((F.col("id") % 40).alias("k")).count().orderBy("k")
    write_csv(df, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_local_rows(spark):
    df = local_rows(
        spark,
        [{"titulo": "X", "ano": 1999, "nota": 8.7}, {"titulo": "Y", "ano": 2001, "nota": None}],
        "titulo string, ano long, nota double",
    )
    assert df.dtypes == [("titulo", "string"), ("ano", "bigint"), ("nota", "double")]
    assert df.count() == 2


def test_views_are_listed(spark):
    spark.range(1).createOrReplaceTempView("zz_view")
    try:
        assert "zz_view" in list_views(spark)
        assert read_table(spark, "zz_view").count() == 1
    finally:
        spark.catalog.dropTempView("zz_view")
    assert "zz_view" not in list_views(spark)


def test_shared_folder_follows_the_session():
    session = MagicMock()
    settings = {"spark.checkpoint.dir": "hdfs://shared/folder/", "spark.sql.warehouse.dir": "hdfs://house"}
    session.conf.get.side_effect = lambda name, default=None: settings.get(name, default)
    assert staging.shared_folder(session) == "hdfs://shared/folder"
    del settings["spark.checkpoint.dir"]
    assert staging.shared_folder(session) == "hdfs://house"


def test_stage_and_discard(spark, tmp_path):
    path = str(tmp_path / "staged")
    staged = staging.stage(spark.range(5), path)
    assert staged.count() == 5
    staging.discard(spark, path)
    assert not (tmp_path / "staged").exists()


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(10**14) > 700_000


# no database is started here: the calls are looked at, not carried out


def test_jdbc_append_plain_and_tuned():
    df = MagicMock()
    write_jdbc(df, "jdbc:x", "t", {"user": "u"})
    df.write.mode.assert_called_once_with("append")
    df.write.mode().option.assert_not_called()
    df.write.mode().jdbc.assert_called_once_with("jdbc:x", "t", properties={"user": "u"})

    df = MagicMock()
    writer = df.write.mode.return_value
    writer.option.return_value = writer
    write_jdbc(df, "jdbc:x", "t", batch_size=1000, timeout=3600, writers=4)
    assert [call.args for call in writer.option.call_args_list] == [
        ("batchsize", "1000"), ("queryTimeout", "3600"), ("numPartitions", "4")
    ]


def test_jdbc_read_whole_and_sliced():
    spark = MagicMock()
    read_jdbc(spark, "jdbc:x", "t", {"user": "u"})
    spark.read.jdbc.assert_called_once_with("jdbc:x", "t", properties={"user": "u"})
    spark = MagicMock()
    read_jdbc(spark, "jdbc:x", "t", key="id", bounds=(0, 100), partitions=4)
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x", "t", column="id", lowerBound=0, upperBound=100, numPartitions=4, properties={}
    )
    with pytest.raises(ValueError, match="sliced read"):
        read_jdbc(spark, "jdbc:x", "t", key="id")


def test_parents_are_loaded_before_the_bridge():
    order = []
    frames = {}
    for name in ("films", "genres", "film_genres"):
        frames[name] = MagicMock()
        writer = frames[name].write.mode.return_value
        writer.option.return_value = writer
        writer.jdbc.side_effect = lambda url, table, properties: order.append(table)
    load_relational(Silver(**frames, by_genre=MagicMock()), "jdbc:x", {}, writers=4)
    assert order == ["generos", "filmes", "filmes_generos"]
