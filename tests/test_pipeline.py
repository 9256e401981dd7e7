"""Bronze to gold on files, and what must hold in the results."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from filmlake import snapshots
from filmlake.functions.predicates import DATE_FORMAT
from filmlake.operators import ranking
from filmlake.plans import contracts, pipeline, views
from filmlake.plans.queries import QUERIES
from filmlake.schemas import FILMS
from tests.test_clean import EDGES, AS_OF

GENRES = [("28", "Ação"), ("878", "Ficção científica"), ("18", "Drama"), ("99", "Documentário"), ("35", "Comédia")]


def film_json(edge) -> str:
    id_, title, language, date, genres, popularity, rating, votes = edge
    return json.dumps({
        "id": id_, "title": title, "original_title": title, "original_language": language,
        "release_date": date, "genre_ids": genres, "popularity": popularity,
        "vote_average": rating, "vote_count": votes, "overview": "unused", "adult": False,
    }, ensure_ascii=False)


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    (folder / "films").mkdir(parents=True)
    lines = [film_json(edge) for edge in EDGES]
    (folder / "films" / "a.jsonl").write_text("\n".join(lines[:6]) + "\nnot json\n", "utf-8")
    (folder / "films" / "b.jsonl").write_text("\n".join(lines[6:]) + "\n", "utf-8")
    (folder / "genres.json").write_text(
        json.dumps([{"id": i, "genero": g} for i, g in GENRES], indent=2, ensure_ascii=False), "utf-8"
    )
    return folder


def build(spark, bronze, silver, **more):
    return pipeline.build_silver(
        spark, str(bronze / "films"), str(bronze / "genres.json"), str(silver), as_of=AS_OF, **more
    )


def test_silver(spark, bronze, tmp_path, rows):
    report = build(spark, bronze, tmp_path / "silver", film_files=2, pair_files=3)
    assert report == {
        "genres": 5, "rows_in": 14, "rows_valid": 6, "no_id": 1, "no_title": 3, "no_genres": 2, "no_date": 3,
        "bad_date": 1, "future_date": 1, "corrupt": 1, "films": 5, "film_genres": 5,
        "rows_removed": 9,
    }
    silver = pipeline.read_silver(spark, str(tmp_path / "silver"))
    assert rows(silver.films.select("id", "idioma_original", "total_votos")) == sorted([
        (1, "Inglês", 10), (2, None, 0), (7, "Chinês", 1), (9, "Alemão", 3), (10, "Italiano", 5)
    ], key=repr)
    assert rows(silver.film_genres) == sorted([(1, 28), (1, 878), (7, 18), (9, 99), (10, 28)], key=repr)
    assert {r["violations"] for r in contracts.contract_report(silver).collect()} == {0}


def test_silver_twice_is_the_same(spark, bronze, tmp_path, rows):
    first = build(spark, bronze, tmp_path / "silver")
    before = rows(pipeline.read_silver(spark, str(tmp_path / "silver")).films)
    assert build(spark, bronze, tmp_path / "silver") == first
    assert rows(pipeline.read_silver(spark, str(tmp_path / "silver")).films) == before


def test_no_input_leaves_silver_alone(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    report = build(spark, bronze, tmp_path / "silver", pattern="*.none")
    assert (report["rows_in"], report["films"]) == (0, 0)
    assert pipeline.read_silver(spark, str(tmp_path / "silver")).films.count() == 5


def test_no_genres_leaves_films(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    (bronze / "genres.json").write_text("[]", "utf-8")
    report = build(spark, bronze, tmp_path / "silver")
    assert (report["genres"], report["films"], report["film_genres"]) == (0, 5, 0)
    status = pipeline.build_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert {r["name"]: (r["ok"], r["row_count"]) for r in status.collect()} == {
        name: (True, 4 if name.endswith("_por_ano") and name != "top_generos_por_ano" else 0)
        for name in views.GOLD
    }


def test_no_valid_film_leaves_silver_alone(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    for name in ("a", "b"):
        (bronze / "films" / f"{name}.jsonl").write_text('{"id": 1, "title": " "}\n', "utf-8")
    report = build(spark, bronze, tmp_path / "silver")
    assert (report["rows_in"], report["films"], report["film_genres"]) == (2, 0, 0)
    assert pipeline.read_silver(spark, str(tmp_path / "silver")).film_genres.count() == 5


def test_fewer_genres_without_a_film_leave_all_three_tables(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    (bronze / "genres.json").write_text(json.dumps([{"id": "28", "genero": "Ação"}]), "utf-8")
    build(spark, bronze, tmp_path / "silver", pattern="*.none")
    silver = pipeline.read_silver(spark, str(tmp_path / "silver"))
    assert silver.genres.count() == 5
    assert {r["violations"] for r in contracts.contract_report(silver).collect()} == {0}
    build(spark, bronze, tmp_path / "silver")
    silver = pipeline.read_silver(spark, str(tmp_path / "silver"))
    assert silver.genres.count() == 1
    assert {r["violations"] for r in contracts.contract_report(silver).collect()} == {0}
    # the current version and the one before, which a reader may still have open
    assert sorted(p.name for p in (tmp_path / "silver/manifests").glob("*.json")) == ["00000001.json", "00000002.json"]
    assert len(list((tmp_path / "silver/tables").iterdir())) == 2 * 4


def test_a_failing_build_leaves_all_three_tables(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    (bronze / "genres.json").write_text('[{"id": null, "genero": "x"}]', "utf-8")
    with pytest.raises(Exception, match="NULL in column id"):
        build(spark, bronze, tmp_path / "silver")
    silver = pipeline.read_silver(spark, str(tmp_path / "silver"))
    assert (silver.films.count(), silver.genres.count(), silver.film_genres.count()) == (5, 5, 5)


def contents(silver):
    return sorted(map(tuple, silver.films.collect())), sorted(map(tuple, silver.film_genres.collect()))


def test_a_reader_sees_one_version_whatever_step_a_build_dies_at(spark, bronze, tmp_path, monkeypatch):
    """A build is stopped at each table and at the commit; then one ends while a reader has the old tables open."""
    build(spark, bronze, tmp_path / "silver")
    opened = pipeline.read_silver(spark, str(tmp_path / "silver"))
    before = contents(opened)
    more = [(70, "X", "en", "1999-03-31", [28], 1.5, 8.0, 10)]
    (bronze / "films" / "c.jsonl").write_text("\n".join(map(film_json, more)), "utf-8")
    write = pipeline.write_parquet
    for fatal in ("genres", "films", "film_genres", "sources"):
        def dies(df, path, fatal=fatal, **more):
            if f"/{fatal}-" in path:
                raise KeyboardInterrupt(fatal)
            return write(df, path, **more)

        monkeypatch.setattr(pipeline, "write_parquet", dies)
        with pytest.raises(KeyboardInterrupt):
            build(spark, bronze, tmp_path / "silver")
        assert contents(pipeline.read_silver(spark, str(tmp_path / "silver"))) == before
    monkeypatch.setattr(pipeline, "write_parquet", write)
    commit = snapshots.commit

    def half(spark, base, tables):
        (tmp_path / "silver/manifests/_draft").write_text("{")  # what a writer that died in the step would leave
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "commit", half)
    with pytest.raises(KeyboardInterrupt):
        build(spark, bronze, tmp_path / "silver")
    assert contents(pipeline.read_silver(spark, str(tmp_path / "silver"))) == before
    monkeypatch.setattr(snapshots, "commit", commit)
    build(spark, bronze, tmp_path / "silver")
    assert contents(opened) == before
    assert len(contents(pipeline.read_silver(spark, str(tmp_path / "silver")))[0]) == 6


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "root")
    first = snapshots.commit(spark, snapshots.Snapshot(root), {"films": ["a"]})
    second = snapshots.commit(spark, first, {"films": ["a", "b"]})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, first, {"films": ["c"]})
    assert snapshots.current(spark, root) == second
    for name in ("a", "b", "c"):
        (tmp_path / "root/tables" / name).mkdir(parents=True)
    last = snapshots.commit(spark, snapshots.commit(spark, second, {"films": ["b"]}), {"films": ["c"]})
    snapshots.expire(spark, root, keep=1)
    assert sorted(p.name for p in (tmp_path / "root/tables").iterdir()) == ["b", "c"]
    assert snapshots.current(spark, root) == last and last.number == 4
    assert snapshots.current(spark, str(tmp_path / "none")) is None
    assert last.read(spark, "unknown", FILMS).count() == 0


def append(spark, bronze, silver):
    return pipeline.append_silver(
        spark, str(bronze / "films"), str(bronze / "genres.json"), str(silver), as_of=AS_OF
    )


def test_append_reads_new_files_only(spark, bronze, tmp_path, rows, monkeypatch):
    silver = tmp_path / "silver"
    assert append(spark, bronze, silver)["films"] == 5  # nothing there yet, so all is built
    nothing = append(spark, bronze, silver)
    assert nothing == {"files": 0, "genres": 0, "films": 0, "film_genres": 0}
    assert snapshots.current(spark, str(silver)).number == 1
    more = [
        (1, "A again", "en", "1999-03-31", [35], 99.0, 8.0, 10),  # its id is there
        (70, "X", "en", "1999-03-31", [28, 53], 1.5, 8.0, 10), (70, "X", "en", "1999-03-31", [28], 0.5, 8.0, 10),
        (71, " ", "en", "1999-03-31", [28], 1.5, 8.0, 10),
    ]
    (bronze / "films" / "c.jsonl").write_text("\n".join(map(film_json, more)), "utf-8")
    (bronze / "genres.json").write_text(json.dumps([{"id": "28", "genero": "other"}, {"id": "53", "genero": "Thriller"}]), "utf-8")
    opened = []
    read = pipeline.read_films
    monkeypatch.setattr(pipeline, "read_films", lambda s, f, p: opened.append(f) or read(s, f, p))
    report = append(spark, bronze, silver)
    assert [[p.rpartition("/")[2] for p in paths] for paths in opened] == [["c.jsonl"]]
    assert (report["files"], report["rows_in"], report["genres"], report["films"], report["film_genres"]) == (1, 4, 1, 1, 2)
    tables = pipeline.read_silver(spark, str(silver))
    assert {(1, "A"), (70, "X")} <= set(rows(tables.films.select("id", "titulo"))) and tables.films.count() == 6
    assert rows(tables.film_genres.filter("id_filme = 70")) == [(70, 28), (70, 53)]
    assert ("Ação",) in rows(tables.genres.filter("id = 28").select("genero")) and tables.genres.count() == 6
    assert {r["violations"] for r in contracts.contract_report(tables).collect()} == {0}
    before = contents(tables)
    assert pipeline.compact_silver(spark, str(silver)) == {"films": 6, "genres": 6, "film_genres": 7, "sources": 3}
    assert all(len(x) == 1 for x in snapshots.current(spark, str(silver)).tables.values())
    assert contents(pipeline.read_silver(spark, str(silver))) == before
    assert append(spark, bronze, silver)["files"] == 0


def test_a_failing_append_leaves_all_tables(spark, bronze, tmp_path, monkeypatch):
    build(spark, bronze, tmp_path / "silver")
    before = contents(pipeline.read_silver(spark, str(tmp_path / "silver")))
    (bronze / "films" / "c.jsonl").write_text(film_json((70, "X", "en", "1999-03-31", [28], 1.5, 8.0, 10)), "utf-8")
    monkeypatch.setattr(pipeline, "matching", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        append(spark, bronze, tmp_path / "silver")
    assert contents(pipeline.read_silver(spark, str(tmp_path / "silver"))) == before
    assert len(list((tmp_path / "silver/tables").iterdir())) == 4


def test_records_without_an_id_are_no_films(spark, bronze, tmp_path):
    edges = [(None, "X", "en", "1999-03-31", [28], 1.5, 8.0, 10), (None, "Y", "en", "1999-03-31", [28], 1.5, 8.0, 10)]
    (bronze / "films" / "c.jsonl").write_text("\n".join(map(film_json, edges)), "utf-8")
    report = build(spark, bronze, tmp_path / "silver")
    assert (report["no_id"], report["films"]) == (3, 5)
    silver = pipeline.read_silver(spark, str(tmp_path / "silver"))
    assert {r["violations"] for r in contracts.contract_report(silver).collect()} == {0}


def test_gold(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    status = pipeline.build_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), min_votes=0)
    assert {r["name"]: (r["ok"], r["row_count"]) for r in status.collect()} == {
        "filmes_lancados_por_ano": (True, 4),
        "padrao_avaliacao": (True, 4),
        "top_filmes_por_genero": (True, 5),
        "top_generos_por_ano": (True, 5),
        "popularidade_vs_nota_media": (True, 4),
        "popularidade_por_ano": (True, 4),
        "generos_por_popularidade": (True, 4),
    }
    got = spark.read.option("header", True).csv(str(tmp_path / "gold/popularidade_vs_nota_media"))
    assert {r["titulo"]: r["generos"] for r in got.collect()}["A"] == "Ação, Ficção científica"
    assert spark.sql("SELECT count(*) FROM filmes JOIN filmes_generos ON id = id_filme").first()[0] == 5


def test_columns_of_the_results(spark, bronze, tmp_path):
    build(spark, bronze, tmp_path / "silver")
    results = views.gold_results(pipeline.read_silver(spark, str(tmp_path / "silver")))
    assert {name: dict(df.dtypes) for name, df in results.items()} == {
        "filmes_lancados_por_ano": {"numero_filmes": "bigint", "ano": "int"},
        "padrao_avaliacao": {
            "genero": "string", "numero_filmes": "bigint", "ano_inicial": "int", "ano_final": "int",
            "media_ponderada_geral": "double", "media_simples_geral": "double",
            "diferenca_medias": "double",
        },
        "top_filmes_por_genero": {
            "genero": "string", "titulo": "string", "nota_media": "double", "ranking": "int"
        },
        "top_generos_por_ano": {
            "ano": "int", "rank_do_genero": "int", "genero": "string", "media_nota_ano": "double"
        },
        "popularidade_vs_nota_media": {
            "titulo": "string", "popularidade": "double", "nota_media": "double", "generos": "string"
        },
        "popularidade_por_ano": {"ano": "int", "media_popularidade": "double", "qtd_filmes": "bigint"},
        "generos_por_popularidade": {
            "genero": "string", "media_popularidade": "double", "qtd_filmes": "bigint"
        },
    }


def test_one_failing_view_does_not_stop_the_others(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("fine")
    spark.range(3).select(F.raise_error(F.lit("broken")).cast("string").alias("x")).createOrReplaceTempView("bad")
    status = {r["name"]: r for r in pipeline.export_views(spark, str(tmp_path), ["bad", "missing", "fine"]).collect()}
    assert [status[n]["ok"] for n in ("bad", "missing", "fine")] == [False, False, True]
    assert "broken" in status["bad"]["error"]
    assert status["fine"]["row_count"] == 3
    assert pipeline.export_views(spark, str(tmp_path), []).count() == 0


def test_collected_extracts_feed_silver(spark, bronze, tmp_path):
    catalogue = spark.read.json(str(bronze / "films" / "b.jsonl")).withColumn("revenue", F.lit(1).cast("long"))
    written = pipeline.collect_extracts(catalogue.dropDuplicates(["id"]), str(tmp_path / "extracts"))
    assert written == 6  # each row once, with the list of the extracts that hold it
    tags = spark.read.json(str(tmp_path / "extracts")).select("extracts").distinct().collect()
    assert [set(r.extracts) for r in tags] == [set(ranking.EXTRACTS)]
    assert pipeline.collect_extracts(catalogue.dropDuplicates(["id"]), str(tmp_path / "pages"), pages=1) == 13 * 6
    assert len(list((tmp_path / "pages").glob("extract=*"))) == 13
    report = pipeline.build_silver(
        spark, str(tmp_path / "extracts"), str(bronze / "genres.json"), str(tmp_path / "silver"),
        as_of=AS_OF, pattern="*.json",
    )
    assert report["rows_in"] == written
    assert report["films"] <= 6


SF = "/root/testdata/sf0.001"


def test_invariants_of_the_results(spark):
    """Facts that tie the results to each other."""
    run = {name: QUERIES[name](spark, SF).collect() for name in (
        "films_per_year", "popularity_by_year", "popularity_by_genre", "rating_pattern",
        "yearly_genre_ratings", "top_genres_by_year", "row_counts",
    )}
    sizes = {r["table_name"]: r["row_count"] for r in run["row_counts"]}
    per_year = {r["ano"]: r["numero_filmes"] for r in run["films_per_year"]}
    assert per_year == {r["ano"]: r["qtd_filmes"] for r in run["popularity_by_year"]}
    assert sum(per_year.values()) == sizes["filmes"]
    assert sum(r["qtd_filmes"] for r in run["popularity_by_genre"]) == sizes["filmes_generos"]
    assert sum(r["numero_filmes"] for r in run["rating_pattern"]) <= sizes["filmes_generos"]
    assert {r["ano"] for r in run["top_genres_by_year"]} <= set(per_year)
    for row in run["top_genres_by_year"]:
        better = [
            other for other in run["top_genres_by_year"]
            if other["ano"] == row["ano"] and other["media_nota_ano"] > row["media_nota_ano"]
        ]
        assert row["rank_do_genero"] == 1 + len(better)
    for row in run["rating_pattern"]:
        apart = row["media_ponderada_geral"] - row["media_simples_geral"]
        assert abs(apart - row["diferenca_medias"]) <= 0.0101


def test_results_do_not_depend_on_how_data_is_split(spark, setting, rows):
    """Another number of tasks and another split of the files, the very same values."""
    names = ("rating_pattern", "top_genres_by_year", "popularity_by_genre", "top_films_by_genre", "clean_valid")

    def run():
        return {name: rows(QUERIES[name](spark, SF)) for name in names}

    before = run()
    setting("spark.sql.shuffle.partitions", "3")
    setting("spark.sql.files.maxPartitionBytes", "20000")
    setting("spark.sql.files.openCostInBytes", "0")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert run() == before


def test_observed_counts_read_no_text(spark, tmp_path, monkeypatch, plan):
    """Observed counts are interpreted; a record's date was read for each of them, and once more by the filter."""
    (tmp_path / "a.json").write_text(
        '{"id": 1, "title": "t", "genre_ids": [1], "release_date": "2000-01-01"}\n'
        '{"id": 2, "title": " ", "genre_ids": null, "release_date": "2009-01-01"}\nno json\n'
    )
    plans, stage = [], pipeline.stage

    def watched(df, path):
        plans.append(plan(df))
        return stage(df, path)

    monkeypatch.setattr(pipeline, "stage", watched)
    valid, audit = pipeline._valid_records(spark, str(tmp_path), "*.json", "2001-01-01", DATE_FORMAT, f"{tmp_path}/out")
    assert plans[0].count("RLIKE") <= 1
    assert [r["id"] for r in valid.collect()] == [1] and "source_file" not in valid.columns
    assert audit == {
        "rows_in": 3, "rows_valid": 1, "no_id": 1, "no_title": 2, "no_genres": 2, "no_date": 1, "bad_date": 0,
        "future_date": 1, "corrupt": 1,
    }
