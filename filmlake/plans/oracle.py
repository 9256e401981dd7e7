"""The queries once more, as SQL text another engine can run on the same tables."""

from __future__ import annotations

FILMS = """
films AS (
    SELECT o_orderkey AS id,
           'Order#' || o_orderkey AS titulo,
           o_orderpriority AS idioma_original,
           CAST(o_orderdate AS DATE) AS data_lancamento,
           o_totalprice / 1000 AS popularidade,
           o_totalprice / 50000 AS nota_media,
           CAST(coalesce(votes, 0) AS BIGINT) AS total_votos
    FROM orders LEFT JOIN (
        SELECT l_orderkey, sum(l_quantity) AS votes FROM lineitem GROUP BY l_orderkey
    ) ON l_orderkey = o_orderkey
)"""

GENRES = """
genres AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS genero FROM nation)"""

PAIRS = """
pairs AS (
    SELECT DISTINCT l_orderkey AS id_filme, CAST(s_nationkey AS BIGINT) AS id_genero
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
)"""

BY_GENRE = f"""
{FILMS}, {GENRES}, {PAIRS}, by_genre AS (
    SELECT films.*, id_genero, genero
    FROM films JOIN pairs ON films.id = id_filme JOIN genres ON genres.id = id_genero
)"""

RAW = """
raw AS (
    SELECT l_orderkey AS id,
           CASE WHEN l_discount >= 0.1 THEN '  '
                ELSE concat_ws('/', 'Line', l_orderkey, l_linenumber) END AS title,
           l_linestatus || l_returnflag AS original_title,
           lower(l_linestatus || l_returnflag) AS original_language,
           CASE WHEN l_tax = 0 THEN ''
                ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS release_date,
           CASE WHEN l_quantity > 1
                THEN [CAST(s_nationkey AS BIGINT), CAST(s_nationkey AS BIGINT),
                      CAST(l_linenumber AS BIGINT) + 22] END AS genre_ids,
           l_extendedprice / 1000 AS popularity,
           CAST(trunc(l_extendedprice) AS BIGINT) AS revenue,
           nullif(l_discount * 100, 0.0) AS vote_average,
           CAST(l_quantity AS BIGINT) AS vote_count
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
)"""

VALID = """trim(title) <> '' AND genre_ids IS NOT NULL AND trim(release_date) <> ''
        AND TRY_CAST(release_date AS DATE) <= DATE '2001-01-01'"""

COPY = """row_number() OVER (PARTITION BY id ORDER BY
        popularity DESC NULLS LAST, title DESC NULLS LAST, original_title DESC NULLS LAST,
        original_language DESC NULLS LAST, release_date DESC NULLS LAST,
        genre_ids DESC NULLS LAST, revenue DESC NULLS LAST, vote_average DESC NULLS LAST,
        vote_count DESC NULLS LAST) AS copy_number"""

CLEAN_COLUMNS = """id, title, original_title, original_language, release_date, popularity,
       revenue, coalesce(vote_average, 0) AS vote_average, vote_count"""

CLEAN = f"""
{RAW}, clean AS (
    SELECT {CLEAN_COLUMNS}, genre_ids
    FROM (SELECT *, {COPY} FROM raw WHERE {VALID}) WHERE copy_number = 1
), clean_pairs AS (
    SELECT DISTINCT id AS id_filme, unnest(genre_ids) AS id_genero FROM clean
)"""

CATALOGUE = """
catalogue AS (
    SELECT o_orderkey AS id,
           'Order#' || o_orderkey AS title,
           o_orderpriority AS original_title,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date,
           o_totalprice / 1000 AS popularity,
           CAST(trunc(o_totalprice) AS BIGINT) AS revenue,
           o_totalprice / 50000 AS vote_average,
           o_custkey AS vote_count
    FROM orders
)"""

EXTRACT_ORDERS = {
    "original_title.desc": "original_title DESC",
    "original_title.asc": "original_title ASC",
    "title.desc": "title DESC",
    "title.asc": "title ASC",
    "popularity.asc": "popularity ASC",
    "revenue.desc": "revenue DESC",
    "revenue.asc": "revenue ASC",
    "primary_release_date.desc": "release_date DESC",
    "primary_release_date.asc": "release_date ASC",
    "vote_average.desc": "vote_average DESC",
    "vote_average.asc": "vote_average ASC",
    "vote_count.desc": "vote_count DESC",
    "vote_count.asc": "vote_count ASC",
}

EXTRACTS = " UNION ALL ".join(
    f"SELECT '{name}' AS extract, row_number() OVER (ORDER BY {order} NULLS LAST, id) AS position, * FROM catalogue"
    for name, order in EXTRACT_ORDERS.items()
)


def mean(value: str) -> str:
    """A mean whose sum carries its errors along, as a plain one depends on the order."""
    return f"favg(CAST({value} AS DOUBLE))"


def weighted(value: str, weight: str) -> str:
    return f"fsum(CAST({value} AS DOUBLE) * {weight}) / sum({weight})"


def rounded(number: str, digits: int) -> str:
    """Rounded half up on the shortest text of the number."""
    return f"CAST(round(CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


YEAR = "CAST(year(data_lancamento) AS INTEGER)"

YEARLY = f"""
yearly AS (
    SELECT {YEAR} AS ano, genero, count(id) AS filmes_por_genero,
           {rounded(weighted("nota_media", "total_votos"), 2)} AS media_ponderada_anual,
           {rounded(mean("nota_media"), 2)} AS media_simples_anual
    FROM by_genre WHERE total_votos > 0 GROUP BY 1, 2
)"""

FILMS_PER_YEAR = f"SELECT count(*) AS numero_filmes, {YEAR} AS ano FROM films GROUP BY 2"

POPULARITY_BY_YEAR = f"""
SELECT {YEAR} AS ano, {rounded(mean("popularidade"), 2)} AS media_popularidade,
       count(*) AS qtd_filmes
FROM films GROUP BY 1"""

POPULARITY_BY_GENRE = f"""
SELECT genero, {rounded(mean("popularidade"), 2)} AS media_popularidade, count(*) AS qtd_filmes
FROM by_genre GROUP BY genero"""

DIFFERENCE = f"""{weighted("media_ponderada_anual", "filmes_por_genero")} - {mean("media_simples_anual")}"""

RATING_PATTERN = f"""
SELECT genero,
       CAST(sum(filmes_por_genero) AS BIGINT) AS numero_filmes,
       min(ano) AS ano_inicial,
       max(ano) AS ano_final,
       {rounded(weighted("media_ponderada_anual", "filmes_por_genero"), 2)}
           AS media_ponderada_geral,
       {rounded(mean("media_simples_anual"), 2)} AS media_simples_geral,
       {rounded(DIFFERENCE, 2)} AS diferenca_medias
FROM yearly GROUP BY genero"""

TOP_FILMS = """
SELECT genero, titulo, round(nota_media, 2) AS nota_media, ranking
FROM (
    SELECT *, CAST(rank() OVER (PARTITION BY genero ORDER BY nota_media DESC NULLS LAST)
                   AS INTEGER) AS ranking
    FROM by_genre WHERE total_votos > 150
) WHERE ranking <= 3"""

TOP_GENRES = f"""
SELECT ano, rank_do_genero, genero, media_nota_ano
FROM (
    SELECT *, CAST(rank() OVER (PARTITION BY ano ORDER BY media_nota_ano DESC NULLS LAST)
                   AS INTEGER) AS rank_do_genero
    FROM (
        SELECT {YEAR} AS ano, genero, {rounded(mean("nota_media"), 1)} AS media_nota_ano
        FROM by_genre GROUP BY 1, 2
    )
) WHERE rank_do_genero <= 3"""

GENRES_TEXT = """
SELECT titulo, popularidade, nota_media, string_agg(genero, ', ' ORDER BY genero) AS generos
FROM by_genre GROUP BY id, titulo, popularidade, nota_media"""

KNOWN = """
known AS (
    SELECT n_nationkey AS id FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name {condition}
)"""

LABEL_CASES = """CASE original_language WHEN 'fr' THEN 'Francês' WHEN 'fa' THEN 'Persa'
            WHEN 'or' THEN 'Oriya' END"""

SILVER = f"""
        SELECT clean.id, title AS titulo, {LABEL_CASES} AS idioma_original,
               release_date AS data_lancamento, popularity AS popularidade,
               vote_average AS nota_media, vote_count AS total_votos,
               genre_count, genre_id_sum
        FROM clean LEFT JOIN (
            SELECT id_filme, count(*) AS genre_count,
                   CAST(sum(id_genero) AS BIGINT) AS genre_id_sum
            FROM clean_pairs WHERE id_genero IN (SELECT id FROM genres) GROUP BY id_filme
        ) ON id_filme = clean.id"""

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


def contents(name: str, labels: str, number: str, result: str) -> str:
    return f"SELECT '{name}' AS result, concat_ws('|', {labels}) AS label, CAST({number} AS DOUBLE) AS number FROM ({result})"


ORACLE: dict[str, str] = {
    "films_per_year": f"WITH {FILMS} {FILMS_PER_YEAR}",
    "votes_by_language": f"""WITH {FILMS}
        SELECT {rounded(mean("total_votos"), 2)} AS media_votos, idioma_original
        FROM films GROUP BY idioma_original""",
    "popularity_by_year": f"WITH {FILMS} {POPULARITY_BY_YEAR}",
    "popularity_by_genre": f"WITH {BY_GENRE} {POPULARITY_BY_GENRE}",
    "yearly_genre_ratings": f"WITH {BY_GENRE}, {YEARLY} SELECT * FROM yearly",
    "rating_pattern": f"WITH {BY_GENRE}, {YEARLY} {RATING_PATTERN}",
    "top_films_by_genre": f"WITH {BY_GENRE} {TOP_FILMS}",
    "top_genres_by_year": f"WITH {BY_GENRE} {TOP_GENRES}",
    "top_events_by_type": """
        SELECT event_id, event_type, value, ranking FROM (
            SELECT event_id, event_type, round(value) AS value,
                   CAST(rank() OVER (PARTITION BY event_type ORDER BY round(value) DESC NULLS LAST)
                        AS INTEGER) AS ranking
            FROM events
        ) WHERE ranking <= 3""",
    "top_lines_by_order": """
        SELECT l_orderkey, l_linenumber, l_quantity, ranking FROM (
            SELECT l_orderkey, l_linenumber, l_quantity,
                   CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC NULLS LAST) AS INTEGER) AS ranking
            FROM lineitem
        ) WHERE ranking <= 2""",
    "genres_text_per_film": f"WITH {BY_GENRE} {GENRES_TEXT}",
    "row_counts": f"""WITH {FILMS}, {GENRES}, {PAIRS}
        SELECT 'filmes' AS table_name, count(*) AS row_count FROM films
        UNION ALL SELECT 'generos', count(*) FROM genres
        UNION ALL SELECT 'filmes_generos', count(*) FROM pairs""",
    "first_films": f"""WITH {FILMS}
        SELECT * REPLACE (CAST(data_lancamento AS VARCHAR) AS data_lancamento)
        FROM films ORDER BY id LIMIT 20""",
    "first_genres": f"WITH {GENRES} SELECT * FROM genres ORDER BY id LIMIT 20",
    "first_pairs": f"""WITH {PAIRS}
        SELECT * FROM pairs ORDER BY id_filme, id_genero LIMIT 20""",
    "schema_rows": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{type_}' AS column_type, count(*) FILTER (WHERE {name} IS NULL) AS null_count FROM orders"
        for name, type_ in ORDER_TYPES.items()
    ),
    "sample_rows": "SELECT * FROM documents ORDER BY doc_id LIMIT 5",
    "genres_of_title": f"""WITH {BY_GENRE}
        SELECT id AS id_filme, titulo, genero, id_genero FROM by_genre
        WHERE titulo = 'Order#42'""",
    "genres_of_title_any_case": f"""WITH {BY_GENRE}
        SELECT id AS id_filme, titulo, genero, id_genero FROM by_genre
        WHERE lower(titulo) = lower('ORDER#42')""",
    "language_label": """
        SELECT doc_id,
               CASE lang WHEN 'en' THEN 'Inglês' WHEN 'fr' THEN 'Francês'
                         WHEN 'de' THEN 'Alemão' WHEN 'es' THEN 'Espanhol' END AS label,
               CASE lang WHEN 'en' THEN 'Inglês' WHEN 'fr' THEN 'Francês' END AS partial_label
        FROM documents""",
    "local_row_labels": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open'
                                  WHEN 'P' THEN 'part' END AS label,
               count(*) AS order_count
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""",
    "sql_over_tables": f"""WITH {FILMS}, {PAIRS}, per_film AS (
            SELECT id, {YEAR} AS ano, count(*) AS genre_count
            FROM films JOIN pairs ON id_filme = id GROUP BY 1, 2
        ), per_year AS (
            SELECT ano, max(genre_count) AS most_genres, count(*) AS with_genres
            FROM per_film GROUP BY ano
        ), released AS ({FILMS_PER_YEAR})
        SELECT ano, numero_filmes, with_genres, most_genres
        FROM released JOIN per_year USING (ano)""",
    "dedupe_lines": """
        SELECT * EXCLUDE (copy_number)
               REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 00:00:00' AS l_shipdate)
        FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
                l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST,
                l_suppkey DESC NULLS LAST, l_linenumber DESC NULLS LAST,
                l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
                l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST,
                l_shipdate DESC NULLS LAST) AS copy_number
            FROM lineitem
        ) WHERE copy_number = 1""",
    "dedupe_any": "SELECT DISTINCT l_orderkey, CAST(1 AS BIGINT) AS kept, CAST(1 AS BIGINT) AS whole FROM lineitem",
    "distinct_pairs": f"""WITH {RAW}
        SELECT DISTINCT id AS id_filme, unnest(genre_ids) AS id_genero FROM raw""",
    "clean_valid": f"WITH {CLEAN} SELECT * EXCLUDE (genre_ids) FROM clean",
    "clean_after_dedupe": f"""WITH {RAW}
        SELECT {CLEAN_COLUMNS} FROM (SELECT *, {COPY} FROM raw)
        WHERE copy_number = 1 AND {VALID}""",
    "cleaning_audit": f"""WITH {RAW}
        SELECT count(*) AS rows_in,
               count(*) FILTER (WHERE {VALID}) AS rows_valid,
               count(*) FILTER (WHERE id IS NULL) AS no_id,
               count(*) FILTER (WHERE coalesce(trim(title), '') = '') AS no_title,
               count(*) FILTER (WHERE genre_ids IS NULL) AS no_genres,
               count(*) FILTER (WHERE coalesce(trim(release_date), '') = '') AS no_date,
               count(*) FILTER (WHERE trim(release_date) <> ''
                                AND TRY_CAST(release_date AS DATE) IS NULL) AS bad_date,
               count(*) FILTER (WHERE TRY_CAST(release_date AS DATE) > DATE '2001-01-01')
                   AS future_date
        FROM raw""",
    "explode_genres": f"WITH {CLEAN} SELECT * FROM clean_pairs",
    "clean_by_genre": f"""WITH {CLEAN}, {GENRES}
        SELECT clean.id, title, id_genero, genero
        FROM clean JOIN clean_pairs ON id_filme = clean.id JOIN genres ON genres.id = id_genero""",
    "valid_genre_pairs": f"""WITH {PAIRS}, {KNOWN.format(condition="= 'ASIA'")}
        SELECT * FROM pairs WHERE id_genero IN (SELECT id FROM known)""",
    "no_valid_genres": f"""WITH {PAIRS}, {KNOWN.format(condition="= 'ATLANTIS'")}
        SELECT 'read' AS step, count(*) AS pair_count FROM pairs
        UNION ALL
        SELECT 'kept', count(*) FROM pairs WHERE id_genero IN (SELECT id FROM known)""",
    "fk_violations": f"""WITH {PAIRS}, {KNOWN.format(condition="<> 'ASIA'")}
        SELECT * FROM pairs
        WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.id = pairs.id_genero)""",
    "pk_violations": """
        SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey
        HAVING count(*) > 1 OR l_orderkey IS NULL""",
    "composite_pk_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "length_violations": """
        SELECT doc_id, 'text' AS column_name, length(text) AS text_length,
               CAST(255 AS BIGINT) AS max_length FROM documents WHERE length(text) > 255
        UNION ALL
        SELECT doc_id, 'source', length(source), 4 FROM documents WHERE length(source) > 4
        UNION ALL
        SELECT doc_id, 'lang', length(lang), 50 FROM documents WHERE length(lang) > 50""",
    "contract_report": f"""WITH {FILMS}, {GENRES}, {PAIRS}
        SELECT 'films key' AS contract, count(*) AS violations
        FROM (SELECT id FROM films GROUP BY id HAVING count(*) > 1 OR id IS NULL)
        UNION ALL
        SELECT 'genres key', count(*)
        FROM (SELECT id FROM genres GROUP BY id HAVING count(*) > 1 OR id IS NULL)
        UNION ALL
        SELECT 'film_genres key', count(*)
        FROM (SELECT 1 FROM pairs GROUP BY id_filme, id_genero
              HAVING count(*) > 1 OR id_filme IS NULL OR id_genero IS NULL)
        UNION ALL
        SELECT 'films text', count(*) FILTER (WHERE length(titulo) > 255)
               + count(*) FILTER (WHERE length(idioma_original) > 50) FROM films
        UNION ALL
        SELECT 'genres text', count(*) FILTER (WHERE length(genero) > 25) FROM genres
        UNION ALL
        SELECT 'film_genres to films', count(*) FROM pairs
        WHERE NOT EXISTS (SELECT 1 FROM films WHERE films.id = id_filme)
        UNION ALL
        SELECT 'film_genres to genres', count(*) FROM pairs
        WHERE NOT EXISTS (SELECT 1 FROM genres WHERE genres.id = id_genero)""",
    "conform_types": f"""WITH {FILMS}
        SELECT * REPLACE (CAST(data_lancamento AS VARCHAR) AS data_lancamento) FROM films""",
    "rejected_rows": """
        SELECT 'id' AS column_name, 'does not cast' AS reason, count(*) AS row_count
        FROM orders WHERE o_orderkey % 97 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'id', 'NULL', count(*) FROM orders
        WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'titulo', 'too long', count(*) FROM orders
        WHERE o_orderkey % 83 = 0 AND 60 * length('Order#' || o_orderkey) > 255 HAVING count(*) > 0
        UNION ALL SELECT 'data_lancamento', 'does not cast', count(*) FROM orders
        WHERE o_orderkey % 79 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'nota_media', 'does not cast', count(*) FROM orders
        WHERE o_orderkey % 73 = 0 AND o_orderkey % 2 = 0 HAVING count(*) > 0
        UNION ALL SELECT '', 'kept', count(*) FROM orders
        WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0 AND o_orderkey % 79 <> 0
          AND (o_orderkey % 73 <> 0 OR o_orderkey % 2 <> 0)""",
    "union_by_name": """
        SELECT c_mktsegment AS segment, c_custkey AS id, c_nationkey AS nation,
               c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL
        SELECT NULL, s_suppkey, s_nationkey, s_name, s_acctbal FROM supplier""",
    "sorted_page": f"""WITH {CATALOGUE}
        SELECT * FROM catalogue ORDER BY release_date DESC, id LIMIT 200 OFFSET 40""",
    "extract_pages": f"WITH {CATALOGUE} SELECT * FROM ({EXTRACTS}) WHERE position <= 40",
    "last_pages": f"""WITH {CATALOGUE} SELECT * FROM ({EXTRACTS})
        WHERE position > (SELECT (count(*) - 1) // 20 * 20 FROM catalogue)""",
    "union_of_extracts": f"WITH {CATALOGUE} {EXTRACTS}",
    "jsonl_roundtrip": f"""WITH {RAW}
        SELECT id, title, original_language, release_date,
               array_to_string(genre_ids, ',') AS genre_ids,
               popularity, vote_average, vote_count
        FROM raw""",
    "collected_extracts": f"""WITH {CATALOGUE}, extracts AS ({EXTRACTS})
        SELECT DISTINCT id, title, popularity, vote_count FROM extracts""",
    "json_array_roundtrip": f"""WITH {GENRES}, {PAIRS}
        SELECT id, genero, count(*) AS film_count
        FROM genres JOIN pairs ON id_genero = id GROUP BY id, genero""",
    "json_arrays": "SELECT o_orderkey AS id, o_orderpriority AS genero FROM orders",
    "empty_input": f"""WITH {RAW}
        SELECT '*.json' AS table_name, count(*) AS row_count FROM raw
        UNION ALL SELECT '*.none', 0""",
    "parquet_roundtrip": f"""WITH {PAIRS}
        SELECT * FROM pairs UNION ALL SELECT * FROM pairs""",
    "csv_roundtrip": "SELECT doc_id, text, lang FROM documents",
    "silver_tables": f"WITH {CLEAN}, {GENRES} {SILVER}",
    # a film that both batches hold keeps the best copy of the first
    "silver_appended": f"WITH {CLEAN.replace(COPY, COPY.replace('popularity DESC', 'revenue % 2, popularity DESC', 1))}, {GENRES} {SILVER}",
    "gold_export_status": f"""WITH {BY_GENRE}, {YEARLY}
        SELECT 'filmes_lancados_por_ano' AS name, true AS ok, count(*) AS row_count
        FROM ({FILMS_PER_YEAR})
        UNION ALL SELECT 'padrao_avaliacao', true, count(*) FROM ({RATING_PATTERN})
        UNION ALL SELECT 'top_filmes_por_genero', true, count(*) FROM ({TOP_FILMS})
        UNION ALL SELECT 'top_generos_por_ano', true, count(*) FROM ({TOP_GENRES})
        UNION ALL SELECT 'popularidade_vs_nota_media', true, count(*) FROM ({GENRES_TEXT})
        UNION ALL SELECT 'popularidade_por_ano', true, count(*) FROM ({POPULARITY_BY_YEAR})
        UNION ALL SELECT 'generos_por_popularidade', true, count(*) FROM ({POPULARITY_BY_GENRE})""",
    "gold_contents": f"WITH {BY_GENRE}, {YEARLY} " + " UNION ALL ".join([
        contents("filmes_lancados_por_ano", "ano", "numero_filmes", FILMS_PER_YEAR),
        contents(
            "padrao_avaliacao", "genero, numero_filmes, ano_inicial, ano_final", "diferenca_medias", RATING_PATTERN
        ),
        contents("top_filmes_por_genero", "genero, titulo, ranking", "nota_media", TOP_FILMS),
        contents("top_generos_por_ano", "ano, rank_do_genero, genero", "media_nota_ano", TOP_GENRES),
        contents(
            "popularidade_vs_nota_media", "titulo, round(nota_media, 2), generos", "popularidade", GENRES_TEXT
        ),
        contents("popularidade_por_ano", "ano, qtd_filmes", "media_popularidade", POPULARITY_BY_YEAR),
        contents("generos_por_popularidade", "genero, qtd_filmes", "media_popularidade", POPULARITY_BY_GENRE),
    ]),
    "gold_order": f"""WITH {BY_GENRE}
        SELECT 'popularidade_por_ano' AS result, count(*) AS row_count, CAST(0 AS BIGINT) AS astray FROM ({POPULARITY_BY_YEAR})
        UNION ALL SELECT 'generos_por_popularidade', count(*), 0 FROM ({POPULARITY_BY_GENRE})
        UNION ALL SELECT 'popularidade_vs_nota_media', count(*), 0 FROM ({GENRES_TEXT})""",
    "export_without_views": """
        SELECT 0 AS given, CAST(0 AS BIGINT) AS views, CAST(0 AS BIGINT) AS row_count
        UNION ALL SELECT 1, 1, count(DISTINCT o_orderpriority) FROM orders""",
    "export_isolation": """
        SELECT 'isolated_fails' AS name, false AS ok, CAST(NULL AS BIGINT) AS row_count
        UNION ALL SELECT 'isolated_works', true, count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderpriority)""",
}
