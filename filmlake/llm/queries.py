"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.llm import (
    alignment,
    langid,
    leaks,
    near,
    nearest,
    packing,
    prefixes,
    quality,
    sharding,
    spelling,
    substrings,
    toxicity,
    urls,
)
from filmlake.llm.steps import part

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    """List a query under the name of its function."""
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words under windows of 35 that start in two places go."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, with_text=False).drop("text")


@query
def op9_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are alike to 0.85."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near.near_duplicates(docs, shingle=3, percent=85).drop("tid")


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Rules first, then the reputation of the host."""
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"))


ORACLE["op4_url_filters"] = urls.ORACLE

SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document, of 256."""
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS)


@query
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(part("doc_id", 3) != 1)
    weights = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("target")))
    held_out = F.coalesce(part("doc_id", 3) == 1, F.lit(False))
    return quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), weights)


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    weights, cuts = toxicity.fit(toxicity.grade_labels(docs, labels))
    return toxicity.severity(docs, weights, cuts)


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(part("doc_id", 4) == 2, F.lit(False))
    filters = langid.fit(docs.filter(~held_out).select("text", "lang"))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), filters)


@query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that leaked into documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return leaks.find_leaks(docs, table(spark, folder, "benchmark")).drop("tid")


@query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers, for every document."""
    return alignment.align_tokens(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are alike to 0.9."""
    return prefixes.jaccard_groups(table(spark, folder, "documents").select("doc_id", "text"))


def groups_sql(percent: int, more: str = "") -> str:
    """Groups by shingles of three words: all pairs that share one, and what links reach."""
    return rf"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= 3 THEN list_transform(
      range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
    ELSE [] END) AS shingle
  FROM texts
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= {percent} * (x.n + y.n - common.n)
), reached AS (
  SELECT a, b FROM links
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id{more}
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
"""


ORACLE["op9_minhash_near_dedup"] = groups_sql(85, ", doc_id <= coalesce(b, doc_id) AS kept")
ORACLE["op12_ngram_jaccard_join"] = groups_sql(90)


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, and the frequent words they are spellings of."""
    return spelling.group_spellings(table(spark, folder, "documents").select("doc_id", "text"))


ORACLE["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps
), runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), raw AS (
  SELECT run, n, hex(doc_id || ':' || run) AS h FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM raw, crc
), spoiled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spoiled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON rest = words.word
), near AS (
  SELECT pairs.word, count(*) AS n_near, min({'less': -n, 'near': near}) AS best
  FROM pairs JOIN words ON near = words.word GROUP BY pairs.word
), known AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.less >= 10 * n THEN best.near END AS form,
    CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN near USING (word)
), followed AS (
  SELECT word, word AS root FROM known
  UNION
  SELECT followed.word, known.form FROM followed JOIN known ON followed.root = known.word WHERE form IS NOT NULL
), roots AS (
  SELECT followed.word, followed.root FROM followed JOIN known ON followed.root = known.word WHERE known.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN roots USING (word)
"""
