"""Raw documents to packed training sequences, in five stages.

Each stage takes and, but for the last, returns a table with the columns of ``documents``; its
result is written and read again before the next one starts. All its decisions take effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.llm import langid, leaks, near, packing, substrings
from filmlake.llm.steps import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# a text is rejected if fewer of its n-grams belong to the language it is taken for
KNOWN = 0.3
# documents that a Python worker takes at once
BATCH_ROWS = 1000


def _documents(docs: DataFrame) -> DataFrame:
    """The stage's input; Python gets it in small batches, so that a worker holds few texts at a time."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(*(docs[name] for name in COLUMNS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those in none of the languages that the labels know.

    A language learned from too few n-grams to tell what is not in it rejects nothing.
    """
    docs = _documents(docs)
    filters = langid.fit(docs)
    named = langid.predict(docs.withColumn("_copy", F.col("text")), filters, text="_copy")
    keep = (F.col("lang_pred") != langid.UNKNOWN) & ((F.col("known") >= KNOWN) | F.col("lang_pred").isin(filters.few))
    # without any labelled text nothing is known to reject by, but for texts without letters
    return _documents(named.filter(keep if filters.languages else F.col("text").rlike(r"\p{L}")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Rows with an id and text that were there before go too. NULL ids in a group
    of nothing else stay, one of each text.
    """
    docs = _documents(docs).withColumn("_tid", F.xxhash64("text"))
    kept = near.near_duplicates(docs).filter("kept")
    # rows of one id are one document's, even with different texts in a group
    kept = kept.groupBy(
        "doc_id", F.when(F.col("doc_id").isNull(), F.col("tid")).alias("alone"), "component_id"
    ).agg(F.min("tid").alias("tid"))
    kept = kept.select(F.col("doc_id").alias("_kept"), F.col("tid").alias("_kept_tid")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_tid") == F.col("_kept_tid"))
    return _documents(docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_tid"]))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under repeated windows go; texts without such stay as they are."""
    out = substrings.remove_repeats(_documents(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return _documents(out.withColumns({"n_chars": changed, "text": text}))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    docs = _documents(docs)
    found = leaks.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.select(F.col("doc_id").alias("_gone"), F.col("tid").alias("_gone_tid")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.xxhash64("text") == F.col("_gone_tid"))
    return _documents(docs.join(gone, same, "left_anti"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of what is left, in sequences of 4096 tokens."""
    return packing.pack(_documents(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeats),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs


# tokens and parses have no form in SQL
ORACLE_SQL = None
