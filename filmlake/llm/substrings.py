"""Removal of long repeated word sequences, found by recompression.

Rows: every text gives the words its own and all other texts leave it. A window of
``width`` words that starts in two places, of one text or of two, is repeated, and
every word under a repeated window is removed. NULL and empty texts have no words;
texts of fewer than ``width`` words keep all. Copies of a row count as places of
their own, so a text of at least ``width`` words that is there twice loses all its
words. Blanks between words are not compared. NULL ids and other columns play no part.

Steps, none of which brings the rows of one name or window together in a task:

1. Equal texts are folded into one, with the number of copies.
2. Each text is parsed by recompression; its windows choose high-level symbols
   (``recompression.choose``), a tenth as many as there are words.
3. Names chosen once in all the corpus settle that their windows are unique.
4. The other windows are compared by a hash of all their words.
5. Places of repeated windows go back to their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm import recompression
from filmlake.llm.steps import Scratch
from filmlake.llm.words import encoded, hashed, rolling

WIDTH = 35
ID = ("_id1", "_id2")

_CHOSEN = "name long, _id1 long, _id2 int, first int, windows int, weight int"
_WINDOWS = "window long, proof int, _id1 long, _id2 int, first int"


def _text_id(text: str) -> dict:
    """96 bits that stand for a text."""
    second = F.xxhash64(F.lit(1), F.col(text))
    return {
        ID[0]: F.xxhash64(F.col(text)),
        ID[1]: F.shiftright(second, 32).cast("int"),
    }


def _chosen(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [batch[name].to_numpy() for name in ID]
            for first, _, words, bounds in hashed([encoded(x) for x in batch["text"]]):
                texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                name, start, windows, weight = recompression.choose(words, texts, bounds, width)
                text = texts[start]
                yield pd.DataFrame({
                    "name": name.view(np.int64),
                    ID[0]: ids[0][first + text],
                    ID[1]: ids[1][first + text],
                    "first": (start - bounds[text]).astype(np.int32),
                    "windows": windows.astype(np.int32),
                    "weight": weight.astype(np.int32),
                })

    return run


def _windows(width: int):
    """Hashes of the windows in question, with part of a second one as proof."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [batch[name].to_numpy() for name in ID]
            firsts, counts = batch["firsts"].tolist(), batch["counts"].tolist()
            for first, last, words, bounds in hashed([encoded(x) for x in batch["text"]]):
                start = np.concatenate([firsts[i] + bounds[i - first] for i in range(first, last)])
                count = np.concatenate([counts[i] for i in range(first, last)])
                owner = np.repeat(np.arange(first, last), [len(firsts[i]) for i in range(first, last)])
                steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                place, owner = np.repeat(start, count) + steps, np.repeat(owner, count)
                proof = rolling(words ^ np.uint64(0xC2B2AE3D27D4EB4F), width)[place] >> np.uint64(33)
                yield pd.DataFrame({
                    "window": rolling(words, width)[place].view(np.int64),
                    "proof": proof.astype(np.int32),
                    ID[0]: ids[0][owner],
                    ID[1]: ids[1][owner],
                    "first": (place - bounds[owner - first]).astype(np.int32),
                })

    return run


def _kept(width: int, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, copies, firsts in zip(batch["text"], batch["copies"], batch["firsts"], strict=True):
                words = encoded(text).split()
                n = len(words)
                if copies > 1 and n >= width:
                    kept = []
                elif firsts is not None and len(firsts):
                    edges = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edges, firsts, 1)
                    np.add.at(edges, np.asarray(firsts) + width, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:n]) == 0)]
                else:
                    kept = words
                raw = b" ".join(kept)
                value = raw.decode("utf-8", "surrogatepass") if with_text else None
                rows.append((n, n - len(kept), hashlib.sha256(raw).hexdigest(), value))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])
            for name in ID:
                out[name] = batch[name].to_numpy()
            yield out if with_text else out.drop(columns="kept_text")

    return run


def repeated_windows(texts: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """For each text with repeated windows, the words at which these start."""
    chosen = scratch.keep(texts.select(*ID, "text").mapInPandas(_chosen(width), _CHOSEN), "chosen")
    # written, so that the join can split a name or window that many texts share
    shared = scratch.keep(
        chosen.groupBy("name").agg(F.sum("weight").alias("n")).filter("n > 1").select("name"), "shared"
    )
    asked = (
        chosen.join(shared, "name", "left_semi")
        .groupBy(*ID)
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("windows").alias("counts"))
    )
    windows = scratch.keep(
        texts.select(*ID, "text")
        .join(asked.hint("shuffle_hash"), list(ID))
        .mapInPandas(_windows(width), _WINDOWS),
        "windows",
    )
    repeated = scratch.keep(
        windows.groupBy("window", "proof").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "repeated",
    )
    found = scratch.keep(
        windows.join(repeated, ["window", "proof"], "left_semi")
        .groupBy(*ID)
        .agg(F.collect_list("first").alias("firsts")),
        "found",
    )
    scratch.drop("chosen", "shared", "windows", "repeated")
    return found


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, text: str = "text", with_text: bool = True
) -> DataFrame:
    """All rows and columns of ``docs`` with what is left of each text.

    Adds ``n_words``, ``n_removed``, ``kept_sha256`` and, unless ``with_text`` is
    off, ``kept_text``: the kept words joined by single spaces; a column of
    ``docs`` of one of these names is replaced.
    """
    new = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    docs = docs.select(*(docs[c] for c in docs.columns if c not in (*new, *ID) or c == text))
    scratch = Scratch(docs.sparkSession, "substrings")
    texts = scratch.keep(
        docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumns(_text_id("text"))
        .groupBy(*ID)
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")),
        "texts",
        buckets=ID,
    )
    found = repeated_windows(texts, scratch, width)
    schema = "n_words long, n_removed long, kept_sha256 string, kept_text string, _id1 long, _id2 int"
    if not with_text:
        schema = schema.replace("kept_text string, ", "")
    kept = texts.join(found.hint("shuffle_hash"), list(ID), "left").mapInPandas(
        _kept(width, with_text), schema
    )
    rows = docs.withColumn("_whole", F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumns(_text_id("_whole")).drop("_whole")
    return rows.join(kept, list(ID)).select(*(c for c in docs.columns if c not in new), *new)
