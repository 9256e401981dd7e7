"""Packing of tokenized documents into sequences by best fit over a histogram of lengths.

Pieces and gaps are held sorted by size. Pieces of one length are alike, and so are gaps of
one size, so both are runs: a size, how many there are, and the rank of the first. Lengths are
taken from the longest down. In a step all pieces of a length look up their successor, the
smallest gap they fit in; where more pieces want it than there are gaps the lower ranks get
them and the others sweep on to the next larger gap, or open new sequences when there is none.
Then the gaps filled go back with the size that is left, and the next step begins.

The steps need only the counts of the lengths, as many numbers as a sequence has tokens,
however large the corpus. What they decide is a list of runs: pieces of a length from one
rank to another go to sequences from one number on, at one offset. The pieces get their
ranks in Spark, within small parts of a length, and look up their run; no length, however
common, meets in one task.

A NULL or empty text has the end token alone. Only documents longer than a sequence are cut.
Rows are taken as they are: repeated or NULL ids are separate documents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch
from filmlake.llm.tokens import TOKENIZER, tokenizer

CAPACITY = 4096
END = 1
# pieces of one length that are ranked together
PART_ROWS = 100_000


def tokenized(docs: DataFrame, capacity: int, path: str, with_ids: bool, key: str, text: str) -> DataFrame:
    """The pieces of every document, with their token ids if asked for."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids_crc32 long"
    schema += ", ids binary" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = tokenizer(path), np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            at, rows = [], []
            for i, raw in enumerate(own.ids(batch["text"].tolist())):
                raw += end
                for piece, first in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[first : first + 4 * capacity]
                    at.append(i)
                    rows.append((piece, first // 4, len(ids) // 4, crc32(ids), *([ids] if with_ids else [])))
            names = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = batch["doc_id"].take(at).array
            yield out

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)


def best_fit(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Runs ``length, first rank, pieces, first sequence, offset`` for so many pieces of each length."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: runs of sequences with that gap
    sizes: list[int] = []
    runs, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, there = gaps[gap].pop()
                taken = min(there, left)
                if taken < there:
                    gaps[gap].append((first + taken, there - taken))
                elif not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = capacity, opened
                taken = -(-left // (capacity // length))
                opened += taken
            runs.append((length, rank, taken, first, capacity - gap))
            rest = gap - length
            if rest:
                if rest not in gaps:
                    insort(sizes, rest)
                gaps.setdefault(rest, []).append((first, taken))
            rank, left = rank + taken, left - taken
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def _ranked(pieces: DataFrame, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """``rank`` of each piece among those of its length."""
    order = ["doc_id", "piece", "ids_crc32", "start"]
    parts = F.ceil(F.col("n") / PART_ROWS).cast("long")
    dealt = pieces.join(F.broadcast(counts), "length").withColumn(
        "part", F.pmod(F.xxhash64(*order), parts)
    )
    before = Window.partitionBy("length").orderBy("part")
    parts = scratch.keep(
        dealt.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("own"))
        .select("length", "part", (F.sum("own").over(before) - F.col("own")).alias("base")),
        "parts",
    )
    within = Window.partitionBy("length", "part").orderBy(*order)
    return (
        dealt.withColumn("rank", F.row_number().over(within))
        .join(parts, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("rank") - 1)
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    path: str = TOKENIZER,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every piece with its place: ``sequence_id`` and ``offset``; with ``ids``, the tokens too."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(tokenized(docs, capacity, path, with_ids, key, text), "pieces")
    # at most ``capacity`` rows
    counts = scratch.keep(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "counts")
    runs = best_fit({row.length: row.n for row in counts.collect()}, capacity)
    starts = runs[:, 0] * (1 << 40) + runs[:, 1]
    order = np.argsort(starts)
    starts, first_rank = starts[order], runs[order, 1]
    sequence, offset = runs[order, 3], runs[order, 4]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch["rank"].to_numpy()
            at = np.searchsorted(starts, batch["length"].to_numpy().astype(np.int64) * (1 << 40) + rank, side="right") - 1
            batch["sequence_id"] = sequence[at] + rank - first_rank[at]
            batch["offset"] = offset[at]
            yield batch.drop(columns="rank")

    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32"]
    columns += ["ids"] if with_ids else []
    ranked = _ranked(pieces, counts, scratch).select(*columns, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInPandas(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces packed with their ids.

    A group is one sequence, so it holds no more tokens than one has.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.size("parts").alias("n_pieces"),
        F.aggregate("parts", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids"),
    )
