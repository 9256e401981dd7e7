"""Which tokens of two tokenizers stand for the same bytes, over a whole corpus.

Both tokenizers read a blank and the text. A encodes both; B puts the blank there itself.
The bytes of their tokens are laid side by side. Offsets where tokens of both end cut them into
groups; a token of A and one of B whose bytes overlap are linked. Between two neighbouring ends, of
either, lies exactly one link, so the links of a text are as many as its distinct ends.

The count of an id pair is the number of documents, repeated rows included, that hold it linked
at least once. Most links are groups of one token each with the same bytes. Their pair follows
from A's id alone, by an array made once (``Tokens.same``), so their counts are a vector as long as
A's vocabulary, which every task can hold. Only the other pairs go through a shuffle. To look
their counts up again, those of frequent pairs are handed to all tasks: pairs counted at least
(all counts / ``FREQUENT``) times, of which there can't be more than ``FREQUENT``; what is left has no
hot key and meets its counts in a join.

Texts that are NULL or empty, and those whose tokens of A or B don't join to the bytes of the
blank and the text (B takes U+2581 for a blank, for instance), have no tokens: zeros, and an empty digest.
Very long texts are taken whole, by the task that holds them. Repeated rows and ids stay rows of
their own. Of the table only the two named columns are used, whatever else it has. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# pairs whose counts every task holds
FREQUENT = 100_000
# bytes of text aligned at once; a longer text is still taken whole
TOGETHER = 1 << 20

_ALIGNED = (
    "row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_n array<int>, other array<long>, other_n array<int>"
)
_RATED = (
    "row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_best long, count_sum long, rare array<long>, rare_n array<int>"
)


def _byte_level(token: str, places: dict[str, int]) -> bytes:
    return bytes(places[c] for c in token)


def _byte_places() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return signs


class Tokens:
    """Both tokenizers, the bytes of their tokens, and which tokens have the same."""

    def __init__(self, byte_level: str, byte_ranks: str, pieces: str) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding(
            "byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as vocabulary:
            entries = json.load(vocabulary)["model"]["vocab"]
        places = _byte_places()
        size = max(entries.values()) + 1
        self.bytes_a = [b""] * size
        for token, i in entries.items():
            if all(c in places for c in token):
                self.bytes_a[i] = _byte_level(token, places)
        if any(self.bytes_a[i] != token for token, i in ranks.items()):
            raise ValueError(f"{byte_ranks} and {byte_level} hold different vocabularies")
        count = self.b.get_piece_size()
        single = [self.b.is_byte(i) for i in range(count)]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if one else piece.replace("▁", " ").encode()
            for piece, one in zip(map(self.b.id_to_piece, range(count)), single, strict=True)
        ]
        self.n_b = count
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # of two tokens of B with the same bytes, the piece and not the single byte is the one
        named: dict[bytes, int] = {}
        for wanted in (True, False):
            for i in range(count):
                if single[i] == wanted and not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                    named[self.bytes_b[i]] = i
        self.same = np.array([named.get(x, -1) if x else -1 for x in self.bytes_a], dtype=np.int64)
        # ids as text, with the sign that follows: an id of A inside its group and at its end, then those of B
        self.written = (
            [f"{i}," for i in range(size)]
            + [f"{i}|" for i in range(size)]
            + [f"{i}," for i in range(count)]
            + [f"{i};" for i in range(count)]
        )


@cache
def tokens(byte_level: str, byte_ranks: str, pieces: str) -> Tokens:
    """Both tokenizers of this worker process, read once."""
    return Tokens(byte_level, byte_ranks, pieces)


def _places(values: np.ndarray, sorted_ends: np.ndarray) -> np.ndarray:
    """Which of the sorted ends each value is, or -1."""
    at = np.searchsorted(sorted_ends, values)
    return np.where(sorted_ends[np.minimum(at, len(sorted_ends) - 1)] == values, at, -1)


def _per_text(text: np.ndarray, value: np.ndarray, times: np.ndarray, n: int) -> tuple[list, list]:
    """Split sorted triples by their text."""
    cuts = np.searchsorted(text, np.arange(1, n))
    return np.split(value, cuts), np.split(times, cuts)


def align(model: Tokens, texts: list[str]) -> pd.DataFrame:
    """Groups and links of texts, one row a text; ``same`` and ``other`` hold its distinct linked pairs."""
    n = len(texts)
    ids_a = model.a.encode_ordinary_batch([" " + x for x in texts], num_threads=1)
    ids_b = model.b.encode(texts, num_threads=1)
    for i, text in enumerate(texts):
        raw = b" " + text.encode("utf-8", "surrogatepass")
        whole = text and b"".join(map(model.bytes_a.__getitem__, ids_a[i])) == raw
        if not whole or b"".join(map(model.bytes_b.__getitem__, ids_b[i])) != raw:
            ids_a[i], ids_b[i] = [], []
    n_a = np.array([len(x) for x in ids_a], dtype=np.int64)
    n_b = np.array([len(x) for x in ids_b], dtype=np.int64)
    a = np.array([x for ids in ids_a for x in ids], dtype=np.int64)
    b = np.array([x for ids in ids_b for x in ids], dtype=np.int64)
    out = pd.DataFrame({"n_a": n_a, "n_b": n_b})
    if not len(a):
        out["n_groups"], out["n_links"], out["groups_sha256"] = 0, 0, ""
        for name in ("same", "same_n", "other", "other_n"):
            out[name] = [[] for _ in texts]
        return out
    # all texts as one line of bytes: a text ends where tokens of both end, so nothing reaches over
    ends_a, ends_b = np.cumsum(model.length_a[a]), np.cumsum(model.length_b[b])
    ends = np.union1d(ends_a, ends_b)
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    text = text_a[at_a]
    closes = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
    out["n_groups"] = np.bincount(text[closes], minlength=n)
    out["n_links"] = np.bincount(text, minlength=n)

    # the digest's text: after a token of A, all of B's tokens that end no later have been written, if its group ends
    group_ends = ends[closes]
    group_a = np.searchsorted(group_ends, ends_a)
    group_b = np.searchsorted(group_ends, ends_b)
    last_a, last_b = group_ends[group_a] == ends_a, group_ends[group_b] == ends_b
    before_a = np.searchsorted(group_b, group_a)  # tokens of B in groups before
    before_b = np.searchsorted(group_a, group_b, side="right")  # tokens of A in groups up to this one
    size = len(model.bytes_a)
    pieces = np.empty(len(a) + len(b), dtype=np.int64)
    pieces[np.arange(len(a)) + before_a] = a + size * last_a
    pieces[np.arange(len(b)) + before_b] = 2 * size + b + model.n_b * last_b
    pieces = pieces.tolist()
    stops = np.cumsum(n_a + n_b).tolist()
    digests, start = [], 0
    written = model.written.__getitem__
    for stop in stops:
        line = "".join(map(written, pieces[start:stop]))[:-1]
        digests.append(hashlib.sha256(line.encode()).hexdigest() if line else "")
        start = stop
    out["groups_sha256"] = digests

    pair = a[at_a] * model.n_b + b[at_b]
    key = text * (size * model.n_b) + pair
    key, times = np.unique(key, return_counts=True)
    text, pair = np.divmod(key, size * model.n_b)
    regular = model.same[pair // model.n_b] == pair % model.n_b
    times = times.astype(np.int32)
    first = pair // model.n_b
    out["same"], out["same_n"] = _per_text(text[regular], first[regular].astype(np.int32), times[regular], n)
    out["other"], out["other_n"] = _per_text(text[~regular], pair[~regular], times[~regular], n)
    return out


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > TOGETHER:
            yield first, i
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, len(texts)


def _aligned(paths: tuple[str, str, str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = tokens(*paths)
        for batch in batches:
            texts = [x or "" for x in batch["text"]]
            for first, last in _chunks(texts):
                out = align(model, texts[first:last])
                out["row"] = batch["row"].to_numpy()[first:last]
                out["doc_id"] = batch["doc_id"].to_numpy()[first:last]
                yield out

    return run


def _rated(same_count: np.ndarray, best: np.ndarray, pairs: np.ndarray, counts: np.ndarray, n_b: int):
    """Sum up what vectors and frequent pairs tell; hand on the rare pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = len(batch)
            n_best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)

            def add(row: np.ndarray, first: np.ndarray, count: np.ndarray, times: np.ndarray) -> None:
                np.add.at(total, row, count * times)
                np.add.at(n_best, row, np.where(count == best[first], times, 0))

            sizes = [len(x) for x in batch["same"]]
            if sum(sizes):
                ids = np.concatenate(batch["same"].to_numpy()).astype(np.int64)
                times = np.concatenate(batch["same_n"].to_numpy()).astype(np.int64)
                add(np.repeat(np.arange(n), sizes), ids, same_count[ids], times)
            batch["rare"], batch["rare_n"] = [[]] * n, [[]] * n
            sizes = [len(x) for x in batch["other"]]
            if sum(sizes):
                own = np.concatenate(batch["other"].to_numpy()).astype(np.int64)
                times = np.concatenate(batch["other_n"].to_numpy()).astype(np.int64)
                row = np.repeat(np.arange(n), sizes)
                at = _places(own, pairs) if len(pairs) else np.full(len(own), -1)
                known = at >= 0
                add(row[known], own[known] // n_b, counts[at[known]], times[known])
                rare = _per_text(row[~known], own[~known], times[~known], n)
                batch["rare"], batch["rare_n"] = rare
            batch["n_best"], batch["count_sum"] = n_best, total
            yield batch.drop(columns=["same", "same_n", "other", "other_n"])

    return run


def _vectors(size: int):
    """Documents that hold each id of A in a regular link, added up within the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            if len(batch):
                ids = np.concatenate(batch["same"].to_numpy()).astype(np.int64)
                total += np.bincount(ids, minlength=size)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"first": held, "n": total[held]})

    return run


def align_tokens(
    docs: DataFrame,
    byte_level: str = BYTE_LEVEL,
    byte_ranks: str = BYTE_RANKS,
    pieces: str = PIECES,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row of ``docs``: its tokens, groups and links, how many of these are the best known for their id of A.

    ``n_best`` counts links whose pair's count is the highest of all pairs with that id of A,
    ties included; ``count_sum`` adds the counts of all links.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    paths = (byte_level, byte_ranks, pieces)
    model = tokens(*paths)
    size, n_b = len(model.bytes_a), model.n_b
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    aligned = scratch.keep(source.mapInPandas(_aligned(paths), _ALIGNED.format(id=kind)), "aligned")

    same_count = np.zeros(size, dtype=np.int64)
    regular = aligned.select("same").mapInPandas(_vectors(size), "first long, n long")
    for first, n in regular.groupBy("first").agg(F.sum("n")).collect():  # no more rows than A has ids
        same_count[first] = n
    counts = scratch.keep(
        aligned.select(F.explode("other").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    best = same_count.copy()
    first_id = F.floor(F.col("pair") / n_b).cast("int")
    highest = counts.groupBy(first_id.alias("first")).agg(F.max("n").alias("n"))
    for first, n in highest.collect():
        best[first] = max(best[first], n)
    everything = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.filter(F.col("n") * frequent >= everything).toPandas().sort_values("pair")
    rated = scratch.keep(
        aligned.mapInPandas(
            _rated(same_count, best, known["pair"].to_numpy("int64"), known["n"].to_numpy("int64"), n_b),
            _RATED.format(id=kind),
        ),
        "rated",
    )
    scratch.drop("aligned")
    top = spark.createDataFrame(
        pd.DataFrame({"first": np.arange(size), "highest": best}), "first int, highest long"
    )
    rare_counts = (
        counts.filter(F.col("n") * frequent < everything)
        .withColumn("first", first_id)
        .join(F.broadcast(top), "first")  # a row for each id of A
        .select("pair", "n", (F.col("n") == F.col("highest")).alias("is_best"))
    )
    rare = rated.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("link")).select(
        "row", F.col("link.rare").alias("pair"), F.col("link.rare_n").alias("times")
    )
    more = (
        rare.join(rare_counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.col("times")).alias("more_sum"),
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
        )
    )
    return rated.join(more, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
