"""Rare spellings and the frequent words that they are one code point away from.

Runs of letters (``A-Z``, ``a-z`` and U+00C0 to U+00FF) are taken from whole texts, A to Z
lower-cased. Of a run whose crc32 with its document's id 31 divides, one code point is left out.
Words are the distinct results of at least ``LEAST`` code points that occur at least twice. Two words are near if one
inserted, deleted or replaced code point makes one the other. A word's form is the most frequent of its
near words, if at least ``TIMES`` times as frequent as the word; its root is what forms lead to.

Near words are found by generated edits. Every task knows a Bloom filter of the vocabulary:
a shard for each length, in blocks of 64 bits, so that a probe reads one place. Each word's
edits, one code point left out or replaced by one later in the alphabet, are probed in the shard of their length,
all from the word's hash without writing them out; the other edits are those of the other word. Only edits
that the filter holds are written out and shuffled, to be joined with the vocabulary, which removes the false ones.

A filter takes at most ``FILTER_BYTES``. A larger vocabulary is dealt to several filters by hash, probed
one after another, so the broadcast is bounded and every edit is still looked for in the filter that would hold it.

NULL and empty texts have no words. A NULL id counts as an empty one in the crc32. Repeated rows count each.
Texts and runs of any length are taken whole. Ties of frequency go to the smallest word in code-point order; as a form is more
frequent than its word, forms never run in circles. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch
from filmlake.llm.words import encoded, mix

LEAST = 7
OCCURRENCES = 2
TIMES = 10
# one in so many runs loses a code point
SPOILED = 31
FILTER_BYTES = 32 << 20
BITS = 20  # of the filter per word
# words counted by a task before it hands them on
HELD = 500_000
# edits probed at once, some 100 MB
PROBED = 1 << 20
# words probed by a task
DEALT = 10_000
# replacing goes on to later letters only, so the frequent ones come last
ALPHABET = "".join(map(chr, range(0xC0, 0x100))) + "abcdefghijklmnopqrstuvwxyz"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, size=len(ALPHABET), dtype=np.uint64) | np.uint64(1)
_RANK = np.zeros(0x100, dtype=np.int64)
_RANK[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def _counted(least: int):
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def told(total: Counter[str]) -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(run_of.findall(encoded(text, lower=True).decode())).items():
                    crc = zlib.crc32(word.encode(), start)
                    if crc % SPOILED == 0:
                        at = crc % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield told(total)
                    total = Counter()
        yield told(total)

    return run


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def ranks(words: list[str], length: int) -> np.ndarray:
    """Place in the alphabet of every letter of words of one length."""
    raw = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return _RANK[raw].reshape(len(words), length)


def hashes(letters: np.ndarray) -> np.ndarray:
    """Of each word, the sum of its letters' numbers times powers of the base."""
    return (_LETTER[letters] * _powers(_BASE, letters.shape[1])).sum(axis=1, dtype=np.uint64)


class Shards:
    """Where each length's shard begins among the blocks, and how many blocks it has."""

    def __init__(self, sizes: dict[int, int], groups: int) -> None:
        self.groups = groups
        self.start, self.blocks, at = {}, {}, 0
        for length in sorted(sizes):
            self.start[length] = at
            self.blocks[length] = sizes[length] * BITS // (64 * groups) + 1
            at += self.blocks[length]
        self.total = at

    def place(self, raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, block and bits of words, or edits, of one length by their hashes."""
        mixed = mix(raw + np.uint64(length))
        group = (mixed >> np.uint64(40)) % np.uint64(self.groups)
        block = ((mixed >> np.uint64(32)) * np.uint64(self.blocks[length]) >> np.uint64(32)).astype(np.int64)
        bits = np.zeros(len(raw), dtype=np.uint64)
        for i in range(4):
            bits |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
        return group, block + self.start[length], bits


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array([len(x) for x in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _bits(shards: Shards):
    """Blocks of the filters as far as the task's words fill them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("word").to_pylist()
            for length, at in _by_length(every):
                words = [every[i] for i in at.tolist()]
                group, block, bits = shards.place(hashes(ranks(words, length)), length)
                yield pa.record_batch({"part": group.astype(np.int64), "block": block, "bits": bits.view(np.int64)})

    return run


def edits(letters: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Change of length, word, place, new letter or -1, and hash of the edits of words of one length.

    Words are those given by their letters, with their hashes. An edit that two places make is made once.
    """
    count, length = letters.shape
    powers = _powers(_BASE, length)
    for first in range(0, length, step := max(1, PROBED // (count * len(ALPHABET)))):
        own = letters[:, first : first + step]
        word, place, letter = np.nonzero(np.arange(len(ALPHABET)) > own[:, :, None])
        change = (_LETTER[letter] - _LETTER[own[word, place]]) * powers[first + place]
        yield 0, word, first + place, letter, raw[word] + change
    numbers = _LETTER[letters] * powers
    upto = np.cumsum(numbers, axis=1, dtype=np.uint64)
    left_out = (upto - numbers) + (raw[:, None] - upto) * np.uint64(_INVERSE)
    # of equal letters in a row the first is left out
    word, place = np.nonzero(np.append(np.ones((count, 1), bool), letters[:, 1:] != letters[:, :-1], axis=1))
    yield -1, word, place, np.full(len(word), -1), left_out[word, place]


def _probed(shards: Shards, group: int, blocks: np.ndarray):
    """Edits of words that the filter holds, written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for length, own in _by_length(every):
                for some in range(0, len(own), step := max(1, PROBED // (length * len(ALPHABET)))):
                    at = own[some : some + step]
                    words, n = [every[i] for i in at.tolist()], counts[at]
                    letters = ranks(words, length)
                    for longer, word, place, letter, raw in edits(letters, hashes(letters)):
                        if length + longer not in shards.start:
                            continue
                        part, block, bits = shards.place(raw, length + longer)
                        held = np.flatnonzero((part == group) & (blocks[block] & bits == bits))
                        found = [
                            words[w][:p] + (ALPHABET[x] if x >= 0 else "") + words[w][p + 1 :]
                            for w, p, x in zip(word[held].tolist(), place[held].tolist(), letter[held].tolist(), strict=True)
                        ]
                        yield pa.record_batch({
                            "a": pa.array([words[w] for w in word[held].tolist()], pa.string()),
                            "a_n": n[word[held]],
                            "b": pa.array(found, pa.string()),
                        })

    return run


def count_words(docs: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all texts."""
    source = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    counted = source.mapInArrow(_counted(least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURRENCES)


def near_words(words: DataFrame, scratch: Scratch, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Pairs ``a``, ``b`` of near words with their counts, each pair once."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(x.n for x in sizes)
    groups = total * BITS // (8 * filter_bytes) + 1
    shards = Shards({x.length: x.n for x in sizes}, groups)
    filled = scratch.keep(
        words.select("word")
        .mapInArrow(_bits(shards), "part long, block long, bits long")
        .groupBy("part", "block")
        .agg(F.bit_or("bits").alias("bits")),
        "filters",
    )
    dealt = scratch.keep(words.repartition(total // DEALT + 1, "word"), "dealt")
    found = []
    for group in range(groups):
        one = filled.filter(F.col("part") == group).toPandas()  # one filter's blocks
        blocks = np.zeros(shards.total, dtype=np.uint64)
        blocks[one["block"].to_numpy("int64")] = one["bits"].to_numpy("int64").view(np.uint64)
        held = dealt.mapInArrow(_probed(shards, group, blocks), "a string, a_n long, b string")
        known = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
        found.append(scratch.keep(held.join(known, "b").select("a", "a_n", "b", "b_n"), f"near_{group}"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs


def group_spellings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the texts."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(count_words(docs, key, text), "words")
    pairs = near_words(words, scratch, filter_bytes)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best_n = -F.col("best.less")
    known = scratch.keep(
        words.join(near, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(best_n >= TIMES * F.col("n"), F.col("best.near")).alias("form"),
            F.when(best_n >= TIMES * F.col("n"), best_n).alias("form_n"),
        ),
        "known",
    )
    # each round follows twice as many forms as the last, so there are few
    roots = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for step in range(64):
        roots = scratch.keep(roots, f"roots_{step}")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(further, "root", "left_semi").isEmpty():
            break
        roots = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
