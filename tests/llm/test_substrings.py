"""Substring removal against a brute-force count of all windows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from filmlake.llm import recompression, words
from filmlake.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(texts, width):
    split = [WORD.findall(text or "") for text in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def corpus(seed, n=120, vocabulary=60, width=35):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["é|", "ß"]
    passages = [rng.choices(names, k=rng.randint(width - 3, 3 * width)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choices(names, k=rng.randint(0, 50))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), rng.choices(names, k=rng.randint(0, 9))]
        if rng.random() < 0.15:
            parts.append([rng.choice(names[:2])] * rng.randint(width - 2, 2 * width))
        if rng.random() < 0.1:
            parts.append(["a", "b"] * rng.randint(10, 40))
        out.append(rng.choice([" ", "\n", " \t "]).join(x for p in parts for x in p))
    return out + [None, None, "", "  ", "one", out[3], out[3], out[5]]


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 60), (2, 4), (3, 2)])
def test_equals_brute_force(spark, seed, vocabulary):
    texts = corpus(seed, vocabulary=vocabulary)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row.doc_id: tuple(row)[2:] for row in remove_repeats(df).collect()}
    assert got == dict(enumerate(brute_force(texts, 35)))


def test_windows_of_equal_words_choose_equal_names():
    rng = random.Random(9)
    for size in (1, 2, 3, 30):
        window = [f"x{rng.randrange(size)}" for _ in range(35)]
        names = set()
        for _ in range(40):
            before = [f"x{rng.randrange(size)}" for _ in range(rng.randint(0, 60))]
            after = [f"x{rng.randrange(size)}" for _ in range(rng.randint(0, 60))]
            raw = " ".join(before + window + after).encode()
            for _, _, hashes, bounds in words.hashed([raw]):
                texts = np.zeros(len(hashes), dtype=np.int64)
                name, start, count, _ = recompression.choose(hashes, texts, bounds, 35)
                at = np.searchsorted(start, len(before), side="right") - 1
                assert start[at] <= len(before) < start[at] + count[at]
                names.add(int(name[at]))
        assert len(names) == 1


def test_odd_tables(spark):
    schema = "doc_id long, text string, n_words string, kept_text int, _id1 string, lang string"
    empty = spark.createDataFrame([], schema)
    assert remove_repeats(empty).count() == 0
    rows = [(None, "a " * 40, "x", 1, "y", None), (None, "a " * 40, "x", 1, "y", None), (1, None, None, None, None, None)]
    got = remove_repeats(spark.createDataFrame(rows, schema))
    assert set(got.columns) == {"doc_id", "text", "lang", "n_words", "n_removed", "kept_sha256", "kept_text"}
    assert sorted((r.n_words, r.n_removed) for r in got.collect()) == [(0, 0), (40, 40), (40, 40)]


def test_whole_long_text(spark):
    rng = random.Random(4)
    long = [f"v{rng.randrange(5000)}" for _ in range(400_000)]
    texts = [" ".join(long), " ".join(["q"] + long[399_900:])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.n_words, r.n_removed) for r in remove_repeats(df, with_text=False).orderBy("doc_id").collect()] == [
        (400_000, 100),
        (101, 100),
    ]
