"""Near-duplicate groups against all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from filmlake.llm import near

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_force(rows, width, percent):
    """By id: size of the set, smallest id of the group."""
    sets = [(i, shingle_set(text, width)) for i, text in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, one) in enumerate(sets):
        for b in range(a):
            two = sets[b][1]
            common = len(one & two)
            if one and two and 100 * common >= percent * (len(one) + len(two) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    least = {}
    for a, (i, _) in enumerate(sets):
        least[find(a)] = min(i, least.get(find(a), i))
    return {i: (len(s), least[find(a)]) for a, (i, s) in enumerate(sets)}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ünï", "A", "a"]
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 8, 30, 120, 300]))
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    star = rng.choices(words, k=200)  # copies near the middle one, not near each other
    for _ in range(60):
        copy = list(star)
        for at in rng.sample(range(200), 5):
            copy[at] = rng.choice(words)
        texts.append(copy)
    texts.append(star)
    for _ in range(40):  # alike, but not enough to be linked
        copy = list(star)
        for at in rng.sample(range(200), 16):
            copy[at] = rng.choice(words)
        texts.append(copy)
    rng.shuffle(texts)
    out = [rng.choice([" ", "\n"]).join(t) for t in texts]
    out += [None, "", " \t", "one", "One", *([out[0]] * 30)]
    ids = rng.sample(range(10_000), len(out))
    return list(zip(ids, out, strict=True))


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85)])
def test_equals_brute_force(spark, seed, width, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(df, width, percent).collect()}
    assert got == brute_force(rows, width, percent)


def test_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, kept int, n_shingles string"
    assert near.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    text = "a b c d e f g h i j"
    rows = [(None, text), (7, text), (7, text), (3, "x y z"), (None, "only null ids here"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], schema)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(df).collect()), key=repr)
    assert got == sorted(
        [
            (None, 6, 7, False),
            (7, 6, 7, True),
            (7, 6, 7, True),
            (3, 1, 3, True),
            (None, 1, None, True),
            (None, 0, None, True),
        ],
        key=repr,
    )


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    one, two = np.sort(pool[:2700]), np.sort(pool[300:])
    equal = (near.registers(one) == near.registers(two)).mean()
    assert abs(equal - 2400 / 3000) < 0.15
    assert (near.registers(one) == near.registers(np.sort(rng.permutation(one)))).all()
    assert (near.registers(one[:1]) == near.registers(one[:1])[0]).all()
