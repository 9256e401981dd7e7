"""Groups of the prefix join against all pairs of shingle sets."""

from __future__ import annotations

import random

import pytest

from filmlake.llm import prefixes
from test_near import brute_force, corpus

SCHEMA = "doc_id long, text string, key string, node int, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def edited(seed):
    """Groups around the threshold: copies with a few words changed, left out or put in, with common lines."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    line = rng.choices(words, k=12)
    out = []
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([25, 40, 90, 200])) + line * rng.randint(0, 1)
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, max(2, len(base) // 30))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 2))
            out.append(copy)
    out += [line] * 30 + [rng.choices(words, k=3) + line for _ in range(80)]
    ids = rng.sample(range(10_000), len(out))
    return [(i, " ".join(x)) for i, x in zip(ids, out, strict=True)]


@pytest.mark.parametrize(
    ("rows", "percent", "per_range"), [(corpus(2), 90, 500), (edited(4), 90, prefixes.RANGE), (edited(5), 70, 500)]
)
def test_equals_brute_force(spark, rows, percent, per_range):
    got = prefixes.jaccard_groups(table(spark, rows), 3, percent, per_range=per_range)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_force(rows, 3, percent)


def test_odd_rows(spark, rows):
    assert prefixes.jaccard_groups(table(spark, [])).count() == 0
    long = " ".join(f"v{i}" for i in range(60_000))
    given = [
        (None, "a b c d e"), (7, "a b c d e"), (7, "A B c d\te"), (8, None), (9, " \n"), (9, "one"), (4, "ONE"),
        (None, "only null ids"), (None, "only null ids"), (11, long), (12, long + " more"),
    ]
    assert rows(prefixes.jaccard_groups(table(spark, given))) == sorted([
        (None, 3, 7), (7, 3, 7), (7, 3, 7), (8, 0, 8), (9, 0, 9), (9, 1, 4), (4, 1, 4),
        (None, 1, None), (None, 1, None), (11, 59_998, 11), (12, 59_999, 11),
    ], key=repr)


def test_frequent_shingles_are_known_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "COUNTED", 16)
    rows = edited(6)
    got = prefixes.jaccard_groups(table(spark, rows), 3, 90, per_range=300)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_force(rows, 3, 90)
