"""Spelling groups against a comparison of all words with all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from filmlake.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, word string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    total = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if x != w and one_apart(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdeEFßéÀÿ×÷"
    base = ["".join(rng.choices(letters, k=rng.randint(7, 11))) for _ in range(25)] + ["aaaaaaaa", "bananas", "strasse"]
    words = []
    for word in base:
        times = rng.choice([2, 5, 30, 400, 4000])
        words += [word] * times
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(word))
            other = word[:at] + rng.choice([*letters, ""]) + word[at + rng.randint(0, 1) :]
            words += [other] * rng.choice([1, 2, 3, 30])
    rng.shuffle(words)
    rows, at = [], 0
    while at < len(words):
        size = rng.randint(1, 200)
        rows.append((len(rows), rng.choice([" ", "-", "1", "Ā"]).join(words[at : at + size])))
        at += size
    return rows + [(None, None), (None, "bananas Bananas"), (3, ""), (3, "!!"), (4, rows[0][1]), (4, rows[0][1])]


@pytest.mark.parametrize("filter_bytes", [64, spelling.FILTER_BYTES])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, rows, seed, filter_bytes):
    given = corpus(seed)
    out = spelling.group_spellings(table(spark, given), filter_bytes=filter_bytes)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(out) == brute_force(given)


def test_empty_tables_and_long_runs(spark, rows):
    assert spelling.group_spellings(table(spark, [])).count() == 0
    assert spelling.group_spellings(table(spark, [(1, "short 12"), (2, None)])).count() == 0
    given = [(i, "x" * 5000 + " " + "x" * 4999 + "y") for i in range(3)]
    assert rows(spelling.group_spellings(table(spark, given))) == brute_force(given)


def test_every_edit_is_made_once():
    words = ["abcdefg", "aabbccd", "zzzzzzz"]
    letters = spelling.ranks(words, 7)
    made = []
    for _, word, place, letter, raw in spelling.edits(letters, spelling.hashes(letters)):
        for w, p, x, h in zip(word, place, letter, raw, strict=True):
            text = words[w][:p] + (spelling.ALPHABET[x] if x >= 0 else "") + words[w][p + 1 :]
            assert spelling.hashes(spelling.ranks([text], len(text)))[0] == h
            made.append((w, text))
    assert len(made) == len(set(made))
    rank = {c: i for i, c in enumerate(spelling.ALPHABET)}
    for w, word in enumerate(words):
        wanted = {word[:i] + word[i + 1 :] for i in range(7)}
        wanted |= {word[:i] + c + word[i + 1 :] for i in range(7) for c in rank if rank[c] > rank[word[i]]}
        assert {text for v, text in made if v == w} == wanted
