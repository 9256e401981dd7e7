"""Aligned tokens against a plain walk over the tokens of each text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from filmlake.llm import alignment

PLACES = alignment._byte_places()


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def piece_bytes(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def spans(parts):
    out, at = [], 0
    for i, raw in parts:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def one(models, text):
    """Groups and links of a text, by comparing every token of A with every token of B near it."""
    a, b = models
    if not text:
        return [], []
    ids = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(PLACES[c] for c in a.id_to_token(i))) for i in ids.ids]
    right = [(i, piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
    raw = (" " + text).encode()
    if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
        return [], []
    left, right = spans(left), spans(right)
    links = [(x[0], y[0]) for x in left for y in right if x[1] < y[2] and y[1] < x[2]]
    cuts = sorted({x[2] for x in left} & {y[2] for y in right})
    groups, low = [], 0
    for high in cuts:
        groups.append(([x[0] for x in left if low < x[2] <= high], [y[0] for y in right if low < y[2] <= high]))
        low = high
    return groups, links


def brute_force(models, rows):
    done = [(i, *one(models, text)) for i, text in rows]
    counts = Counter(pair for _, _, links in done for pair in set(links))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for i, groups, links in done:
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(line.encode()).hexdigest() if line else "",
        ))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "Haus", "niño", "TARİHİ", "été", "ﬁ", "½", "naïve", "日本語", "👩‍👩‍👧", "<|endoftext|>", "<s>", "12345", "don't", "\t", "\n\n", "   ", "\x00", "▁"]
    rows = [(0, None), (1, ""), (2, " "), (3, "a"), (4, "▁"), (5, "<|endoftext|>"), (6, "\n"), (7, "a" * 3000), (7, "a" * 3000)]
    for i in range(n):
        rows.append((10 + i, rng.choice(["", " "]).join(rng.choices(words, k=rng.randint(1, 40)))))
    rows += [(10, rows[-1][1]), (None, "Haus und Hof")]
    return rows


@pytest.mark.parametrize("frequent", [1, 50, 100_000])
def test_alignment_equals_brute_force(spark, rows, models, frequent):
    given = corpus(frequent)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in given], "doc_id long, text string, row long, pair string")
    out = alignment.align_tokens(docs, frequent=frequent)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(out) == brute_force(models, given)


def test_empty_table_has_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokens(docs).collect() == []


def test_ids_equal_the_tokenizer_named_by_the_contract(models):
    rng = random.Random(5)
    signs = "abcXYZ éÜß 　\n\t'’-_.,;0123½²İıſ漢字🙂‍▁"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(4000)]
    model = alignment.tokens(alignment.BYTE_LEVEL, alignment.BYTE_RANKS, alignment.PIECES)
    ours = model.a.encode_ordinary_batch([" " + x for x in texts], num_threads=1)
    assert ours == [x.ids for x in models[0].encode_batch([" " + x for x in texts], add_special_tokens=False)]


def test_same_bytes_map_points_to_same_bytes():
    model = alignment.tokens(alignment.BYTE_LEVEL, alignment.BYTE_RANKS, alignment.PIECES)
    for a, b in enumerate(model.same):
        assert b < 0 or model.bytes_a[a] == model.bytes_b[b]
    assert (model.same >= 0).sum() > 10_000
