"""Token ids of texts, word by word with a cache.

The tokenizer's splitting never reaches over white space, so a text has the ids of its
pieces between blanks, in order. Most pieces are frequent ones, so they are looked up.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# pieces remembered per Python worker, some 100 MB
CACHED = 500_000
# ASCII signs, none of which is part of a word or a number
SIGNS = string.punctuation
# texts whose new pieces are learned together
TOGETHER = 500


class Words:
    """Ids of texts as bytes, with what this worker has met so far."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn_words(self, words: list[str]) -> None:
        """Words of nothing but letters, which the tokenizer takes as one unit each, all at once."""
        ids = self._encoded(" ".join(words))
        cuts = np.flatnonzero(self.last[ids]) + 1
        if len(cuts) == len(words):
            raw, start = ids.tobytes(), 0
            for word, end in zip(words, (4 * cuts).tolist(), strict=True):
                self.known[word] = raw[start:end]
                start = end
        else:
            for word in words:
                self.known[word] = self._encoded(word).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Make the ids of these pieces known."""
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        composed = []
        for piece in pieces - known.keys():
            # signs after a word are a unit of their own; letters of ASCII are
            # lower-cased by the tokenizer whatever stands around them
            word = piece.rstrip(SIGNS)
            # lower-casing may put marks after a letter, which the tokenizer takes together with signs
            if word.isalpha() and word.lower().isalpha():
                composed.append((piece, word.lower() if word.isascii() else word, piece[len(word) :]))
            else:
                known[piece] = self._encoded(piece).tobytes() if piece else b""
        words = list({word for _, word, _ in composed} - known.keys())
        if words:
            self._learn_words(words)
        for piece, word, tail in composed:
            if tail:
                if tail not in known:
                    known[tail] = self._encoded(tail).tobytes()
                known[piece] = known[word] + known[tail]
            elif piece is not word:
                known[piece] = known[word]

    def ids(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text, without special tokens."""
        for first in range(0, len(texts), TOGETHER):
            split = [(text or "").replace("\n", " ").split(" ") for text in texts[first : first + TOGETHER]]
            self.learn(set().union(*split))
            for pieces in split:
                yield b"".join(map(self.known.__getitem__, pieces))


@cache
def tokenizer(path: str) -> Words:
    """The tokenizer of this worker process, read once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)
