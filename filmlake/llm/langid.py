"""Language of a text by n-grams in bit-sliced Bloom filters.

All languages share one table of slots. A slot holds a bit per language; the filter of a
language is its bit in all slots. An n-gram hashes to ``HASHES`` slots, and the bits set in
all of them are the languages that contain it, so one look-up asks every filter at once.
The share of a text's n-grams that a language contains, less the share its filter would claim
by false positives, decides; the score is the best share over the sum of all shares.

An n-gram is 3 or 4 bytes of the text between two blanks, with A to Z lower-cased and everything
but letters taken as one blank; none reaches into another text. A language contains those that are frequent in its training texts, or all of them where
there are few n-grams to learn from, and whose share there is at least ``RIVAL`` times their share
in any other language. Shares in less than ``FEW`` n-grams count as shares of so many for the others. Filters are fitted on about
``TRAIN_TEXTS`` distinct texts of each language, chosen by a hash of the text, or on all if there
are no more, so their size doesn't grow. However often a text is copied, it is learned from once.

A NULL text, or one without a letter, is ``und`` with score 0. A text of none but unknown n-grams
gets the language with the most training texts, score 0; ties go to the language with more
training texts. Without training texts all is ``und``. Equal texts get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.words import buffers, encoded, mix

UNKNOWN = "und"
TRAIN_TEXTS = 2_000
SIZES = (3, 4)
# n-grams of a language, at most, and times each must be seen
GRAMS = 30_000
SEEN = 5
RIVAL = 0.25
# n-grams of training texts, of each size, that a language is judged by; times seen rise by one with each so many
FEW = 10_000
SLOT_BITS = 20
HASHES = 3

_KEEP = np.full(256, 32, dtype=np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def _padded(texts: Iterable[str | None]) -> list[bytes]:
    return [b" " + encoded(x, lower=True) + b" " for x in texts]


def _grams(raw: bytes, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the hashes of the n-grams of some joined padded texts, and where each text's begin.

    The second array has one more entry, the number of n-grams.
    """
    codes = _KEEP[np.frombuffer(raw, dtype=np.uint8)]
    blank = codes == 32
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[starts] = True  # each text keeps its first blank
    at = np.flatnonzero(keep)
    first = np.append(np.searchsorted(at, starts), len(at))
    lengths, ends = np.diff(first), first[1:]
    codes = codes[at].astype(np.uint64)
    for size in SIZES:
        n = max(0, len(codes) - size + 1)
        packed = np.full(n, size, dtype=np.uint64)
        for i in range(size):
            packed = (packed << np.uint64(8)) | codes[i : i + n]
        inside = np.ones(n, dtype=bool)
        for back in range(1, size):
            beyond = ends[lengths >= back] - back
            inside[beyond[beyond < n]] = False
        yield mix(packed[inside]), np.append(0, np.cumsum(np.maximum(lengths - size + 1, 0)))


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    """The slots of each n-gram."""
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((grams >> np.uint64(SLOT_BITS * i)) & mask).astype(np.int64) for i in range(HASHES)]


class Filters:
    """The slot table, a bit per language, and each filter's rate of false positives.

    ``few`` are languages with fewer than ``FEW`` n-grams to learn from.
    """

    def __init__(self, languages: list[str], table: np.ndarray, few: Sequence[str] = ()) -> None:
        self.languages, self.table, self.few = languages, table, list(few)
        filled = [((table[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))]
        self.false = np.array(filled) ** HASHES

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Corrected share of each text's n-grams in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        for first, last, raw, starts in buffers(_padded(texts)):
            total = np.zeros(last - first)
            for grams, bounds in _grams(raw, starts):
                total += np.diff(bounds)
                slots = _slots(grams)
                for byte in range(self.table.shape[1]):
                    column = self.table[:, byte]
                    found = column[slots[0]]
                    for slot in slots[1:]:
                        found &= column[slot]
                    for i in range(8 * byte, min(8 * byte + 8, len(self.languages))):
                        hits = np.append(0, np.cumsum((found >> (i % 8)) & 1, dtype=np.int64))
                        out[first:last, i] += hits[bounds[1:]] - hits[bounds[:-1]]
            out[first:last] /= np.maximum(total, 1)[:, None]
        return np.maximum((out - self.false) / (1 - self.false), 0)


def fit(train: DataFrame, train_texts: int = TRAIN_TEXTS) -> Filters:
    """Filters from ``text`` and ``lang``; NULLs in either teach nothing."""
    train = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    train = train.withColumn("tid", F.xxhash64("text"))
    distinct = train.groupBy("lang", "tid").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("bytes"))
    # a row per language
    counts = (
        distinct.groupBy("lang")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.sum("bytes").alias("bytes"))
        .collect()
    )
    counts.sort(key=lambda row: (-row.n, row.lang))
    languages = [row.lang for row in counts]
    share = F.create_map(*(F.lit(x) for row in counts for x in (row.lang, min(1.0, train_texts / row.texts)))) if counts else None
    # a text has about as many n-grams of a size as bytes
    seen_in = {row.lang: min(SEEN, 1 + int(min(1.0, train_texts / row.texts) * row.bytes) // FEW) for row in counts}
    times = F.create_map(*(F.lit(x) for pair in seen_in.items() for x in pair)) if counts else None
    table = np.zeros((1 << SLOT_BITS, (len(languages) + 7) // 8 or 1), dtype=np.uint8)
    if not counts:
        return Filters(languages, table)
    place = F.pmod("tid", F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                for _, _, raw, starts in buffers(_padded(own["text"])):
                    for size, (grams, _) in enumerate(_grams(raw, starts)):
                        gram, n = np.unique(grams, return_counts=True)
                        yield pd.DataFrame({"lang": lang, "size": size, "gram": gram.view(np.int64), "n": n})

    seen = (
        train.filter(place < share[F.col("lang")])
        .dropDuplicates(["lang", "tid"])
        .select("text", "lang")
        .mapInPandas(run, "lang string, size int, gram long, n long")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # sampled texts are bounded, and so are their n-grams; the rarer ones of larger languages go in Spark
    grams = seen.filter(F.col("n") >= times[F.col("lang")]).toPandas()
    among = grams.groupby(["lang", "size"])["n"].transform("sum")
    grams["share"], grams["rival"] = grams["n"] / among, grams["n"] / np.maximum(among, FEW)
    own = grams[grams["share"] >= RIVAL * grams.groupby("gram")["rival"].transform("max")]
    own = own.sort_values(["lang", "n", "gram"], ascending=[True, False, True]).groupby("lang").head(GRAMS)
    for i, lang in enumerate(languages):
        for slot in _slots(own.loc[own["lang"] == lang, "gram"].to_numpy().view(np.uint64)):
            table[slot, i // 8] |= np.uint8(1 << (i % 8))
    enough = grams.groupby(["lang", "size"])["n"].sum().unstack(fill_value=0).min(axis=1).reindex(languages, fill_value=0)
    return Filters(languages, table, [lang for lang in languages if enough[lang] < FEW])


def predict(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``known``, the share of n-grams of that language.

    The text is left out; columns of the new names are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "lang_pred", "score", "known")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, texts = shared.value, batch["_text"].tolist()
            # letters as Unicode has them, so number signs are none
            named = np.array([bool(x and own.languages and any(map(str.isalpha, x))) for x in texts], dtype=bool)
            out = batch[rest].copy()
            if own.languages:
                shares = own.shares(texts) * named[:, None]
                best = shares.argmax(axis=1)
                known = shares.max(axis=1)
                names = np.array(own.languages, dtype=object)[best]
                out["lang_pred"] = np.where(named, names, UNKNOWN)
                out["score"] = known / np.maximum(shares.sum(axis=1), 1e-12)
                out["known"] = known
            else:
                out["lang_pred"], out["score"], out["known"] = UNKNOWN, 0.0, 0.0
            yield out

    kept = docs.select(*rest, F.col(text).alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "_text")
    return kept.mapInPandas(run, f"{schema}lang_pred string, score double, known double")
