"""Near-duplicate groups by HyperMinHash sketches, confirmed on whole shingle sets.

A document's set holds its distinct shingles of ``shingle`` words, A to Z lower-cased;
a text of fewer words is one shingle, a text without words (or NULL) has an empty set
and is linked with nothing. Two documents are linked if the Jaccard similarity of their
sets is at least ``percent`` hundredths; groups are what links connect.

Sketch. The hash of a shingle names one of ``BUCKETS`` buckets; of each bucket the
least hash is stored as its number of leading zeros and the ``MANTISSA`` bits after
the leading one, 16 bits in all. An empty bucket takes the register of the first filled
one in a fixed random order. Six registers make a band; documents that share a band are
candidates. At similarity 0.85 all 42 bands differ with a chance of 2e-9, at 0.8 of 3e-6.
The share of equal registers, less the share expected from chance collisions of short
registers, estimates the similarity; a candidate is dropped only when the estimate lies
five standard errors below the threshold. The rest is settled on the full sets.

Equal sets are one class, so copies never meet each other. A band that few classes
share gives all its pairs. In a band that many share, the most central class (hub) meets
all others. The classes of bands that are then still in different groups have their shingles counted
among themselves and put in order, the rarest first: two of them can be linked only if they share one of
the first shingles, with enough behind it in both (``prefixes``). Pairs in reach that also share a band, and
are not in one group yet, are candidates like the others. That bound is exact, so no link that
matters to the groups is lost, and a large group of texts that are alike, but not enough, costs few pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.components import components
from filmlake.llm.prefixes import first_pairs, in_common, ordered_shingles, pairs_across, postings_of, prefixes_of
from filmlake.llm.steps import Scratch
from filmlake.llm.words import chain, encoded, hashed, mix, shingles

SHINGLE = 5
PERCENT = 80
BUCKETS = 256
MANTISSA = 10
BAND = 6
# share of equal registers of different sets of one size, times two to the mantissa bits
CHANCE = 0.1699
# a band with more classes than this goes by hubs
SMALL = 4

_BITS = 64 - 8
_PROBES = np.argsort(np.random.Generator(np.random.PCG64(7)).random((BUCKETS, BUCKETS)), axis=1)
_SIGNED = "doc_id {id}, tid long, n_shingles long, id1 long, id2 long, regs array<long>, bands array<long>"


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted distinct hashes, at least one."""
    bucket = (hashes >> np.uint64(_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    value = hashes[first] & np.uint64((1 << _BITS) - 1)
    length = np.frexp((value >> np.uint64(4)).astype(np.float64))[1] + 4  # bits from the leading one on
    rest = value << (np.uint64(64) - length.astype(np.uint64)) << np.uint64(1)
    out = np.zeros(BUCKETS, dtype=np.uint16)
    out[bucket[first]] = ((_BITS - length) << MANTISSA) + (rest >> np.uint64(64 - MANTISSA)).astype(np.int64)
    filled = np.zeros(BUCKETS, dtype=bool)
    filled[bucket[first]] = True
    if len(first) < BUCKETS:
        empty = np.flatnonzero(~filled)
        order = _PROBES[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def bands(regs: np.ndarray) -> np.ndarray:
    """A hash of each band of registers and its place."""
    count = BUCKETS // BAND
    values = regs[: count * BAND].reshape(count, BAND).astype(np.uint64)
    return mix(np.arange(count, dtype=np.uint64) + mix(chain(values.T, BAND)[0]))


def _signed(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for _, _, words, bounds in hashed([encoded(x, lower=True) for x in batch["text"]]):
                for i in range(len(bounds) - 1):
                    own = shingles(words[bounds[i] : bounds[i + 1]], width)
                    if not len(own):
                        rows.append((0, 0, 0, None, None))
                        continue
                    total = np.add.reduce(own) ^ np.uint64(len(own))
                    other = np.bitwise_xor.reduce(mix(own))
                    regs = registers(own)
                    ids = int(total.view(np.int64)), int(other.view(np.int64))
                    rows.append((len(own), *ids, regs.view(np.int64), bands(regs).view(np.int64)))
            out = pd.DataFrame(rows, columns=["n_shingles", "id1", "id2", "regs", "bands"])
            out["doc_id"], out["tid"] = batch["doc_id"], batch["tid"]
            yield out

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for _, _, words, bounds in hashed([encoded(x, lower=True) for x in batch["text"]]):
                found += [
                    shingles(words[bounds[i] : bounds[i + 1]], width).view(np.int64)
                    for i in range(len(bounds) - 1)
                ]
            yield pd.DataFrame({"node": batch["node"], "own": found})

    return run


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` whose sizes and corrected estimate leave a link possible."""
    one, two = (
        classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("regs").alias(f"s{side}"))
        for side in ("a", "b")
    )
    regs = F.lit(float(BUCKETS))
    # registers that are equal, 16 bits at a time
    equal = F.aggregate(
        F.zip_with("sa", "sb", lambda x, y: x.bitwiseXOR(y)),
        F.lit(0),
        lambda n, x: n
        + sum(
            F.when(F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(65535)) == 0, 1).otherwise(0)
            for i in range(4)
        ),
    )
    ratio = F.col("na") / F.col("nb")
    chance = F.lit(CHANCE / 2**MANTISSA) * 4 * ratio / ((1 + ratio) * (1 + ratio))
    estimate = (equal / regs - chance) / (1 - chance)
    least = percent / 100
    error = F.sqrt(F.lit(least * (1 - least)) / F.least(regs, F.col("na"), F.col("nb")))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .filter(estimate >= least - 5 * error)
        .select("a", "b", "na", "nb")
    )


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates whose whole sets are similar enough."""
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("own").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("own").alias("sb")), "b")
        .filter(100 * common >= percent * (F.col("na") + F.col("nb") - common))
        .select("a", "b")
        .distinct()
    )


def _paired(left: str, right: str) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row of ``docs``.

    ``component_id`` is the smallest id in the row's group, ``kept`` whether that
    is the row's own. NULL ids are never the smallest; a group of nothing but
    NULL ids has a NULL component and its rows are kept. A row with an empty set
    is a group of its own. Repeated rows are one class, so they share a group,
    and all rows with the smallest id are kept. ``tid``, a hash of the text,
    tells apart rows of one id with different texts.
    """
    scratch = Scratch(docs.sparkSession, "near")
    source = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("tid"), F.col(text).alias("text")
    )
    schema = _SIGNED.format(id=source.schema["doc_id"].dataType.simpleString())
    signed = scratch.keep(source.mapInPandas(_signed(shingle), schema), "signed")
    classes = scratch.keep(
        signed.filter("n_shingles > 0")
        .groupBy("id1", "id2")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # sketches are not needed again but for one of each class
    texts = scratch.keep(signed.select("doc_id", "tid", "n_shingles", "id1", "id2"), "texts")
    scratch.drop("signed")
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = scratch.keep(
        banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "shared"
    )
    members = scratch.keep(banded.join(shared, "band"), "members")
    few = members.filter(F.col("size") <= SMALL).groupBy("band").agg(F.collect_list("node").alias("nodes"))
    pairs = few.select(F.posexplode("nodes").alias("at", "one"), "nodes").select(
        "one", F.explode(F.slice("nodes", F.col("at") + 2, SMALL)).alias("two")
    )
    many = members.filter(F.col("size") > SMALL)
    # the classes a band goes by first: those which share most
    central = scratch.keep(members.groupBy("node").agg(F.sum("size").alias("weight")), "central")
    asked = scratch.keep(many.join(central, "node").select("band", "node", "weight"), "open_0")

    owners = scratch.keep(
        classes.join(members.select("node").distinct(), "node").select(
            "node", "rep.doc_id", "rep.tid", "n_shingles", "regs"
        ),
        "owners",
    )
    wanted = owners.select("node", F.col("doc_id").alias("own_id"), F.col("tid").alias("own_tid"))
    sets = scratch.keep(
        source.join(
            wanted.hint("shuffle_hash"),
            F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tid") == F.col("own_tid")),
        )
        .select("node", "text")
        .mapInPandas(_sets(shingle), "node long, own array<long>"),
        "sets",
    )

    def confirmed(found: DataFrame, name: str) -> DataFrame:
        pairs = scratch.keep(_candidates(found.distinct(), owners, percent), f"pairs_{name}")
        return scratch.keep(_links(pairs, sets, percent), f"links_{name}")

    first = asked.groupBy("band").agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    first = scratch.keep(first, "chosen")
    met = asked.join(first, "band").filter("node <> hub").select(*_paired("node", "hub"))
    links = confirmed(pairs.select(*_paired("one", "two")).union(met), "hubs")
    groups = components(links, scratch, "hubs")

    # bands whose classes are still in different groups, and the sets of these classes, rarest shingles first
    rooted = scratch.keep(
        asked.join(groups, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")), "asked"
    )
    unsettled = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    still = rooted.join(unsettled.select("band"), "band", "left_semi").select("node").distinct()
    # a row that is there twice gives its set twice
    open_sets = sets.join(still, "node").dropDuplicates(["node"])
    prefixes = scratch.keep(prefixes_of(ordered_shingles(open_sets, percent), percent), "prefixes")
    postings = postings_of(prefixes, scratch, "open")
    bands_of = classes.select("node", "bands")

    def banded_pairs(found: DataFrame) -> DataFrame:
        """Of pairs in reach those that share a band."""
        one, two = (bands_of.select(F.col("node").alias(x), F.col("bands").alias(f"bands{x}")) for x in ("a", "b"))
        asked = in_common(found, prefixes, percent).select("a", "b")
        return asked.join(one, "a").join(two, "b").filter(F.arrays_overlap("bandsa", "bandsb")).select("a", "b")

    links = links.union(confirmed(banded_pairs(first_pairs(postings, percent)), "first"))
    groups = components(links, scratch, "first")
    across = confirmed(banded_pairs(pairs_across(postings, groups, percent, scratch, "open")), "across")
    if not across.isEmpty():
        groups = components(links.union(across), scratch, "across")
    rooted = scratch.keep(
        classes.select("id1", "id2", "node", "rep.doc_id")
        .join(groups, "node", "left")
        .select("id1", "id2", "doc_id", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    least = scratch.keep(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    named = scratch.keep(rooted.join(least, "root").select("id1", "id2", "component_id"), "named")
    scratch.leave("texts", "named")
    plain = texts.filter("n_shingles = 0").select("doc_id", "tid", "n_shingles", F.col("doc_id").alias("component_id"))
    grouped = texts.filter("n_shingles > 0").join(named, ["id1", "id2"]).select("doc_id", "tid", "n_shingles", "component_id")
    return grouped.union(plain).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
