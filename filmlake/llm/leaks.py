"""Benchmark items leaked into documents, by SimHash of item-sized windows.

Words are runs of letters and digits, lower-cased; a shingle is five of them, and its weight is
how often it occurs. A document leaks an item if one of its windows of as many words as the
item has is similar to it: the weighted Jaccard similarity of their shingles is at least
``PERCENT`` hundredths. Windows may reach beyond the text and then are what lies in it, so an
item that the text cuts off, or one longer than the text, is compared without padding.

1. A window that similar shares at least a known number of shingles with the item. Positions of
   item shingles in the documents so tell, without loss, which windows can be similar at all. Of
   the windows cut short, only those that are cut at a shingle of the item need be looked at: any
   other is less similar than a shorter one.
2. These windows and the items get 64-bit SimHash fingerprints. Repeats of a shingle count as
   shingles of their own, so that the angle depends on the weighted similarity alone.
3. Multi-index: a fingerprint is cut into 8 blocks of 8 bits. Two that differ in at most
   ``RADIUS`` = 23 bits differ in at most 2 in some block, so joining the windows' blocks with
   all values within 2 bits of the items' blocks finds every pair within the radius. Fingerprints
   of sets alike to 0.8 differ in 10 bits, give or take 3, so fewer than one in 100,000 windows
   is lost, and a leak has several windows. Of windows cut short it is up to one in 30,000, and
   one in 2,900 where four shingles are left of an item of five.
4. The exact similarity decides.

Only JVM functions are used. NULL and empty texts have no words. Items of fewer than five words have
no shingle and leak nowhere. Ids are taken as they are: rows of one id and one text are one row
here, NULL ids and repeated items are kept apart by their texts. Empty tables give no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch

SHINGLE = 5
PERCENT = 80
RADIUS = 23
BLOCKS = 8
LANES = 0x0001000100010001

# values that differ from 0 in at most two of eight bits
_NEAR = [0, *(1 << i for i in range(8)), *((1 << i) | (1 << j) for i, j in combinations(range(8), 2))]


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(values: Column) -> Column:
    """Hash of the shingle at each position of an array of words."""
    at_each = F.transform(
        F.array(values),
        lambda w: F.when(
            F.size(w) >= SHINGLE,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - SHINGLE),
                lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(SHINGLE))),
            ),
        ).otherwise(F.array().cast("array<long>")),
    )
    return F.get(at_each, F.lit(0))


def counted(hashes: str) -> list[Column]:
    """How often each bit is set among the shingles: 16 columns of four counts of 16 bits.

    Counts are exact up to 65,535 shingles of an item.
    """
    def lanes(i: int) -> Column:
        return F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda n, x: n + F.shiftrightunsigned(x, i).bitwiseAND(F.lit(LANES)),
        )

    return [lanes(i).alias(f"lanes{i}") for i in range(16)]


def majority() -> Column:
    """SimHash: a bit is set if it is in more than half of the ``own_size`` shingles."""
    out = F.lit(0).cast("long")
    for i in range(16):
        for lane in range(4):
            count = F.shiftrightunsigned(f"lanes{i}", 16 * lane).bitwiseAND(F.lit(0xFFFF))
            bit = F.shiftleft(F.lit(1).cast("long"), i + 16 * lane)
            out = out.bitwiseOR(F.when(2 * count > F.col("own_size"), bit).otherwise(F.lit(0).cast("long")))
    return out.alias("print")


def numbered(hashes: str) -> Column:
    """Hashes of an array with repeats told apart by their number.

    The similarity of two such arrays as sets is the weighted one of the hashes.
    """

    def told_apart(known: Column, begins: Column) -> Column:
        return F.transform(
            begins,
            lambda at, j: F.transform(
                F.sequence(F.lit(0), F.coalesce(F.get(begins, j + 1), F.size(known)) - at - 1),
                lambda k: F.when(k == 0, F.get(known, at)).otherwise(F.xxhash64(F.get(known, at), k)),
            ),
        )

    def runs(known: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(known) - 1)
        begins = F.filter(at, lambda i: (i == 0) | (F.get(known, i) != F.get(known, i - 1)))
        return F.flatten(F.get(F.transform(F.array(begins), lambda x: told_apart(known, x)), F.lit(0)))

    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    apart = F.get(F.transform(F.array(F.sort_array(hashes)), runs), F.lit(0))
    return F.when(repeats, apart).otherwise(F.col(hashes))


def fingerprinted(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``print`` of rows with an array of shingle hashes ``own``."""
    rows = rows.select(*keys, F.size("own").alias("own_size"), numbered("own").alias("own"))
    return rows.select(*keys, "own_size", *counted("own")).select(*keys, majority())


def blocks(rows: DataFrame, *keys: str, near: bool) -> DataFrame:
    """A row per block of the fingerprint, and per value near it if asked for."""
    out = rows.select(*keys, "size", "print", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    value = F.expr("shiftrightunsigned(print, 8 * block) & 255")
    if not near:
        return out.withColumn("value", value)
    flips = F.explode(F.array(*(F.lit(x) for x in _NEAR)))
    return out.withColumn("flip", flips).withColumn("value", value.bitwiseXOR(F.col("flip"))).drop("flip")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    percent: int = PERCENT,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``tid``, ``item_id``, ``start``, ``n_words`` and ``similarity`` of every leak.

    A row per document and item, with the most similar window, the first of
    equal ones. ``tid`` is a hash of the document's text.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = scratch.keep(
        items.select(
            F.col(item_key).alias("item_id"), F.xxhash64(text).alias("iid"), shingles(words(text)).alias("own")
        )
        .filter(F.size("own") > 0)
        .dropDuplicates(["item_id", "iid"])
        .withColumn("item", F.monotonically_increasing_id())
        .withColumn("size", F.size("own"))
        # so many shingles a window of as many has in common with the item, and a shorter one, at least
        .withColumn("need", F.ceil(2 * percent * F.col("size") / F.lit(100 + percent)).cast("int"))
        .withColumn("least", F.ceil(percent * F.col("size") / F.lit(100)).cast("int")),
        "items",
    )
    source = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
    asked = scratch.keep(
        items.select("item", "size", "need", "least", F.explode(F.array_distinct("own")).alias("shingle")), "asked"
    )
    shingled = source.select("doc_id", "tid", shingles(words("text")).alias("all"))
    hits = (
        shingled.select("doc_id", "tid", F.size("all").alias("total"), "all")
        .select("doc_id", "tid", "total", F.posexplode("all").alias("at", "shingle"))
        .join(asked, "shingle")
    )
    counts = hits.groupBy("doc_id", "tid", "total", "item", "size", "need", "least").agg(
        F.array_sort(F.array_distinct(F.collect_list("at"))).alias("at")
    )
    n_at, total, size = F.size("at"), F.col("total"), F.col("size")

    def window(start: Column, own: Column) -> Column:
        return F.struct(start.alias("start"), own.alias("own_size"), size.alias("size"))

    def enough(common: Column, own: Column) -> Column:
        return (100 + percent) * common >= percent * (own + size)

    reached = F.when(
        n_at >= F.col("need"),
        F.transform(
            F.sequence(F.lit(0), n_at - F.col("need")),
            lambda i: F.struct(
                F.greatest(F.get("at", i + F.col("need") - 1) - size + 1, F.lit(0)).alias("low"),
                F.least(F.get("at", i), total - size).alias("high"),
            ),
        ),
    )
    spans = F.filter(reached, lambda x: x["low"] <= x["high"])
    whole = F.flatten(F.transform(spans, lambda x: F.transform(F.sequence(x["low"], x["high"]), lambda i: window(i, size))))
    # windows cut short by the text's end, and by its beginning
    ends = F.transform(
        F.filter("at", lambda x, i: (x > total - size) & enough(n_at - i, total - x)), lambda x: window(x, total - x)
    )
    begins = F.transform(
        F.filter("at", lambda x, i: (x + 1 < size) & enough(i + 1, x + 1)), lambda x: window(F.lit(0), x + 1)
    )
    none = F.array().cast("array<struct<start:int,own_size:int,size:int>>")
    wanted = scratch.keep(
        counts.filter(n_at >= F.col("least"))
        .select("doc_id", "tid", F.explode(F.array_distinct(F.concat(F.coalesce(whole, none), ends, begins))).alias("w"))
        .groupBy("doc_id", "tid")
        .agg(F.collect_set("w").alias("windows")),
        "wanted",
    )
    texts = source.join(
        wanted.select(F.col("doc_id").alias("_doc_id"), F.col("tid").alias("_tid"), "windows").hint("shuffle_hash"),
        source["doc_id"].eqNullSafe(F.col("_doc_id")) & (source["tid"] == F.col("_tid")),
    ).select("doc_id", "tid", shingles(words("text")).alias("all"), "windows")
    windows = scratch.keep(
        texts.select("doc_id", "tid", "all", F.explode("windows").alias("w"))
        .select("doc_id", "tid", "w.start", F.slice("all", F.col("w.start") + 1, F.col("w.own_size")).alias("own"), "w.size")
        .dropDuplicates(["doc_id", "tid", "start", "own", "size"])
        .withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )
    # a window is compared with items of the size for which it was cut
    seen = scratch.keep(fingerprinted(windows, "window", "size"), "seen")
    known = scratch.keep(fingerprinted(items, "item", "size"), "known")
    other = blocks(known, "item", near=True).withColumnRenamed("print", "other")
    pairs = scratch.keep(
        blocks(seen, "window", near=False)
        .join(other, ["size", "block", "value"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= RADIUS)
        .select("window", "item", "size")
        .distinct(),
        "pairs",
    )

    def weights(rows: DataFrame, name: str, weight: str) -> DataFrame:
        return rows.select(name, F.explode("own").alias("shingle")).groupBy(name, "shingle").agg(F.count(F.lit(1)).alias(weight))

    both = F.col("own_size") + F.col("size") - F.col("common")
    common = (
        pairs.join(weights(windows, "window", "a"), "window")
        .join(scratch.keep(weights(items, "item", "b"), "weights"), ["item", "shingle"])
        .groupBy("window", "item", "size")
        .agg(F.sum(F.least("a", "b")).alias("common"))
        .filter(100 * F.col("common") >= percent * F.col("size"))
        .join(windows.select("window", "doc_id", "tid", "start", F.size("own").alias("own_size")), "window")
        .filter(100 * F.col("common") >= percent * both)
    )
    similarity = (F.col("common") / both).alias("similarity")
    best = F.max(F.struct(similarity, (-F.col("start")).alias("start"), "own_size")).alias("best")
    return (
        common.groupBy("doc_id", "tid", "item")
        .agg(best)
        .join(items.select("item", "item_id"), "item")
        .select(
            "doc_id",
            "tid",
            "item_id",
            (-F.col("best.start")).alias("start"),
            (F.col("best.own_size") + SHINGLE - 1).alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )
