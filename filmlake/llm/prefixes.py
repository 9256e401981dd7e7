"""Jaccard join of documents' shingle sets by prefixes that must match in several places.

A document's set holds its distinct shingles of ``shingle`` words, A to Z lower-cased; a text of
fewer words is one shingle; a text without words, or NULL, has an empty set and is linked with
nothing. Two documents are linked if their sets have a Jaccard similarity of at least ``percent``
hundredths. Shingles are told apart by 64 bits.

*Order.* Each document's shingles are ordered from the rarest in the corpus to the most frequent.
To count them, the tasks send blocks: for each range of hash values the 32 low bits of all
shingles of some megabyte of text, and which text each came from. Shingles in at least one in
``EVERYWHERE`` documents are found before, in counts that tasks add up first; there can't be more
of them than ``EVERYWHERE`` mean sets hold, so every task knows them and sends none of them.
Shingles that share a range and low bits are taken for one in the order, which any order allows.

*Prefix.* Linked sets of at least m common shingles share at least l of the first ``size - m + l`` of
each. The longer the prefix, the more documents a shingle of it leads to, but the more of these
fail to share l. Each document takes the l, up to ``MATCHES``, for which the shingles'
frequencies promise the least work. A pair is asked for the smaller l of its two documents, and
only where what stands behind the places of a common shingle leaves m in reach.

*Pairs.* Equal sets are one class, so copies never meet. Where more than ``SMALL`` classes share a
prefix shingle, all meet one of them first, the one with the fewest rarer shingles; then
all those that are not yet in one group meet the others. No link that matters to
the groups is left out. What remains is settled on the whole sets, read from the texts again.

Repeated rows share a class and so a group. NULL ids are never the smallest of a group; a group of
nothing but NULL ids has a NULL component. Ties of frequency are broken by hash. Texts of any length are
taken whole. Other columns of the table, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.components import components
from filmlake.llm.steps import Scratch
from filmlake.llm.words import encoded, hashed, mix, shingles

SHINGLE = 3
PERCENT = 90
# longest addition to a prefix
MATCHES = 8
# shingles that one in so many documents holds are known to all tasks
EVERYWHERE = 64
# documents whose shingles are counted before frequent ones are picked
COUNTED = 1024
# shingles of a range
RANGE = 250_000
# a shingle with more classes than this goes by a first one
SMALL = 4
# classes whose texts are picked by a broadcast of their keys, some 10 MB
PICKED = 200_000
# rows of a block
ROWS = 30_000


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    out = []
    for _, _, words, bounds in hashed([encoded(x, lower=True) for x in texts]):
        out += [shingles(words[bounds[i] : bounds[i + 1]], width) for i in range(len(bounds) - 1)]
    return out


def _counting(width: int):
    """Shingles that many texts of a batch hold; with a NULL shingle the texts and all their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            held, n = np.unique(np.concatenate(sets), return_counts=True)
            often = n * EVERYWHERE >= len(sets)
            # what one text alone holds is no sign of a frequent one
            often &= n > 1 if len(sets) > 1 else True
            key = pa.array([None, *held[often].view(np.int64)], pa.int64())
            return pa.record_batch({
                "token": key,
                "n": pa.array([len(sets), *n[often]], pa.int64()),
                "total": pa.array([sum(map(len, sets)), *[0] * int(often.sum())], pa.int64()),
            })

        sets: list[np.ndarray] = []
        for batch in batches:
            for first in range(0, batch.num_rows, COUNTED):
                sets += [x for x in _sets(batch.column("text").slice(first, COUNTED).to_pylist(), width) if len(x)]
                if len(sets) >= COUNTED:
                    yield told()
                    sets = []
        if sets:
            yield told()

    return run


def _place(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """Range, by the upper half of the bits, and low half of each shingle, as one number."""
    part = ((tokens >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return ((part << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))).view(np.int64)


def _blocks(width: int, ranges: int, frequent: np.ndarray, often: np.ndarray, kind: pa.DataType):
    """A row per text, with a negative range, and the shingles of these texts, a row per range.

    ``frequent`` are sorted places of frequent shingles, ``often`` their counts; a text's own
    row carries those it holds.
    """
    schema = pa.schema([
        ("range", pa.int32()), ("first", pa.int64()), ("low", pa.list_(pa.int32())), ("of", pa.list_(pa.int16())),
        ("node", pa.int64()), ("doc_id", kind), ("tid", pa.int64()), ("n", pa.int32()), ("places", pa.int32()),
        ("id1", pa.int64()), ("id2", pa.int64()), ("hot", pa.list_(pa.int64())), ("hot_n", pa.list_(pa.int64())),
    ])

    def lists(values: np.ndarray, sizes: np.ndarray, type: pa.DataType) -> pa.Array:
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type))

    def made(count: int, /, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[x.name] if x.name in columns else pa.nulls(count, x.type) for x in schema], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                nodes = batch.column("node").to_numpy()
                start = 0
                for _, last, words, bounds in hashed([encoded(x, lower=True) for x in batch.column("text").to_pylist()]):
                    sets = [shingles(words[bounds[i] : bounds[i + 1]], width) for i in range(len(bounds) - 1)]
                    placed = [np.unique(_place(x, ranges)) for x in sets]
                    sizes = np.array([len(x) for x in placed])
                    key = np.concatenate(placed)
                    of = np.repeat(np.arange(len(sets)), sizes)
                    known = np.searchsorted(frequent, key)
                    hot = frequent[np.minimum(known, len(frequent) - 1)] == key if len(frequent) else np.zeros(len(key), bool)
                    hots = np.bincount(of[hot], minlength=len(sets))
                    own = batch.slice(start, len(sets))
                    yield made(
                        len(sets),
                        range=pa.array((-1 - nodes[start:last] % ranges).astype(np.int32)),
                        node=own.column("node"),
                        doc_id=own.column("doc_id"),
                        tid=own.column("tid"),
                        n=pa.array([len(x) for x in sets], pa.int32()),
                        places=pa.array(sizes, pa.int32()),
                        id1=pa.array([int((np.add.reduce(x) ^ np.uint64(len(x))).view(np.int64)) if len(x) else 0 for x in sets], pa.int64()),
                        id2=pa.array([int(np.bitwise_xor.reduce(mix(x)).view(np.int64)) if len(x) else 0 for x in sets], pa.int64()),
                        hot=lists(key[hot], hots, pa.int64()),
                        hot_n=lists(often[known[hot]] if len(frequent) else key[hot], hots, pa.int64()),
                    )
                    key, of = key[~hot], of[~hot]
                    order = np.argsort(key, kind="stable")
                    part, low, of = key[order] >> 32, key[order].astype(np.uint32).view(np.int32), of[order]
                    held, n = np.unique(part, return_counts=True)
                    if len(held):
                        yield made(
                            len(held),
                            range=pa.array(held, pa.int32()),
                            first=pa.array(np.full(len(held), nodes[start])),
                            low=lists(low, n, pa.int32()),
                            of=lists(of, n, pa.int16()),
                        )
                    start = last

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of a range of shingles those that several texts hold, with their number; rows of texts as they are."""
    names = ["node", "doc_id", "tid", "n", "places", "id1", "id2", "hot", "hot_n"]
    part = table.column("range")[0].as_py()
    if part < 0:
        empty = pa.nulls(table.num_rows, pa.int64())
        return pa.table([table.column(x) for x in names] + [empty, empty], [*names, "key", "df"])
    low = table.column("low").combine_chunks()
    sizes = low.value_lengths().to_numpy()
    values = low.flatten().to_numpy()
    node = np.repeat(table.column("first").to_numpy(), sizes) + table.column("of").combine_chunks().flatten().to_numpy()
    _, inverse, n = np.unique(values, return_inverse=True, return_counts=True)
    df = n[inverse]
    kept = df > 1
    columns = [pa.nulls(int(kept.sum()), table.schema.field(x).type) for x in names]
    columns[0] = pa.array(node[kept], pa.int64())
    key = (np.int64(part) << 32) | values[kept].view(np.uint32).astype(np.int64)
    return pa.table([*columns, pa.array(key), pa.array(df[kept], pa.int64())], [*names, "key", "df"])


def _whole(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.view(np.int64) for x in _sets(batch.column("text").to_pylist(), width)]
            yield pa.record_batch({"node": batch.column("node"), "own": pa.array(own, pa.list_(pa.int64()))})

    return run


def _needed(size, percent: int):
    """Common shingles that a link takes at least, of sets that have so many shingles in all."""
    return F.ceil(size * percent / F.lit(100 + percent))


def _in_reach(percent: int):
    """Whether sets ``a`` and ``b`` that share the shingle at these places can be similar enough."""
    return (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & (
        F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
        >= _needed(F.col("a.n") + F.col("b.n"), percent)
    )


def _pair():
    return [F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")]


def _upto(more, percent: int):
    """Of ``shared``, the shingles in a prefix that is to match in ``more`` places; ``alone`` others come first."""
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    return F.least(F.size("shared"), F.greatest(F.lit(0), F.col("n") - least + more - F.col("alone")))


def ordered_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``node``, ``n``, ``alone`` and ``shared`` of sets ``own``, as ``prefixes_of`` takes them.

    For sets that have been picked already, counted among themselves; those that can't be linked are left out.
    """
    tokens = sets.select("node", F.explode("own").alias("key"))
    often = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = (
        tokens.join(often, "key")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("shared"))
    )
    return (
        sets.select("node", F.size("own").alias("n"))
        .join(shared, "node")
        .withColumn("alone", F.col("n") - F.size("shared"))
        .filter(_upto(F.lit(1), percent) > 0)
    )


def prefixes_of(ordered: DataFrame, percent: int) -> DataFrame:
    """``node``, ``n``, ``alone``, ``matches`` and the ``keys`` of the prefix, for the least work."""
    upto = lambda more: _upto(more, percent)
    # the places that lead to candidates, and their whole sets compared with what is left of these
    visits = lambda more: F.aggregate(F.slice("shared", F.lit(1), upto(more)), F.lit(0).cast("long"), lambda x, y: x + y["df"] - 1)
    most = F.least(F.lit(MATCHES), F.ceil(F.col("n") * percent / 100).cast("int"))
    cost = F.transform(
        F.sequence(F.lit(1), most),
        lambda more: F.struct((visits(more) * (1 + F.col("n") / more)).alias("cost"), more.alias("matches")),
    )
    return ordered.withColumn("matches", F.array_min(cost)["matches"]).select(
        "node", "n", "alone", "matches",
        F.transform(F.slice("shared", F.lit(1), upto(F.col("matches"))), lambda x: x["key"]).alias("keys"),
    )


def postings_of(prefixes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """A row for each prefix shingle and class that another class has too, with the list's ``size`` and ``hub``."""
    listed = prefixes.select("node", "n", "alone", F.posexplode("keys").alias("at", "key")).select(
        "key", "node", "n", (F.col("alone") + F.col("at")).alias("place")
    )
    lists = listed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("place", "node", "n")).alias("hub")
    )
    lists = scratch.keep(lists.filter("size > 1"), f"lists_{name}")
    return scratch.keep(listed.join(lists, "key"), f"postings_{name}")


def first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """All pairs of short lists, and in long ones those with the hub."""
    in_reach = _in_reach(percent)
    few = postings.filter(F.col("size") <= SMALL).drop("hub", "size")
    pairs = (
        few.alias("a")
        .join(few.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & in_reach)
        .select(*_pair())
    )
    hubs = (
        postings.filter(F.col("size") > SMALL)
        .select(F.struct("node", "n", "place").alias("a"), F.col("hub").alias("b"))
        .filter("a.node <> b.node")
        .filter(in_reach)
        .select(*_pair())
    )
    return pairs.union(hubs)


def pairs_across(postings: DataFrame, groups: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Pairs of long lists that are in different groups: those outside a list's largest group meet all others."""
    rooted = scratch.keep(
        postings.filter(F.col("size") > SMALL)
        .select("key", "node", "n", "place")
        .join(groups, "node", "left")
        .select("key", "node", "n", "place", F.coalesce("root", "node").alias("root")),
        f"rooted_{name}",
    )
    largest = (
        rooted.groupBy("key", "root")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("groups"), F.max(F.struct("size", "root")).alias("largest"))
        .filter("groups > 1")
        .select("key", F.col("largest.root").alias("main"))
    )
    open_ = scratch.keep(rooted.join(largest, "key"), f"open_{name}")
    return (
        open_.filter("root <> main").alias("a")
        .join(
            open_.alias("b"),
            (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & _in_reach(percent),
        )
        .select(*_pair())
    )


def in_common(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Of pairs, those that share as many prefix shingles as they must, with enough behind these."""
    one, two = (
        prefixes.select(
            F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("alone").alias(f"alone{x}"),
            F.col("matches").alias(f"m{x}"), F.col("keys").alias(f"k{x}"),
        )
        for x in ("a", "b")
    )
    behind = lambda x: F.col(f"n{x}") - F.col(f"alone{x}") - F.array_position(f"k{x}", F.element_at("common", -1))
    return (
        pairs.distinct()
        .join(one, "a")
        .join(two, "b")
        .withColumn("common", F.array_intersect("ka", "kb"))
        .filter(F.size("common") >= F.least("ma", "mb"))
        .filter(F.size("common") + F.least(behind("a"), behind("b")) >= _needed(F.col("na") + F.col("nb"), percent))
        .select("a", "b", "na", "nb")
    )


def jaccard_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    key: str = "doc_id",
    text: str = "text",
    per_range: int = RANGE,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reached by links, of each row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "prefixes")
    source = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("tid"), F.col(text).alias("text"))

    counted = scratch.keep(
        source.select("text")
        .mapInArrow(_counting(shingle), "token long, n long, total long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total")),
        "counted",
    )
    n_docs, total = counted.filter("token IS NULL").agg(F.max("n"), F.max("total")).first()
    n_docs, ranges = n_docs or 0, (total or 0) // per_range + 1
    # at most EVERYWHERE mean sets of them
    hot = counted.filter(F.col("token").isNotNull() & (F.col("n") * EVERYWHERE >= n_docs)).toPandas()
    places = _place(hot["token"].to_numpy("int64").view(np.uint64), ranges)
    frequent, back = np.unique(places, return_inverse=True)
    often = np.bincount(back, weights=hot["n"], minlength=len(frequent)).astype(np.int64)

    id_type = source.schema["doc_id"].dataType
    arrow = source.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    own = f"node long, doc_id {id_type.simpleString()}, tid long, n int, places int, id1 long, id2 long, hot array<long>, hot_n array<long>"
    blocks = source.withColumn("node", F.monotonically_increasing_id()).mapInArrow(
        _blocks(shingle, ranges, frequent, often, arrow), f"range int, first long, low array<int>, of array<short>, {own}"
    )
    found = scratch.keep(
        blocks.groupBy("range").applyInArrow(_repeated, f"{own}, key long, df long"), "found"
    )
    texts = found.filter("key IS NULL").drop("key", "df")
    tokens = found.filter("key IS NOT NULL").select("node", F.struct("df", "key").alias("token"))

    classes = scratch.keep(
        texts.filter("n > 0")
        .groupBy("id1", "id2")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid", "node")).alias("rep"),
            *(F.first(name).alias(name) for name in ("n", "places")),
            # copies in other tasks may have been given other rows, never other shingles
            F.first("hot").alias("hot"),
            F.first("hot_n").alias("hot_n"),
        )
        .withColumn("node", F.col("rep.node")),
        "classes",
    )
    frequent_ones = F.transform(
        F.arrays_zip("hot_n", "hot"), lambda x: F.struct(x["hot_n"].alias("df"), x["hot"].alias("key"))
    )
    ordered = scratch.keep(
        classes.select("node", "n", "places", frequent_ones.alias("hot"))
        .join(tokens.groupBy("node").agg(F.collect_list("token").alias("tokens")), "node", "left")
        .select(
            "node", "n", "places",
            F.array_sort(F.concat(F.coalesce("tokens", F.array().cast("array<struct<df:bigint,key:bigint>>")), "hot")).alias("shared"),
        )
        .withColumn("alone", F.col("places") - F.size("shared"))
        .filter(_upto(F.lit(1), percent) > 0),
        "ordered",
    )
    prefixes = scratch.keep(prefixes_of(ordered, percent), "prefixes")
    postings = postings_of(prefixes, scratch, "first")

    def linked(found: DataFrame, name: str) -> DataFrame:
        """Of pairs those that share enough of their prefixes, and then of their sets."""
        asked = scratch.keep(in_common(found, prefixes, percent), f"asked_{name}")
        nodes = asked.select(F.col("a").alias("node")).union(asked.select(F.col("b").alias("node"))).distinct()
        wanted = scratch.keep(
            classes.join(nodes, "node").select("node", F.col("rep.doc_id").alias("own_id"), F.col("rep.tid").alias("own_tid")),
            f"wanted_{name}",
        )
        chosen = F.broadcast(wanted) if wanted.count() <= PICKED else wanted
        sets = scratch.keep(
            source.join(chosen, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tid") == F.col("own_tid")))
            .groupBy("node")
            .agg(F.first("text").alias("text"))
            .mapInArrow(_whole(shingle), "node long, own array<long>"),
            f"sets_{name}",
        )
        common = F.size(F.array_intersect("sa", "sb"))
        return scratch.keep(
            asked.join(sets.select(F.col("node").alias("a"), F.col("own").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("own").alias("sb")), "b")
            .filter(100 * common >= percent * (F.col("na") + F.col("nb") - common))
            .select("a", "b"),
            f"links_{name}",
        )

    links = linked(first_pairs(postings, percent), "first")
    groups = components(links, scratch, "first")
    across = pairs_across(postings, groups, percent, scratch, "first")
    more = linked(across, "across")
    if not more.isEmpty():
        groups = components(links.union(more), scratch, "across")
    rooted = classes.select("id1", "id2", "node", "rep.doc_id").join(groups, "node", "left")
    rooted = rooted.select("id1", "id2", "doc_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = scratch.keep(rooted.join(least, "root").select("id1", "id2", "component_id"), "named")
    scratch.leave("found", "named")
    size = F.col("n").cast("long").alias("n_shingles")
    grouped = texts.filter("n > 0").join(named, ["id1", "id2"]).select("doc_id", size, "component_id")
    plain = texts.filter("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return grouped.union(plain)
