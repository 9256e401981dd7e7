"""Approximate nearest neighbours by stable projections and kd-trees with a chi-square stop.

Vectors are projected on ``DIMS`` random Gaussian directions. For a vector at distance d from a
query the squared projected distance over d squared is chi-square with ``DIMS`` degrees of
freedom. So when the next projected distance is so large that a vector as near as the
best ones so far would have had a smaller one with probability ``SURE``, the search ends.

A kd-tree over the projections of at most ``SAMPLE`` vectors cuts space into cells, which hold all
vectors. A query first searches its own cell, then those cells that pass the test with the
distance found. In a task a cell, or a part of a large one, is searched by its own kd-tree: leaf
after leaf by projected distance, every vector of a leaf verified by its true distance, until
the test holds. Equal vectors all share a leaf distance of nothing, so ties are settled by id.

Vectors that are NULL, empty, zero, or hold NULL, NaN or infinite components take no part; neither do
NULL ids. Vectors are compared with those of their length; cells are made for the most frequent length, and
each other one is a cell of its own, searched in parts. Repeated ids are separate rows as candidates, but a
query has no row of its own id as neighbour; a query's repeated row asks once, and two vectors of
one id are two queries, each with ranks of its own. With fewer candidates than asked for, all are given.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filmlake.llm.steps import Scratch

K = 10
DIMS = 8
SURE = 0.98
SAMPLE = 20_000
CELL_ROWS = 4096
LEAF_ROWS = 64
# queries searched together in a task
TOGETHER = 256

_FOUND = "query_id long, query long, vec_id long, score double"


def directions(length: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(11)).standard_normal((length, DIMS))


def projected(vectors: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Row by row the same sums in the same order, so that equal vectors have equal projections.

    A matrix product may add a row's terms in another order where the number of rows differs; equal
    vectors would then lie a little apart, and ties at distance 0 could be missed.
    """
    out = np.zeros((len(vectors), project.shape[1]))
    for i, row in enumerate(project):
        out += vectors[:, i, None] * row
    return out


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function for ``DIMS`` degrees of freedom, an even number."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, DIMS // 2):
        term = term * half / i
        total = total + term
    return np.where(np.isinf(x), 1.0, 1 - np.exp(-half) * np.where(np.isinf(x), 0, total))


def settled(projected: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Whether nothing at a projected distance (squared) or beyond is likely to be nearer than ``distance``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(projected > 0, projected / (distance * distance), 0.0)
    return chi_square(np.where(np.isnan(ratio), 0.0, ratio)) >= SURE


def split(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree, cut in half at the widest direction."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        own = points[rows]
        axis = np.argmax(own.max(axis=0) - own.min(axis=0))
        order = rows[np.argsort(own[:, axis], kind="stable")]
        open_ += [order[len(order) // 2 :], order[: len(order) // 2]]
    return done


class Cells:
    """A kd-tree over a sample, its ``2 ** depth`` cells and the box of each."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth, inner = depth, (1 << depth) - 1
        self.axis, self.at = np.zeros(inner, dtype=np.int64), np.zeros(inner)
        open_ = {0: (sample, np.full(DIMS, -np.inf), np.full(DIMS, np.inf))}
        for node in range(inner):
            own, low, high = open_.pop(node)
            axis = int(np.argmax(np.ptp(own, axis=0))) if len(own) else 0
            at = float(np.median(own[:, axis])) if len(own) else 0.0
            self.axis[node], self.at[node] = axis, at
            middle_high, middle_low = high.copy(), low.copy()
            middle_high[axis] = middle_low[axis] = at
            below = own[:, axis] < at
            open_[2 * node + 1] = own[below], low, middle_high
            open_[2 * node + 2] = own[~below], middle_low, high
        self.low = np.array([open_[inner + i][1] for i in range(inner + 1)])
        self.high = np.array([open_[inner + i][2] for i in range(inner + 1)])

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.at[node])
        return node - ((1 << self.depth) - 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared projected distance of each point from each cell."""
        return outside(points, self.low, self.high)


def outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
    return (gap * gap).sum(axis=2)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _searcher(k: int):
    def run(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(asked):
            vectors, ids = _matrix(data["vector"]), data["vec_id"].to_numpy()
            project = directions(vectors.shape[1])
            points = projected(vectors, project)
            leaves = split(points, LEAF_ROWS)
            low = np.array([points[rows].min(axis=0) for rows in leaves])
            high = np.array([points[rows].max(axis=0) for rows in leaves])
            padded = np.full((len(leaves), LEAF_ROWS), -1, dtype=np.int64)
            for i, rows in enumerate(leaves):
                padded[i, : len(rows)] = rows
            for first in range(0, len(asked), TOGETHER):
                part = asked.iloc[first : first + TOGETHER]
                own, name, query = _matrix(part["vector"]), part["query_id"].to_numpy(), part["query"].to_numpy()
                limit = part["reach"].to_numpy()
                far = outside(projected(own, project), low, high)
                order = np.argsort(far, axis=1, kind="stable")
                best = np.full((len(own), k), np.inf)
                who = np.full((len(own), k), np.iinfo(np.int64).max)
                live = np.arange(len(own))
                for step in range(len(leaves)):
                    leaf = order[live, step]
                    going = ~settled(far[live, leaf], np.minimum(best[live, -1], limit[live]))
                    live, leaf = live[going], leaf[going]
                    if not len(live):
                        break
                    rows = padded[leaf]
                    apart = vectors[rows] - own[live][:, None]
                    apart = np.sqrt((apart * apart).sum(axis=2))
                    apart[(rows < 0) | (ids[rows] == name[live][:, None])] = np.inf
                    both = np.concatenate([best[live], apart], axis=1)
                    names = np.concatenate([who[live], ids[rows]], axis=1)
                    top = np.lexsort((names, both), axis=1)[:, :k]
                    best[live] = np.take_along_axis(both, top, axis=1)
                    who[live] = np.take_along_axis(names, top, axis=1)
                hit = np.isfinite(best)
                times = hit.sum(axis=1)
                found.append(pd.DataFrame({
                    "query_id": np.repeat(name, times), "query": np.repeat(query, times),
                    "vec_id": who[hit], "score": best[hit],
                }))
        empty = pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        return pd.concat(found) if found else empty

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    rows = rows.filter(~bad & F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))


def search(
    vectors: DataFrame, is_query, k: int = K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows of each query.

    ``is_query`` is a condition on ``vec_id``; queries are searched in all rows.
    """
    scratch = Scratch(vectors.sparkSession, "nearest")
    rows = usable(vectors, key, vector)
    total = rows.count()
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "length").first()
    usual = F.size("vector") == (most.length if most else 0)
    sample = rows.filter(usual).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    points = _matrix(sample["vector"]) if len(sample) else np.zeros((1, 1))
    project = directions(points.shape[1])
    # as many cells as whole ones take, and a sample that has enough points in each
    depth = max(0, int(np.ceil(np.log2(max(1, min(total / CELL_ROWS, len(sample) / 16))))))
    cells = Cells(projected(points, project), depth)

    def assign(batches):
        for batch in batches:
            if len(batch):
                sizes = batch["vector"].map(len).to_numpy()
                own = sizes == len(project)
                # each other length is a cell by itself
                cell = -sizes.astype(np.int64)
                if own.any():
                    cell[own] = cells.of(projected(_matrix(batch["vector"][own]), project))
                batch["cell"] = cell
                yield batch

    kind = rows.schema["vector"].dataType.simpleString()
    index = scratch.keep(rows.mapInPandas(assign, f"vec_id long, vector {kind}, cell long"), "index")
    # a row that is there again asks the same; other vectors of its id ask for themselves
    queries = (
        index.filter(is_query)
        .dropDuplicates(["vec_id", "vector"])
        .withColumnRenamed("vec_id", "query_id")
        .withColumn("query", F.xxhash64("query_id", "vector"))
    )

    def found(visits: DataFrame, name: str) -> DataFrame:
        """Nearest rows of each visit, in parts of a cell and of its visits that fit a task."""
        visits = scratch.keep(visits, f"visits_{name}")
        held = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        come = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("q"))
        parts = scratch.keep(
            held.join(come, "cell").select(
                "cell",
                F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts"),
                F.ceil(F.col("q") / CELL_ROWS).cast("int").alias("turns"),
            ),
            f"parts_{name}",
        )
        data = index.join(parts, "cell").select(
            "cell", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "vec_id", "vector",
        )
        asked = visits.join(parts, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("query"), "turns").cast("int").alias("turn"), "query_id", "query", "vector", "reach",
        )
        by = ["cell", "part", "turn"]
        out = data.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(_searcher(k), _FOUND)
        return scratch.keep(out, f"found_{name}")

    own = found(queries.withColumn("reach", F.lit(float("inf"))), "own")
    nearest = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    reach = own.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") == k)

    def elsewhere(batches):
        for batch in batches:
            if len(batch):
                at = projected(_matrix(batch["vector"]), project)
                far = cells.distances(at)
                go = ~settled(far, batch["reach"].to_numpy()[:, None])
                go[np.arange(len(batch)), batch["cell"].to_numpy()] = False
                row, cell = np.nonzero(go)
                out = batch.iloc[row].copy()
                out["cell"] = cell
                yield out

    more = (
        queries.filter("cell >= 0")
        .join(reach.select("query_id", "query", F.col("score").alias("reach")), ["query_id", "query"], "left")
        .fillna(float("inf"), ["reach"])
        .select("query_id", "query", "vector", "cell", "reach")
        .mapInPandas(elsewhere, f"query_id long, query long, vector {kind}, cell long, reach double")
    )
    both = own.union(found(more, "more"))
    return (
        both.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
