"""Nearest neighbours by inner product on a few stable projections and kd-trees.

Inner products become distances by one more component, sqrt(M^2 - |x|^2) with M the largest norm: then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest vectors are those of largest inner product. Vectors are projected
with ``DIMS`` normal (2-stable) directions: the squared projected distance of a pair, over its squared true
distance, follows a chi-square law. A kd-tree over the projections, fitted on a bounded sample, deals all
vectors to cells, and every cell has a kd-tree of its own. A query first searches the cell that is nearest in the
projection, then farther ones, in rounds of four times as many cells. With the k-th best distance d so far, a cell, a leaf or
a single vector at projected distance r is left out once the chi-square test holds: P(chi2 <= r^2 / d^2) >= ``SURE``.
All that is not left out is verified on the original vectors, in double precision, and only what beats the k-th best
leaves a task; as that bound is renewed after each round, a query's rows grow with the logarithm of the number of cells.

Vectors of different lengths have no inner product: each length is searched on its own.

Equal vectors are searched once and keep their smallest ids, so a very common vector is one point.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepulse.llm.common import per_batch, salted_join
from zonepulse.sources.scratch import materialize

DIMS, SURE = 16, 0.97
_CELL, _LEAF, _SAMPLE, _QUERIES = 2048, 128, 65_536, 256
_WIDER = 4  # a round visits so many times the cells of all rounds before


def cell_size(total: int) -> int:
    """Vectors in a cell: few tables are one cell only, and no cell outgrows a task."""
    return max(_LEAF, min(_CELL, 8 * math.isqrt(total)))


def chi_square(x: float, m: int = DIMS) -> float:
    """P(chi2 with an even number m of degrees of freedom <= x)."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def stop_ratio(sure: float = SURE, m: int = DIMS) -> float:
    """The least r^2 / d^2 at which the stopping test holds."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if chi_square(middle, m) >= sure else (middle, high)
    return high


@dataclass
class Tree:
    """kd-tree: boxes of its leaves, and for each inner node (dimension, border, left, right)."""

    nodes: list[tuple]
    low: np.ndarray
    high: np.ndarray

    def leaf_of(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(y), np.int64)
        todo = [(0, np.arange(len(y)))]
        while todo:
            at, rows = todo.pop()
            dim, border, left, right = self.nodes[at]
            if dim < 0:
                out[rows] = left
                continue
            less = y[rows, dim] <= border
            todo += [(left, rows[less]), (right, rows[~less])]
        return out

    def distances(self, y: np.ndarray) -> np.ndarray:
        """Squared projected distance of every point to every leaf's box."""
        out = np.zeros((len(y), len(self.low)))
        for d in range(y.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, d] - y[:, d, None], y[:, d, None] - self.high[:, d]), 0.0)
            out += gap * gap
        return out


def grow(y: np.ndarray, leaves: int, tight: bool = False) -> Tree:
    """Splits at medians of the widest dimension until there are about so many leaves; ``tight``: boxes of the points."""
    nodes: list[tuple] = [()]
    low, high = [], []
    todo = [(0, np.arange(len(y)), np.full(y.shape[1], -np.inf), np.full(y.shape[1], np.inf), leaves)]
    while todo:
        at, rows, a, b, share = todo.pop()
        spread = np.ptp(y[rows], axis=0) if len(rows) > 1 else np.zeros(y.shape[1])
        dim = int(np.argmax(spread)) if len(spread) else 0
        if share <= 1 or len(rows) < 2 or spread[dim] <= 0:
            nodes[at] = (-1, 0.0, len(low), 0)
            low.append(y[rows].min(0) if tight and len(rows) else a)
            high.append(y[rows].max(0) if tight and len(rows) else b)
            continue
        values = np.sort(y[rows, dim])
        border = values[(len(rows) - 1) // 2]
        if border >= values[-1]:  # the upper half is all alike
            border = values[np.searchsorted(values, border) - 1]
        less = y[rows, dim] <= border
        b_left, a_right = b.copy(), a.copy()
        b_left[dim] = a_right[dim] = border
        nodes[at] = (dim, border, len(nodes), len(nodes) + 1)
        nodes += [(), ()]
        todo += [(nodes[at][2], rows[less], a, b_left, share // 2), (nodes[at][3], rows[~less], a_right, b, share - share // 2)]
    return Tree(nodes, np.array(low), np.array(high))


def projection(size: int) -> np.ndarray:
    return np.random.default_rng(5).standard_normal((size + 1, DIMS))


def _extended(x: np.ndarray, largest: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(largest - (x * x).sum(1), 0.0))[:, None]])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v, norm, size): rows whose vectors have only finite components and are not zero."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: F.coalesce(~(F.abs(x) <= 1.7976931348623157e308) | F.isnan(x), F.lit(True)))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)
    return rows.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).filter("norm > 0").withColumn("size", F.size("v"))


def _best(scores: np.ndarray, first: np.ndarray, keep: int) -> np.ndarray:
    return np.lexsort((first, -scores), axis=-1)[:, :keep]


class Cell:
    """The vectors of one cell with a kd-tree over their projections."""

    def __init__(self, keys: np.ndarray, first: np.ndarray, x: np.ndarray, largest: float, g: np.ndarray):
        y = _extended(x, largest) @ g
        tree = grow(y, max(1, len(x) // _LEAF), tight=True)
        self.tree, self.largest = tree, largest
        self.leaves = []
        at = tree.leaf_of(y)
        for leaf in range(len(tree.low)):
            rows = np.flatnonzero(at == leaf)
            self.leaves.append((keys[rows], first[rows], x[rows], y[rows]))

    def search(self, q: np.ndarray, y: np.ndarray, worst: np.ndarray, keep: int, ratio: float):
        """Keys, smallest ids and scores of up to ``keep`` neighbours of each query; ``worst``: scores to reach."""
        n = len(q)
        keys, first = np.zeros((n, keep), np.int64), np.full((n, keep), np.iinfo(np.int64).max)
        scores = np.full((n, keep), -np.inf)
        norms = (q * q).sum(1) + self.largest
        apart = self.tree.distances(y)
        for leaf in np.argsort(apart.mean(0), kind="stable"):
            k, f, x, at = self.leaves[leaf]
            bar = np.maximum(scores[:, -1], worst)
            reach = np.maximum(norms - 2 * bar, 0.0) * ratio + 1e-9
            near = np.flatnonzero(apart[:, leaf] < reach)
            if not len(near) or not len(k):
                continue
            # the test for every single vector: its projected distance against the k-th best true one
            far = (y[near] ** 2).sum(1)[:, None] + (at**2).sum(1) - 2 * y[near] @ at.T >= reach[near, None]
            open_ = ~far.all(1)
            near, far = near[open_], far[open_]
            if not len(near):
                continue
            s = np.where(far, -np.inf, np.einsum("ij,kj->ik", q[near], x, optimize=True))
            hit = (s >= bar[near, None] - 1e-12).any(1)
            rows = near[hit]
            if not len(rows):
                continue
            all_s = np.hstack([scores[rows], s[hit]])
            all_f = np.hstack([first[rows], np.broadcast_to(f, (len(rows), len(f)))])
            all_k = np.hstack([keys[rows], np.broadcast_to(k, (len(rows), len(k)))])
            order = _best(all_s, all_f, keep)
            scores[rows], first[rows], keys[rows] = (np.take_along_axis(a, order, 1) for a in (all_s, all_f, all_k))
        return keys, first, scores


def _searched(points: DataFrame, asked: DataFrame, size: int, largest: float, keep: int) -> DataFrame:
    """Best neighbours of the queries asked in each unit; a unit's vectors are held, its queries stream past."""
    schema = "q bigint, key bigint, first bigint, score double"
    data = points.select("unit", F.lit(0).alias("role"), F.col("key").alias("q"), "first", "x", F.lit(None).cast("double").alias("worst"))
    ask = asked.select("unit", F.lit(1).alias("role"), "q", F.lit(0).cast("bigint").alias("first"), "x", "worst")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, ratio = projection(size), stop_ratio()
        held: list[tuple] = []
        cell: Cell | None = None
        current = None
        for batch in batches:
            unit, role = batch["unit"].to_numpy(), batch["role"].to_numpy()
            cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]) | (role[1:] != role[:-1])) + 1), len(unit)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                ids, x = part["q"].to_numpy(), _matrix(part["x"], size)
                if role[a] == 0:
                    if unit[a] != current:
                        current, held, cell = unit[a], [], None
                    held.append((ids, part["first"].to_numpy(), x))
                    continue
                if unit[a] != current:  # no vector in this unit
                    continue
                if cell is None:
                    cell = Cell(*(np.concatenate([h[i] for h in held]) for i in range(3)), largest, g)
                worst = np.nan_to_num(part["worst"].to_numpy(zero_copy_only=False).astype(float), nan=-np.inf, neginf=-np.inf)
                for at in range(0, len(x), _QUERIES):
                    some = slice(at, at + _QUERIES)
                    keys, first, scores = cell.search(x[some], x[some] @ g[:-1], worst[some], keep, ratio)
                    real = np.isfinite(scores) & (scores >= worst[some, None])
                    yield pa.record_batch({
                        "q": pa.array(np.repeat(ids[some], real.sum(1)), pa.int64()), "key": pa.array(keys[real], pa.int64()),
                        "first": pa.array(first[real], pa.int64()), "score": pa.array(scores[real], pa.float64()),
                    })

    dealt = data.unionByName(ask).repartition("unit").sortWithinPartitions("unit", "role")
    return dealt.mapInArrow(run, schema)


def _top(rows: DataFrame, by: str, keep: int, *order) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("place") <= keep)


def search(embeddings: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for every row that ``is_query`` picks.

    Nearest first, ties to the smaller vec_id; fewer than ``k`` only if there are no more candidates. Rows with a
    null vec_id, or a vector that is null, zero or not finite, take no part; a repeated row counts once; an empty
    table gives no rows. ``is_query``: a condition on vec_id.
    """
    rows = valid_vectors(embeddings).withColumn("key", F.xxhash64("v"))
    rows = materialize(rows.withColumn("query", is_query(F.col("vec_id"))), "vectors")
    lengths = sorted(r[0] for r in rows.select("size").distinct().collect())  # one number for each length of a vector
    found = [_search(rows.filter(F.col("size") == size), size, k) for size in lengths]
    empty = embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, found) if found else empty


def _search(rows: DataFrame, size: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    ids = rows.select("key", "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    some = ids.withColumn("n", F.row_number().over(Window.partitionBy("key", "salt").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    some = materialize(_top(some, "key", k + 1, "vec_id").select("key", "vec_id"), "ids")
    largest, total = rows.agg(F.max("norm"), F.approx_count_distinct("key")).first()

    one = rows.groupBy("key").agg(F.min(F.struct("vec_id", "v")).alias("a"), F.max("query").alias("query"))
    one = one.select("key", F.col("a.vec_id").alias("first"), F.col("a.v").alias("v"), "query")
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, total // _SAMPLE))) == 0).select("v").limit(2 * _SAMPLE)
    g = projection(size)
    points = sample.toArrow()["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    points = points if len(points) else np.zeros((1, size))
    tree = grow(_extended(points, largest) @ g, max(1, min(-(-total // cell_size(total)), len(points) // 8)))
    shared = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def assign():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            x = b["v"].values.to_numpy(zero_copy_only=False)[b["v"].offsets[0].as_py() : b["v"].offsets[-1].as_py()].reshape(-1, size)
            cells = shared.value.leaf_of(_extended(x, largest) @ g)
            return pa.record_batch({
                "key": b["key"], "first": b["first"], "query": b["query"], "cell": pa.array(cells, pa.int64()),
                "x": pa.array([r.tobytes() for r in x], pa.binary()),
            })

        return step

    placed = materialize(one.mapInArrow(per_batch(assign), "key bigint, first bigint, query boolean, cell bigint, x binary"), "cells")
    # a cell of more vectors than planned is searched in several units
    parts = {r["cell"]: -(-r["count"] // (4 * _CELL)) for r in placed.groupBy("cell").count().collect()}  # bounded by the tree
    split = F.create_map(*[F.lit(x) for c, n in parts.items() if n > 1 for x in (c, n)]) if max(parts.values()) > 1 else None
    share = F.coalesce(split[F.col("cell")], F.lit(1)) if split is not None else F.lit(1)
    unit = lambda part: F.col("cell") * 65536 + part
    units = placed.withColumn("unit", unit(F.pmod(F.xxhash64("key"), share)))
    asked = placed.filter("query").select(F.col("key").alias("q"), "x")

    def route(since: int, until: int):
        """Queries with the cells that are the ``since``-th to ``until``-th nearest ones and that the test does not rule out."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ratio = stop_ratio()
            for whole in batches:
                for start in range(0, whole.num_rows, _QUERIES):
                    b = whole.slice(start, _QUERIES)
                    x = _matrix(b["x"], size)
                    worst = np.nan_to_num(b["worst"].to_numpy(zero_copy_only=False).astype(float), nan=-np.inf, neginf=-np.inf)
                    reach = np.maximum((x * x).sum(1) + largest - 2 * worst, 0.0) * ratio + 1e-9
                    apart = shared.value.distances(x @ g[:-1])
                    order = np.argsort(apart, axis=1, kind="stable")[:, since:until]
                    row, at = np.nonzero(np.take_along_axis(apart, order, 1) < reach[:, None])
                    yield pa.record_batch({"q": b["q"].take(row), "x": b["x"].take(row), "worst": b["worst"].take(row), "cell": pa.array(order[row, at], pa.int64())})

        return run

    def visited(bounds: DataFrame, since: int, until: int) -> DataFrame | None:
        go = materialize(bounds.mapInArrow(route(since, until), "q bigint, x binary, worst double, cell bigint"), "visits")
        if go.isEmpty():
            return None  # nor does any query reach a farther cell
        sent = go.withColumn("part", F.explode(F.sequence(F.lit(0), share - 1))).withColumn("unit", unit(F.col("part")))
        return _searched(units, sent, size, largest, k + 1)

    def best(found: DataFrame) -> DataFrame:
        return materialize(_top(found, "q", k + 1, F.desc("score"), "first").select("q", "key", "first", "score"), "found")

    start = visited(asked.withColumn("worst", F.lit(None).cast("double")), 0, 1)
    found = best(start) if start is not None else spark.createDataFrame([], "q bigint, key bigint, first bigint, score double")
    since = 1
    while start is not None and since < len(tree.low):
        reached = found.groupBy("q").agg(F.min("score").alias("low"), F.count("*").alias("n"))
        bounds = asked.join(reached, "q", "left").select("q", "x", F.when(F.col("n") > k, F.col("low")).alias("worst"))
        more = visited(bounds, since, since * _WIDER)
        if more is None:
            break
        found, since = best(found.unionByName(more)), since * _WIDER
    found = found.select("q", "key", "score")
    named = found.join(some, "key")  # at most k + 1 ids of each vector
    lists = _top(named, "q", k + 1, F.desc("score"), "vec_id").select(F.col("q").alias("of"), "vec_id", "score")
    queries = rows.filter("query").select(F.col("vec_id").alias("query_id"), "key").distinct()
    out = salted_join(queries, lists, lambda a, b: a["key"] == b["of"], F.col("query_id"), "inner").filter("vec_id != query_id")
    out = _top(out, "query_id", k, F.desc("score"), "vec_id")
    return out.select("query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")
