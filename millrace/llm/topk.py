"""Exact top-k search by inner product: cover trees over queries and rows, searched together.

Rows are dealt into cells around pivots and each cell into chunks of bounded size; queries likewise, into
groups.  A chunk and a group meet in one task, which builds a cover tree over either and walks
both: a pair of nodes is left out if no query below the one can score as high with any row below the
other as the worst of the group's ``k``-th best scores so far.  A first round searches, for
each group, the chunks nearest to it; its scores then rule out whole chunks for the
second round, by the same bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, work_dir, written

LEAF = 64
#: From a level of the cover tree to the next, radii shrink by this.
BASE = 1.15
#: Rows of a chunk and queries of a group at most (about: chunks are dealt by hash), and pivots.
CHUNK_ROWS, GROUP_ROWS, PIVOTS = 8192, 1024, 32
#: Chunks that a group searches first, and shares that the chunks' summaries are dealt into to meet the groups'.
FIRST, SHARES = 2, 32


class Node:
    """A ball around one of its points; ``rows`` if it is a leaf, else ``children``."""

    __slots__ = ("center", "children", "norm", "radius", "rows")

    def __init__(self, points: np.ndarray, rows: np.ndarray, center: int) -> None:
        away = points[rows] - points[center]
        distance = np.sqrt(np.einsum("ij,ij->i", away, away))
        self.center, self.radius = points[center], float(distance.max())
        self.norm = float(np.sqrt(self.center @ self.center))
        self.rows: np.ndarray | None = rows
        self.children: list[Node] = []
        if len(rows) <= LEAF or self.radius == 0:
            return
        # Cover the points with smaller balls whose centres are further apart than their radius.
        scale, left, parts = self.radius / BASE, np.arange(len(rows)), []
        pick = int(np.flatnonzero(rows == center)[0]) if center in rows else 0
        while len(left):
            own = points[rows[left]] - points[rows[pick]]
            near = np.einsum("ij,ij->i", own, own) <= scale * scale
            parts.append((rows[left[near]], int(rows[pick])))
            left = left[~near]
            if len(left):
                pick = int(left[0])
        parts = _merged_small(parts)
        if len(parts) > 1:
            self.rows = None
            self.children = [Node(points, r, c) for r, c in parts]


def _merged_small(parts: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, int]]:
    """Balls of few points are put together up to a leaf's size; a node measures its radius itself."""
    out, gathered, center = [], [], -1
    for rows, c in parts:
        if len(rows) > LEAF // 4:
            out.append((rows, c))
            continue
        center = c if not gathered else center
        gathered.append(rows)
        if sum(map(len, gathered)) >= LEAF:
            out.append((np.concatenate(gathered), center))
            gathered = []
    if gathered:
        out.append((np.concatenate(gathered), center))
    return out


def bound(a: Node, b: Node) -> float:
    """No point of one ball has a larger inner product with any of the other."""
    top = float(a.center @ b.center) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return top + 1e-9 * (abs(top) + a.norm * b.norm) + 1e-6


class Best:
    """The ``k`` best rows of each query, ties to the smaller id."""

    def __init__(self, query_ids: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.ids, self.k = query_ids, k
        self.floor = floor  # a score that k rows are known to reach, from elsewhere
        self.scores = [np.empty(0, object)] * len(query_ids)
        self.rows = [np.empty(0, np.int64)] * len(query_ids)
        self.worst = floor.copy()

    def add(self, q: int, scores: np.ndarray, rows: np.ndarray) -> None:
        if len(scores) > 8 * self.k:  # only what may be among the best needs sorting
            some = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, rows = scores[some], rows[some]
        scores, rows = np.concatenate((self.scores[q], scores)), np.concatenate((self.rows[q], rows))
        order = np.lexsort((rows, -scores))[: self.k]
        self.scores[q], self.rows[q] = scores[order], rows[order]
        if len(order) == self.k:
            self.worst[q] = max(self.floor[q], scores[order[-1]])


def search(query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray) -> Best:
    """The ``k`` best rows of each query, but the query's own, that score ``floor`` or more."""
    best = Best(query_ids, k, floor)
    if not len(queries) or not len(rows):
        return best
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] < 2**53
    # Integers beyond what doubles hold exactly are multiplied as Python's integers.
    left, right = (queries.astype(float), rows.astype(float)) if exact else (queries.astype(object), rows.astype(object))
    q_root = Node(queries.astype(float), np.arange(len(queries)), 0)
    r_root = Node(rows.astype(float), np.arange(len(rows)), 0)
    tie = count()
    todo = [(-bound(q_root, r_root), next(tie), q_root, r_root)]
    while todo:
        top, _, a, b = heapq.heappop(todo)
        under = _below(a)
        if -top < best.worst[under].min():
            continue
        if a.rows is not None and b.rows is not None:
            scores = left[a.rows] @ right[b.rows].T
            own = query_ids[a.rows][:, None] == row_ids[b.rows][None, :]
            good = (scores >= best.worst[a.rows][:, None]) & ~own
            for i in np.flatnonzero(good.any(axis=1)).tolist():
                some = np.flatnonzero(good[i])
                best.add(int(a.rows[i]), scores[i, some], row_ids[b.rows[some]])
            continue
        split_a = a.rows is None and (b.rows is not None or a.radius >= b.radius)
        for x, y in ((c, b) for c in a.children) if split_a else ((a, c) for c in b.children):
            if (limit := bound(x, y)) >= best.worst[_below(x)].min():
                heapq.heappush(todo, (-limit, next(tie), x, y))
    return best


def _below(node: Node) -> np.ndarray:
    if node.rows is not None:
        return node.rows
    return np.concatenate([_below(c) for c in node.children])


def _vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``id``, ``dim`` and ``vec`` (integers; one zero where there is no component) of the rows that take part."""
    values = F.transform(column(vector_column), lambda x: x.cast("double"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(column(id_column).cast("bigint").alias("id"), values.alias("values"))
    rows = rows.where(F.col("id").isNotNull() & F.col("values").isNotNull()).where(F.forall("values", fine))
    whole = F.transform("values", lambda x: F.floor(x * scale))
    return rows.select("id", F.size("values").alias("dim"), F.when(F.size("values") > 0, whole).otherwise(F.array(F.lit(0).cast("bigint"))).alias("vec"))


def _matrix(batch_column: pa.Array, dim: int) -> np.ndarray:
    return batch_column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch_column), dim)


def _dealt(rows: DataFrame, dim: int, pivots: np.ndarray, size: int) -> DataFrame:
    """Rows with the ``chunk`` they belong to: a pivot's cell, or a share of it of about ``size`` rows."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("vec"), dim).astype(float)
            away = (shared.value**2).sum(axis=1)[None, :] - 2 * points @ shared.value.T
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(away.argmin(axis=1), pa.int64())], ["id", "vec", "cell"])

    celled = in_tasks(rows, nearest, "id bigint, vec array<bigint>, cell bigint")
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("shares"))  # a row a pivot
    shares = {r["cell"]: r["shares"] for r in sizes.collect()}
    of = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]) if shares else F.create_map(F.lit(0), F.lit(1))
    # By row: rows of one id, or equal ones, would all be dealt to one chunk.
    row = F.xxhash64("id", "vec", F.monotonically_increasing_id(), F.lit(7))
    return celled.select("id", "vec", (F.col("cell") * (1 << 32) + F.pmod(row, of[F.col("cell")])).alias("chunk"))


def _balls(rows: DataFrame, dim: int, name: str) -> DataFrame:
    """Of every chunk the mean, its length, and the radius of the ball around it that holds the chunk's rows."""
    mean = rows.groupBy("chunk").agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(dim)]).alias("mean"))
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    away = F.sqrt(square(F.zip_with("vec", "mean", lambda x, y: x - y)))
    radius = rows.select("chunk", "vec").join(mean, "chunk").groupBy("chunk").agg(F.max(away).alias("radius"))
    ball = mean.join(radius, "chunk").select("chunk", "mean", F.sqrt(square(F.col("mean"))).alias("norm"), "radius")
    return ball.select(*[F.col(c).alias(f"{name}_{c}") for c in ball.columns])


def _searched(pairs: DataFrame, groups: DataFrame, chunks: DataFrame, dim: int, k: int) -> DataFrame:
    """The best rows of the queries of each group in each chunk that ``pairs`` (``q_chunk``, ``r_chunk``) names."""
    left = pairs.join(groups.select(F.col("id"), "vec", "floor", F.col("chunk").alias("q_chunk")), "q_chunk")
    asked = pairs.select(F.col("q_chunk").alias("group"), F.col("r_chunk").alias("chunk"))
    right = asked.join(chunks.select("id", "vec", "chunk"), "chunk")

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        q_ids, r_ids = queries["id"].to_numpy(), rows["id"].to_numpy()
        if not len(q_ids) or not len(r_ids):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        floor = queries["floor"].to_numpy(float, na_value=-np.inf)
        best = search(q_ids, np.vstack(queries["vec"]), r_ids, np.vstack(rows["vec"]), k, floor)
        sizes = [len(x) for x in best.rows]
        scores = [int(s) for x in best.scores for s in x]
        return pd.DataFrame({"query_id": np.repeat(q_ids, sizes), "vec_id": np.concatenate(best.rows), "score": np.array(scores, np.int64)})

    joined = left.groupBy("q_chunk", "r_chunk").cogroup(right.groupBy("group", "chunk"))
    return joined.applyInPandas(run, "query_id bigint, vec_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    chunk_rows: int = CHUNK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Components ``x`` become ``floor(scale * x)``; queries are the rows whose id ``every`` divides;
    a query's own row is no candidate.  Ties go to the smaller id.  Rows with a null id, a null vector or a
    null or non-finite component take no part; vectors are compared with those of
    their own length.  With an empty table, or no query, the result is empty.  Repeated ids are
    all candidates, and repeated queries of one id are one query, the smallest vector's.
    """
    spark = vectors.sparkSession
    path = work_dir(spark, "topk")
    rows = written(_vectors(vectors, id_column, vector_column, scale), f"{path}/rows")
    out = []
    for dim in sorted(r["dim"] for r in rows.select("dim").distinct().collect()):
        found = _of_length(rows.where(F.col("dim") == dim).select("id", "vec"), max(dim, 1), k, every, chunk_rows, group_rows, f"{path}/{dim}")
        if found is not None:
            out.append(found)
    if not out:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    every_length = out[0]
    for more in out[1:]:
        every_length = every_length.unionAll(more)
    return every_length


def _of_length(rows: DataFrame, dim: int, k: int, every: int, chunk_rows: int, group_rows: int, path: str) -> DataFrame | None:
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"))
    # Pivots: a sample of bounded size, drawn by a hash of the id.
    picked = rows.orderBy(F.xxhash64("id", F.lit(1)), "id", "vec").limit(PIVOTS).collect()
    pivots = np.array([r["vec"] for r in picked], float).reshape(len(picked), dim)
    chunks = written(_dealt(rows, dim, pivots, chunk_rows), f"{path}/chunks")
    groups = written(_dealt(asked, dim, pivots[: max(1, PIVOTS // 8)], group_rows), f"{path}/groups")
    if groups.isEmpty():
        return None
    q_balls, r_balls = _balls(groups, dim, "q"), _balls(chunks, dim, "r")
    # Groups and chunks are few for the rows they hold; what meets here is one row of each, a share of the
    # chunks at a time.
    product = F.aggregate(F.zip_with("q_mean", "r_mean", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    limit = product + F.col("q_radius") * F.col("r_norm") + F.col("r_radius") * F.col("q_norm") + F.col("q_radius") * F.col("r_radius")
    limit = limit + F.abs(limit) * 1e-9 + F.col("q_norm") * F.col("r_norm") * 1e-9 + 1e-6
    asking = q_balls.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    met = asking.join(r_balls.withColumn("share", F.pmod(F.xxhash64("r_chunk"), F.lit(SHARES)).cast("int")), "share")
    pairs = written(met.select("q_chunk", "r_chunk", product.alias("near"), limit.alias("limit")), f"{path}/pairs")
    nearest = Window.partitionBy("q_chunk").orderBy(F.desc("near"), "r_chunk")
    first = pairs.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= FIRST).select("q_chunk", "r_chunk")
    open_groups = groups.withColumn("floor", F.lit(None).cast("double"))
    begun = written(_searched(first, open_groups, chunks, dim, k), f"{path}/begun")
    floor = _top(begun, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    known = written(groups.join(floor, "id", "left"), f"{path}/known")
    # A group is done with a chunk that can't reach the worst of its k-th best scores.
    worst = known.groupBy(F.col("chunk").alias("q_chunk")).agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("worst"))
    rest = pairs.join(first, ["q_chunk", "r_chunk"], "left_anti").join(worst, "q_chunk").where(F.col("limit") >= F.col("worst"))
    found = begun.unionAll(_searched(rest.select("q_chunk", "r_chunk"), known, chunks, dim, k))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
