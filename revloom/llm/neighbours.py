"""Nearest neighbours by inner product: a forest of random-projection trees, searched through one priority queue.

Largest inner product becomes smallest angle when each vector gets one more coordinate that brings all to the largest norm.
Trees are grown on a bounded sample: a node is split by the hyperplane between the means of two groups of its points, at
the middle value, until few points are left. Every vector is then routed to its leaf of each tree by Spark tasks. A query
walks all trees at once: one queue holds the open nodes of all, the one whose worst margin on the way is best comes next,
until the leaves reached hold enough vectors by their true counts. Leaves are joined with the queries that reached them,
split into blocks where they are large, scored exactly in double precision, and each query's best are merged. What is worse
than the k-th best of the sample's points in the leaves that a query reached is left out before that.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.shared import folder, runs, stored

SEED = 41
#: Vectors that the trees are grown on, those with the smallest hash of vec_id and vector; bounds what the driver gets.
SAMPLE_ROWS = 20_000
TREES = 24
#: Points of the sample in a leaf, at most.
LEAF = 128
#: The queue runs until leaves hold this many times k vectors for each tree, and until this share of all leaves is reached:
#: enough for a recall above 0.9 even of directions without any clusters, where trees help least.
VISIT, VISIT_LEAVES = 10, 0.06
#: Vectors of a leaf in a block, and queries scored at a time.
BLOCK, QUERIES = 4096, 256


class Tree:
    """Nodes in arrays: normal and offset of each split, and its two children; a child below zero is leaf -1 - child."""

    def __init__(self, points: np.ndarray, draw: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        waiting = [(np.arange(len(points)), None)]
        while waiting:
            own, place = waiting.pop()
            split = self._split(points[own], draw) if len(own) > LEAF else None
            if split is None:
                me = -1 - self.leaves
                self.leaves += 1
            else:
                me = len(self.normals)
                normal, offset, right = split
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([0, 0])
                waiting += [(own[~right], (me, 0)), (own[right], (me, 1))]
            if place is None:
                self.root = me
            else:
                self.children[place[0]][place[1]] = me
        self.normals = np.array(self.normals).reshape(len(self.offsets), points.shape[1])
        self.offsets, self.children = np.array(self.offsets), np.array(self.children, dtype=np.int64).reshape(-1, 2)

    @staticmethod
    def _split(points: np.ndarray, draw: np.random.Generator):
        """The normal from one of two centres to the other, after some rounds of moving them; None where all points agree."""
        a, b = points[draw.choice(len(points), 2, replace=False)]
        for _ in range(4):
            nearer = ((points - a) ** 2).sum(1) < ((points - b) ** 2).sum(1)
            if nearer.all() or not nearer.any():
                break
            a, b = points[nearer].mean(0), points[~nearer].mean(0)
        normal = b - a
        size = np.linalg.norm(normal)
        if not size:
            normal = draw.standard_normal(points.shape[1])
            size = np.linalg.norm(normal)
        normal = normal / size
        along = points @ normal
        low, high = along.min(), along.max()
        if not high - low > 1e-9 * max(abs(low), abs(high)):
            return None
        # between two values, so that routing the same points later cannot round them to the other side
        middle = min(np.median(along), along[along < high].max())
        offset = float((along[along <= middle].max() + along[along > middle].min()) / 2)
        right = along > offset
        return normal, offset, right

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), self.root, dtype=np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            along = np.einsum("ij,ij->i", points[inner], self.normals[node])
            at[inner] = self.children[node, (along > self.offsets[node]).astype(np.int64)]
        return -1 - at


class Forest:
    def __init__(self, sample: np.ndarray, rows: np.ndarray, largest: float):
        self.sample, self.rows = sample, rows
        draw = np.random.default_rng(SEED)
        self.largest = largest
        points = self.widened(sample) if len(sample) else np.zeros((1, 2))
        self.trees = [Tree(points, draw) for _ in range(TREES)]
        self.members = []
        for t in self.trees:
            leaf = t.leaf_of(points) if len(sample) else np.empty(0, np.int64)
            order = np.argsort(leaf, kind="stable").astype(np.int32)
            self.members.append(np.split(order, np.cumsum(np.bincount(leaf, minlength=t.leaves))[:-1]))

    def widened(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that brings all to the same norm, which becomes 1."""
        x = x / self.largest
        return np.hstack([x, np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))])

    def bounds(self, rows: np.ndarray, queries: np.ndarray, found: list[list[tuple[int, int]]], k: int) -> np.ndarray:
        """What each query's k-th best cannot fall below: the k-th best of the sample in the leaves that it reached, rounding aside."""
        out = np.full(len(queries), -np.inf)
        scores = queries @ self.sample.T
        scores[rows[:, None] == self.rows[None, :]] = -np.inf
        for i, leaves in enumerate(found):
            there = np.zeros(len(self.sample), dtype=bool)
            for tree, leaf in leaves:
                there[self.members[tree][leaf]] = True
            own = scores[i][there]
            if len(own) > k:
                least = np.partition(own, -k)[-k]
                out[i] = least - 1e-9 * abs(least) - 1e-300
        return out

    def reached(self, query: np.ndarray, counts: list[np.ndarray], enough: int, leaves: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the queue until `leaves` leaves were reached that hold `enough` vectors, or all leaves."""
        q = np.append(query, 0.0) / max(np.linalg.norm(query), 1e-300)
        margins = [t.normals @ q - t.offsets for t in self.trees]
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        out, held = [], 0
        while queue and (held < enough or len(out) < leaves):
            worst, k, node = heapq.heappop(queue)
            if node < 0:
                if counts[k][-1 - node]:
                    out.append((k, -1 - node))
                    held += counts[k][-1 - node]
                continue
            m = margins[k][node]
            left, right = self.trees[k].children[node]
            # smaller first: how far the query lies on the wrong side, at worst
            heapq.heappush(queue, (max(worst, m), k, int(left)))
            heapq.heappush(queue, (max(worst, -m), k, int(right)))
        return out


def _prepared(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            packed, norms = [], []
            for x in batch.column("embedding"):
                v = x.values.to_numpy(zero_copy_only=False).astype(kind) if x.is_valid and len(x) and not x.values.null_count else None
                good = v is not None and np.isfinite(v).all() and v.any()
                packed.append(v.tobytes() if good else None)
                norms.append(float(np.linalg.norm(v.astype(np.float64))) if good else None)
            yield pa.record_batch([pa.array(np.arange(row, row + batch.num_rows)), batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(norms, pa.float64())],
                                  names=["row_id", "vec_id", "vector", "norm"])
            row += batch.num_rows

    return run


def _matrix(column, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column]).astype(np.float64)


def _routed(sent, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                points = forest.widened(_matrix(part.column("vector"), kind))
                for k, tree in enumerate(forest.trees):
                    yield pa.record_batch([part.column("row_id"), pa.array(np.full(part.num_rows, k, np.int32)), pa.array(tree.leaf_of(points).astype(np.int32))], names=["row_id", "tree", "leaf"])

    return run


def _searched(sent, kind: str, counts: list[np.ndarray], k: int, leaves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for batch in batches:
            for low in range(0, batch.num_rows, QUERIES):
                part = batch.slice(low, QUERIES)
                ids, queries = part.column("row_id").to_numpy(), _matrix(part.column("vector"), kind)
                found = [forest.reached(q, counts, VISIT * k * TREES, leaves) for q in queries]
                least = forest.bounds(ids, queries, found, k)
                size = [len(x) for x in found]
                flat = np.array([x for one in found for x in one], dtype=np.int32).reshape(-1, 2)
                yield pa.record_batch([pa.array(np.repeat(ids, size)), pa.array(flat[:, 0]), pa.array(flat[:, 1]), pa.array(np.repeat(least, size))],
                                      names=["row_id", "tree", "leaf", "least"])

    return run


def _best(kind: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["tree", "leaf", "block"]):
            least = cell.column("least").to_numpy(zero_copy_only=False)
            asks = ~np.isnan(least)
            ids, rows, x = cell.column("vec_id"), cell.column("row_id").to_numpy(), _matrix(cell.column("vector"), kind)
            named = ids.to_numpy()
            there, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
            # smaller vec_id first, so that a stable order by score settles ties
            there = there[np.lexsort((rows[there], named[there]))]
            for low in range(0, len(queries), QUERIES):
                q = queries[low : low + QUERIES]
                scores = x[q] @ x[there].T
                scores[rows[q][:, None] == rows[there][None, :]] = -np.inf
                first = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                at, place = np.repeat(np.arange(len(q)), first.shape[1]), first.ravel()
                found = scores[at, place]
                keep = np.isfinite(found) & (found >= least[q][at])
                at, place = at[keep], there[place[keep]]
                # one and the same sum for equal vectors, whatever the block
                found = np.einsum("ij,ij->i", x[q[at]], x[place])
                yield pa.record_batch([pa.array(rows[q[at]]), pa.array(named[q[at]]), pa.array(rows[place]), pa.array(named[place]), pa.array(found)],
                                      names=["query_row", "query_id", "row_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """The k vectors of the largest inner product found for each query among all rows but its own.

    vectors: vec_id long, embedding array of float or double; other columns are ignored. `is_query` is a condition on
    vec_id. Columns: query_id, rank (int from 1), vec_id, score (the inner product of the vectors in double precision), nearest
    first, ties to the smaller vec_id. All candidates where they are fewer than k. Rows take no part if vec_id is null, or
    the vector is null, empty, zero or holds null or non-finite numbers, or has another length than most. Rows that share a
    vec_id are rows of their own. An empty table, or no query, gives no rows.
    """
    spark = vectors.sparkSession
    place = folder(spark)
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    if kind == "<f8":
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull())
    rows = stored(rows.mapInArrow(_prepared(kind), "row_id long, vec_id long, vector binary, norm double").where(F.col("vector").isNotNull()), f"{place}/rows")
    common = rows.groupBy(F.length("vector").alias("length")).agg(F.count("*").alias("n"), F.max("norm").alias("largest")).orderBy(F.desc("n"), "length").first()
    out = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], out)
    rows = rows.where(F.length("vector") == common["length"])
    sample = rows.select("row_id", "vector", F.xxhash64("vec_id", "vector").alias("at")).orderBy("at", "row_id").limit(SAMPLE_ROWS).collect()
    points = np.stack([np.frombuffer(r["vector"], kind) for r in sample]).astype(np.float64)
    forest = Forest(points, np.array([r["row_id"] for r in sample]), common["largest"])
    sent = spark.sparkContext.broadcast(forest)
    index = stored(rows.select("row_id", "vector").mapInArrow(_routed(sent, kind), "row_id long, tree int, leaf int"), f"{place}/index")
    counts = [np.zeros(t.leaves, np.int64) for t in forest.trees]
    for r in index.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():  # as many as leaves, which the sample bounds
        counts[r["tree"]][r["leaf"]] = r["n"]
    leaves = round(VISIT_LEAVES * sum(t.leaves for t in forest.trees))
    asking = rows.where(is_query)
    reached = stored(asking.select("row_id", "vector").mapInArrow(_searched(sent, kind, counts, k, leaves), "row_id long, tree int, leaf int, least double"), f"{place}/reached")
    # blocks of large leaves: their vectors are dealt, their queries go to each
    blocks = [(t, int(n), -(-int(c) // BLOCK)) for t, of in enumerate(counts) for n, c in enumerate(of) if c > BLOCK]
    large = spark.createDataFrame(blocks, "tree int, leaf int, blocks int")
    visited = reached.select("tree", "leaf").distinct()
    dealt = index.join(visited, ["tree", "leaf"], "left_semi").join(F.broadcast(large), ["tree", "leaf"], "left")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row_id"), F.coalesce("blocks", F.lit(1))).cast("int")).withColumn("least", F.lit(float("nan")))
    asked = reached.join(F.broadcast(large), ["tree", "leaf"], "left")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    cells = dealt.select("row_id", "tree", "leaf", "block", "least").union(asked.select("row_id", "tree", "leaf", "block", "least"))
    cells = cells.join(rows.select("row_id", "vec_id", "vector"), "row_id").repartition("tree", "leaf", "block").sortWithinPartitions("tree", "leaf", "block")
    found = cells.mapInArrow(_best(kind, k), "query_row long, query_id long, row_id long, vec_id long, score double")
    found = found.groupBy("query_row", "query_id", "row_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
