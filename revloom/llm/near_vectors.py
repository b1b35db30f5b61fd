"""Links between vectors of a label with a high cosine, by spherical-cap filters.

Filters are the directions of a product code: the space, turned at random, is cut in two halves with a small random code of
unit vectors each, and every pair of codewords is a filter. A vector is listed by all filters whose inner product with it
is at least its largest one less a margin; sorted inner products of the halves give them without a look at the others. Of
two linked vectors take the one whose largest inner product is larger: the other one's inner product with that filter
falls below its own list's threshold only if their difference points more than MARGIN_SIGMAS standard deviations against
the filter, a chance of about 3e-7. So vectors meet in the filter that is best for one of them; there the cosine is verified
in double precision, for that pair in that filter alone. Filters grow with the number of vectors, so lists stay short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.components import components
from revloom.llm.shared import block_pairs, folder, runs, smallest_reached, stored

SEED = 20_240_229
#: Vectors per filter, and filters at least.
PER_FILTER, LEAST_FILTERS = 200, 16
MARGIN_SIGMAS = 5.0
#: Vectors in a block of a filter's list, and rows of the product that a task holds at a time.
BLOCK, ROWS = 4096, 256


class Code:
    """The filters for vectors of one length."""

    def __init__(self, length: int, filters: int):
        draw = np.random.default_rng([SEED, length])
        self.turn = np.linalg.qr(draw.standard_normal((length, length)))[0]
        self.cut = length // 2
        size = max(2, round(filters**0.5))
        self.words = []
        for n in (self.cut, length - self.cut):
            w = draw.standard_normal((size if n else 1, max(n, 1)))
            # two halves of length 1 / sqrt 2 make a filter of length 1
            self.words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / 2**0.5 if n else np.zeros((1, 0)))

    def decode(self, units: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, whether it is the row's best) for all listed filters, and each row's largest inner product."""
        turned = units @ self.turn
        a, b = turned[:, : self.cut] @ self.words[0].T, turned[:, self.cut :] @ self.words[1].T
        best = a.max(1) + b.max(1)
        top = a.argmax(1) * b.shape[1] + b.argmax(1)
        # a linked vector's inner product is cosine times this one's, and a part across it
        across = (1 - cosine * cosine) ** 0.5
        margin = MARGIN_SIGMAS * across / units.shape[1] ** 0.5 + (1 - cosine) * np.abs(best)
        order = np.argsort(-b, axis=1)
        falling = -np.take_along_axis(b, order, 1)
        rows, filters = [], []
        for i in range(len(units)):
            # of each word of the first half, the words of the second in falling order until the sum is too small
            many = np.searchsorted(falling[i], a[i] - best[i] + margin[i], side="right")
            first = np.repeat(np.arange(len(many)), many)
            second = order[i][np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            filters.append(first * b.shape[1] + second)
            rows.append(np.full(len(first), i))
        row, chosen = np.concatenate(rows), np.concatenate(filters)
        return row, chosen, chosen == top[row], best


def _prepared(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            size = batch.num_rows
            labels, vectors = batch.column("label"), batch.column("embedding")
            packed, digests = [], []
            for label, x in zip(labels.to_pylist(), vectors, strict=True):
                usable = x.is_valid and label is not None and len(x) and not x.values.null_count
                v = np.asarray(x.values.to_numpy(zero_copy_only=False), dtype=kind) if usable else None
                if usable and np.isfinite(v).all() and v.any():
                    packed.append(v.tobytes())
                    digests.append(hashlib.blake2b(packed[-1] + str(label).encode(), digest_size=16).digest())
                else:
                    packed.append(None)
                    digests.append(None)
            yield pa.record_batch([pa.array(np.arange(row, row + size)), batch.column("vec_id"), labels, pa.array(packed, pa.binary()), pa.array(digests, pa.binary())],
                                  names=["row_id", "vec_id", "label", "vector", "digest"])
            row += size

    return run


def _matrix(column, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column]).astype(np.float64)


def _listed(kind: str, filters: int, cosine: float, with_vectors: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                code = codes.setdefault(length, Code(length, filters))
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                for low in range(0, part.num_rows, 1024):
                    some = part.slice(low, 1024)
                    x = _matrix(some.column("vector"), kind)
                    x /= np.abs(x).max(1, keepdims=True)
                    row, chosen, is_best, best = code.decode(x / np.linalg.norm(x, axis=1, keepdims=True), cosine)
                    out = some.take(pa.array(row))
                    arrays = {"label": out.column("label"), "length": out.column("length"), "filter": pa.array(chosen)}
                    if with_vectors:
                        arrays |= {"vertex": out.column("vertex"), "weight": out.column("weight"), "is_best": pa.array(is_best), "best": pa.array(best[row]), "vector": out.column("vector")}
                    yield pa.record_batch(arrays)

    return run


def _linked(kind: str, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["label", "length", "filter", "i", "j"]):
            if len(cell) < 2:
                continue
            ids, weight, best, is_best, block = (cell.column(c).to_numpy() for c in ("vertex", "weight", "best", "is_best", "block"))
            order = np.argsort(ids)
            ids, weight, best, is_best, block = ids[order], weight[order], best[order], is_best[order], block[order]
            x = _matrix(cell.column("vector"), kind)[order]
            # scaled first, so that neither huge nor tiny numbers leave the range of doubles
            x /= np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
            links, ends = np.zeros(len(ids), np.int64), []
            for one, other in {(i, j), (j, i)}:
                probes, listed = np.flatnonzero((block == one) & is_best), np.flatnonzero(block == other)
                for low in range(0, len(probes), ROWS):
                    p = probes[low : low + ROWS]
                    # each pair in the filter of the one with the larger inner product, by id where they tie
                    larger = (best[p][:, None] > best[listed][None, :]) | ((best[p][:, None] == best[listed][None, :]) & (p[:, None] > listed[None, :]))
                    near = (x[p] @ x[listed].T >= cosine) & larger
                    links[p] += near @ weight[listed]
                    links[listed] += weight[p] @ near
                    a, b = np.nonzero(near)
                    ends.append((p[a], listed[b]))
            if links.any():
                root = smallest_reached(len(ids), *[np.concatenate(e) for e in zip(*ends, strict=True)])
                got = np.flatnonzero(links)
                yield pa.record_batch({"vertex": pa.array(ids[got]), "links": pa.array(links[got]), "root": pa.array(ids[root[got]])})

    return run


def linked_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Groups of vectors of the same label that links of a cosine of `cosine` or more join.

    vectors: vec_id long, embedding array of float or double, label integer; other columns are ignored. One row per row:
    vec_id, n_links (other rows linked directly, copies one by one), component_id (smallest vec_id reached, nulls aside),
    kept (vec_id is component_id). A row links with nothing if its label is null or its vector is null, empty, zero or
    holds null or non-finite numbers; vectors of different lengths are not linked. Equal vectors of a label are linked. Rows
    that share a vec_id are rows of their own. An empty table gives no rows.
    """
    place = folder(vectors.sparkSession)
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    if kind == "<f8":
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = stored(rows.mapInArrow(_prepared(kind), "row_id long, vec_id long, label long, vector binary, digest binary"), f"{place}/rows")
    classes = rows.where(F.col("vector").isNotNull()).groupBy("digest").agg(
        F.min("row_id").alias("vertex"), F.count("*").alias("weight"), F.min("vec_id").alias("low"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("length", (F.length("vector") / int(kind[-1])).cast("int")), f"{place}/classes")
    filters = max(LEAST_FILTERS, classes.count() // PER_FILTER)
    usable = classes.select("vertex", "weight", "label", "length", "vector")
    key = "label long, length int, filter long"
    sizes = usable.mapInArrow(_listed(kind, filters, cosine, False), key).groupBy("label", "length", "filter").agg(F.count("*").alias("size"))
    large = stored(sizes.where(F.col("size") > BLOCK).select("label", "length", "filter", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks")), f"{place}/large")
    listed = usable.mapInArrow(_listed(kind, filters, cosine, True), f"{key}, vertex long, weight long, is_best boolean, best double, vector binary")
    listed = listed.join(large, ["label", "length", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    linked = stored(block_pairs(listed, "label", "length", "filter").mapInArrow(_linked(kind, cosine), "vertex long, links long, root long"), f"{place}/linked")
    forest = components(linked.select(F.col("root").alias("a"), F.col("vertex").alias("b")))
    links = linked.groupBy("vertex").agg(F.sum("links").alias("links"))
    found = (
        classes.select("vertex", "digest", "weight", "low").join(links, "vertex", "left").join(forest.withColumnRenamed("id", "vertex"), "vertex", "left")
        .select("digest", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "vertex").alias("root"))
    )
    least = found.groupBy("root").agg(F.min("low").alias("component_id"))
    found = found.join(least, "root").select("digest", "n_links", "component_id")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "digest").join(found, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
