"""Hard negatives by a vertical scan of vectors, dimension by dimension, with bounds that shrink the candidates.

Vectors are quantised to whole numbers, so inner products are exact. Rows lie in blocks as columns, one array per dimension, each with
its least and largest value. For an anchor the dimensions are read in falling order of the anchor's magnitude, a few at a time; what
a candidate has gathered so far, plus the least and the most that the dimensions still unread can add, bounds its product.
Candidates whose bounds cannot reach the result leave the bitmap, and those left at the end have their exact product. Two scans
do it: the best rows of an anchor's own label give windows of scores, then rows of other labels are kept only as long
as their bounds meet a window and could be among its first. Each anchor meets each block in one task; the best of a block are few,
so what is merged over blocks is small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.shared import folder, runs, stored

#: Bytes of the vectors of a block of rows and of a block of anchors; each block of the one meets each of the other.
ROW_BYTES, ANCHOR_BYTES = 1 << 20, 1 << 20
#: Partitions per cell, so that few cells hardly share one, and partitions beyond which cells share them.
SPREAD, MOST_PARTITIONS = 4, 20_000
#: Dimensions read between two looks at the bounds.
STEP = 16
#: Factor of the quantisation, and the largest magnitude that is stored in two bytes.
SCALE, NARROW = 256, (1 << 15) - 1
#: What a score is held at where it is larger, either way, and what stands for a null vec_id in ties.
MOST = (1 << 63) - 1

_ROW = "row_id long, vec_id long, label long, length int, wide boolean, vector binary"
_FOUND = "anchor_row long, anchor_id long, row_id long, vec_id long, score long"


def quantised(x: float) -> int:
    """floor(SCALE * x) of a finite double, exactly."""
    whole = x * SCALE
    return math.floor(whole) if math.isfinite(whole) else int(x) * SCALE


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows with their vectors as two-byte whole numbers, or, where those do not fit, as the doubles they came as (`wide`)."""
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        kept, lengths, wide, packed = [], [], [], []
        for i, (label, x) in enumerate(zip(batch.column("label"), batch.column("embedding"), strict=True)):
            if not label.is_valid or not x.is_valid or x.values.null_count:
                continue
            v = np.asarray(x.values.to_numpy(zero_copy_only=False), dtype=np.float64)
            if not np.isfinite(v).all():
                continue
            with np.errstate(over="ignore"):
                whole = np.floor(v * SCALE)
            fits = bool((np.abs(whole) <= NARROW).all())
            kept.append(i)
            lengths.append(len(v))
            wide.append(not fits)
            packed.append((whole.astype("<i2") if fits else v.astype("<f8")).tobytes())
        some = batch.take(pa.array(kept, pa.int64()))
        yield pa.record_batch(
            [pa.array(np.array(kept, np.int64) + row), some.column("vec_id"), some.column("label"), pa.array(lengths, pa.int32()), pa.array(wide, pa.bool_()), pa.array(packed, pa.binary())],
            names=["row_id", "vec_id", "label", "length", "wide", "vector"],
        )
        row += batch.num_rows


class Columns:
    """A block of rows, one array per dimension, with the least and largest value of each."""

    def __init__(self, table: pa.Table, length: int):
        self.rows = table.column("row_id").to_numpy()
        self.ids = table.column("vec_id").combine_chunks().fill_null(MOST).to_numpy()
        self.labels = table.column("label").to_numpy()
        self.wide = bool(len(table) and table.column("wide")[0].as_py())
        vectors = table.column("vector")
        if self.wide:
            every = [[quantised(x) for x in np.frombuffer(v.as_buffer(), "<f8").tolist()] for v in vectors]
            self.values = np.array(every, dtype=object).reshape(len(table), length).T
        else:
            # whole numbers below 2^15, so sums of fewer than 2^23 products are exact in doubles
            joined = b"".join(v.as_py() for v in vectors)
            self.values = np.ascontiguousarray(np.frombuffer(joined, "<i2").reshape(len(table), length).T.astype(np.float64))
        self.low, self.high = self.values.min(1), self.values.max(1)
        self._whole = None

    def whole(self) -> np.ndarray:
        """The values as Python's whole numbers, whose products have no limit."""
        if self._whole is None:
            self._whole = self.values if self.wide else self.values.astype(np.int64).astype(object)
        return self._whole


class Bounds:
    """The rows of a block that are still candidates for an anchor, with the bounds of their products."""

    def __init__(self, block: Columns, anchor: np.ndarray, anchor_wide: bool, at: np.ndarray):
        self.at = at  # positions of the bits that are still set
        exact = anchor_wide or block.wide or len(anchor) >= 1 << 23
        self.values = block.whole() if exact else block.values
        self.anchor = np.array([int(a) for a in anchor], dtype=object) if exact else anchor.astype(np.float64)
        self.order = np.array(sorted(range(len(anchor)), key=lambda d: -abs(self.anchor[d])), np.int64)
        kind = self.values.dtype
        low, high = (np.array([int(x) for x in ends], object) if exact else ends for ends in (block.low, block.high))
        least, most = np.minimum(self.anchor * low, self.anchor * high), np.maximum(self.anchor * low, self.anchor * high)
        # what the dimensions from a place of the order on can add
        self.rest = np.zeros((2, len(anchor) + 1), kind)
        for side, ends in enumerate((least, most)):
            self.rest[side, : len(anchor)] = np.cumsum(ends[self.order][::-1])[::-1]
        self.read = 0
        self.gathered = np.zeros(len(at), kind)

    @property
    def low(self) -> np.ndarray:
        return self.gathered + self.rest[0, self.read]

    @property
    def high(self) -> np.ndarray:
        return self.gathered + self.rest[1, self.read]

    def step(self) -> bool:
        """Reads the next dimensions; false when all have been read."""
        some = self.order[self.read : self.read + STEP]
        if not len(some):
            return False
        if len(self.at):
            picked = self.values[some] if len(self.at) == self.values.shape[1] else self.values[np.ix_(some, self.at)]
            self.gathered = self.gathered + self.anchor[some] @ picked
        self.read += len(some)
        return True

    def keep(self, wanted: np.ndarray) -> None:
        if not wanted.all():
            self.at, self.gathered = self.at[wanted], self.gathered[wanted]

    def scores(self) -> np.ndarray:
        """Exact products, held at the ends of what a long can say."""
        if self.gathered.dtype == object:
            return np.array([min(max(int(x), -MOST), MOST) for x in self.gathered], np.int64)
        return self.gathered.astype(np.int64)


def _kth_largest(x: np.ndarray, k: int):
    """None if there are fewer than k."""
    if len(x) < k:
        return None
    return np.sort(x)[-k] if x.dtype == object else np.partition(x, len(x) - k)[len(x) - k]


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: larger scores, then smaller ids, then rows."""
    return np.lexsort((rows, ids, -scores))[:k]


def best_of_label(block: Columns, anchor: np.ndarray, wide: bool, row: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the k best other rows of the anchor's label."""
    bounds = Bounds(block, anchor, wide, np.flatnonzero((block.labels == label) & (block.rows != row)))
    while bounds.step():
        least = _kth_largest(bounds.low, k)
        if least is not None:
            bounds.keep(bounds.high >= least)
    scores = bounds.scores()
    first = _first(scores, block.ids[bounds.at], block.rows[bounds.at], k)
    return bounds.at[first], scores[first]


def best_in_windows(block: Columns, anchor: np.ndarray, wide: bool, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores (least, most), both inside: (positions, scores) of the k best rows of other labels in it."""
    bounds = Bounds(block, anchor, wide, np.flatnonzero(block.labels != label))
    distinct = list(dict.fromkeys(windows))
    while bounds.step():
        low, high = bounds.low, bounds.high
        wanted = np.zeros(len(low), dtype=bool)
        for least, most in distinct:
            may = (high >= least) & (low <= most)
            # k rows that are in the window for certain say what it takes to be among its first
            floor = _kth_largest(low[may & (low >= least) & (high <= most)], k)
            wanted |= may if floor is None else may & (high >= floor)
        bounds.keep(wanted)
    scores, ids, rows = bounds.scores(), block.ids[bounds.at], block.rows[bounds.at]
    out = []
    for least, most in windows:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        first = inside[_first(scores[inside], ids[inside], rows[inside], k)]
        out.append((bounds.at[first], scores[first]))
    return out


def _anchors_of(table: pa.Table) -> Iterator[tuple[int, np.ndarray, bool]]:
    for i in range(len(table)):
        wide, vector = table.column("wide")[i].as_py(), table.column("vector")[i].as_buffer()
        yield i, np.array([quantised(x) for x in np.frombuffer(vector, "<f8").tolist()], object) if wide else np.frombuffer(vector, "<i2").astype(np.int64), wide


_CELL = ["length", "a_block", "wide_rows", "r_block"]


def _scanned(search):
    """Runs `search` (anchor row of a table, vector, wide, block) -> rows for each anchor and block of a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, _CELL):
            is_anchor = cell.column("is_anchor").to_numpy()
            anchors, rows = cell.filter(pa.array(is_anchor)), cell.filter(pa.array(~is_anchor))
            if not len(anchors) or not len(rows):
                continue
            block = Columns(rows, cell.column("length")[0].as_py())
            ids = rows.column("vec_id").combine_chunks()
            for i, vector, wide in _anchors_of(anchors):
                anchor = anchors.slice(i, 1).to_pylist()[0]
                yield from search(anchor, vector, wide, block, ids)

    return run


def _same_label(k: int):
    def search(anchor: dict, vector: np.ndarray, wide: bool, block: Columns, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        at, scores = best_of_label(block, vector, wide, anchor["row_id"], anchor["label"], k)
        n = len(at)
        if n:
            yield pa.record_batch({"anchor_row": pa.array([anchor["row_id"]] * n, pa.int64()), "anchor_id": pa.array([anchor["vec_id"]] * n, pa.int64()),
                                   "row_id": pa.array(block.rows[at]), "vec_id": ids.take(pa.array(at)), "score": pa.array(scores)})

    return _scanned(search)


def window(positive_score: int, least: int, most: int) -> tuple[int, int]:
    """Scores s with least * p <= 100 * s <= most * p; empty ones have the first above the second."""
    return -(-least * positive_score // 100), most * positive_score // 100


def _other_labels(k: int, least: int, most: int):
    def search(anchor: dict, vector: np.ndarray, wide: bool, block: Columns, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        positives = anchor["positives"]
        found = best_in_windows(block, vector, wide, anchor["label"], [window(p["score"], least, most) for p in positives], k)
        for p, (at, scores) in zip(positives, found, strict=True):
            n = len(at)
            if n:
                yield pa.record_batch({
                    "anchor_row": pa.array([anchor["row_id"]] * n, pa.int64()), "anchor_id": pa.array([anchor["vec_id"]] * n, pa.int64()),
                    "positive_row": pa.array([p["row_id"]] * n, pa.int64()), "positive_id": pa.array([p["vec_id"]] * n, pa.int64()),
                    "positive_score": pa.array([p["score"]] * n, pa.int64()), "row_id": pa.array(block.rows[at]),
                    "negative_id": ids.take(pa.array(at)), "negative_score": pa.array(scores),
                })

    return _scanned(search)


def _cells(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Every block of anchors beside every block of rows of the same length, sorted by cell within partitions.

    Blocks have about ROW_BYTES and ANCHOR_BYTES of vectors. Wide rows lie in blocks of their own.
    """
    size = F.sum(F.length("vector"))
    r_sizes = rows.groupBy("length", "wide").agg(F.greatest(F.ceil(size / ROW_BYTES), F.lit(1)).cast("int").alias("r_blocks"))
    a_sizes = anchors.groupBy("length").agg(F.greatest(F.ceil(size / ANCHOR_BYTES), F.lit(1)).cast("int").alias("a_blocks"))
    sizes = r_sizes.join(a_sizes, "length")
    cells = sizes.agg(F.sum(F.col("r_blocks").cast("long") * F.col("a_blocks"))).first()[0] or 1
    block = F.xxhash64("row_id")
    r = rows.join(sizes, ["length", "wide"]).withColumn("wide_rows", F.col("wide").cast("int"))
    r = r.withColumn("r_block", F.pmod(block, "r_blocks").cast("int")).withColumn("a_block", F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)))
    a = anchors.join(sizes.withColumn("wide_rows", F.col("wide").cast("int")).drop("wide"), "length").withColumn("a_block", F.pmod(block, "a_blocks").cast("int"))
    a = a.withColumn("r_block", F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)))
    both = a.withColumn("is_anchor", F.lit(True)).unionByName(r.withColumn("is_anchor", F.lit(False)), allowMissingColumns=True)
    # a given count, since cells are small to send but dear to scan
    return both.drop("a_blocks", "r_blocks").repartition(min(SPREAD * cells, MOST_PARTITIONS), *_CELL).sortWithinPartitions(*_CELL)


def _ranked(df: DataFrame, keys: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    """The k best per key. A block gives k rows at most, and Spark drops what is beyond k before the shuffle."""
    best = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(vec_id).asc_nulls_last(), "row_id")
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels in a window of scores.

    vectors: vec_id integer, label integer, embedding array of float or double; other columns are ignored. `anchors` says over vec_id
    which rows are anchors. Rows with a null label, a null vector or a null or non-finite component take no part; a row with an
    empty or zero vector does, its products are 0. Scores are inner products of floor(256 * x), exact, held at 2^63 - 1 either way. An
    anchor's positives are its first `positives` other rows of its label, by falling score and vec_id, then place in the input; for
    each, the first `negatives` rows of other labels with least * positive score <= 100 * score <= most * positive score. One row
    each: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Vectors of different lengths do not
    meet. Rows that share a vec_id are rows of their own, also as anchors; a null vec_id is no anchor unless `anchors` says so and comes
    last in ties. An empty table, or one without anchors, gives no rows.
    """
    place = folder(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = stored(rows.mapInArrow(_prepared, _ROW), f"{place}/rows")
    chosen = rows.where(anchors)
    found = _cells(chosen, rows).mapInArrow(_same_label(positives), _FOUND)
    best = _ranked(found, ["anchor_row"], "score", "vec_id", positives)
    # as many as positives are asked for, so a list per anchor is short
    listed = best.groupBy("anchor_row").agg(F.collect_list(F.struct("row_id", "vec_id", "score")).alias("positives"))
    asked = stored(chosen.join(listed, F.col("row_id") == F.col("anchor_row")).drop("anchor_row"), f"{place}/asked")
    kept = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row_id long, negative_id long, negative_score long"
    found = _cells(asked, rows).mapInArrow(_other_labels(negatives, least, most), kept)
    best = _ranked(found, ["anchor_row", "positive_row"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
