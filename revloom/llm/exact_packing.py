"""Packing of documents into as few sequences as possible, by combinations of lengths that fill a gap exactly.

Only a document longer than a sequence is cut, so what is to be packed is known by its length alone, and there are no more lengths than
tokens in a sequence. Tasks tokenize documents, number their pieces by length and store them; the number of pieces of each length, a
table bounded by the capacity, is planned on the driver. The plan fills sequences from the longest piece on: an index
of single lengths, sums of two and sums of three tells which combination of pieces that are still there fills the gap without
rest; where none does, the longest piece that fits goes in and the smaller gap is looked up again. A filling found once is repeated
as often as its lengths are there, so the plan grows with the capacity, not with the documents. Each piece then finds its
sequence from its length and its number among all pieces of that length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.packing import Encoder
from revloom.llm.shared import folder, stored

#: Rows' bytes of ids sent at a time.
SENT_BYTES = 1 << 22

_PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, doc_tokens long, part int, nth long"
#: Bits of a piece's number among those of its length.
_NUMBER = 44


class Sums:
    """Which one, two or three of the lengths at hand add up to a gap.

    Of two and of three the most even ones come first, so that the shortest pieces, which fit everywhere, are left for the end. Pieces are
    only ever taken, so a sum that is gone stays gone: for each sum of two and of three the index remembers how far its longest
    length has been looked through, from an even share upwards, and goes on from there.
    """

    def __init__(self, counts: list[int]):
        self.left = counts
        self.two = [-(-total // 2) for total in range(len(counts))]
        self.three = [-(-total // 3) for total in range(len(counts))]

    def have(self, *lengths: int) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def pair(self, total: int) -> tuple[int, int] | None:
        x = self.two[total]
        while x < total and not self.have(x, total - x):
            x += 1
        self.two[total] = x
        return (x, total - x) if x < total else None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        x = self.three[total]
        while x < total - 1 and not (self.left[x] and self.pair(total - x)):
            x += 1  # neither this length nor its pairs come back
        self.three[total] = x
        for x in range(x, total - 1):
            if self.left[x] and self.pair(total - x):
                # the first pair may need a piece that x takes; then look through the others
                for y in range(self.two[total - x], total - x):
                    if self.have(x, y, total - x - y):
                        return x, y, total - x - y
        return None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """Lengths that fill the gap exactly: one, else two, else three."""
        if self.left[gap]:
            return (gap,)
        return (self.pair(gap) if gap > 1 else None) or (self.triple(gap) if gap > 2 else None)


def planned(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how often, lengths in a sequence in order) that use up `counts` pieces of each length."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    sums, plan = Sums(left), []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            held, gap = [longest], capacity - longest
            left[longest] -= 1
            while gap:
                more = sums.filling(gap)
                if more is None:
                    # best fit: the longest piece that leaves room
                    fits = next((x for x in range(min(gap, longest), 0, -1) if left[x]), None)
                    more = () if fits is None else (fits,)
                for x in more:
                    left[x] -= 1
                held += more
                gap -= sum(more)
                if not more:
                    break
            again = min(left[x] // n for x, n in Counter(held).items())
            for x in held:
                left[x] -= again
            plan.append((again + 1, held))
    return plan


class Places:
    """Where a piece goes, by its length and its number among the pieces of that length."""

    def __init__(self, plan: list[tuple[int, list[int]]]):
        used, sequence, rows = Counter(), 0, []
        for times, held in plan:
            offset = 0
            for length, copies in sorted(Counter(held).items(), reverse=True):
                rows.append((length, used[length], sequence, copies, offset))
                used[length] += times * copies
                offset += copies * length
            sequence += times
        rows.sort()
        self.sequences = sequence
        length, first, self.sequence, self.copies, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.first, self.keys = first, (length << _NUMBER) + first

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        at = np.searchsorted(self.keys, (length << _NUMBER) + number, side="right") - 1
        beyond = number - self.first[at]
        return self.sequence[at] + beyond // self.copies[at], self.offset[at] + beyond % self.copies[at] * length


_ENCODERS: dict[str, Encoder] = {}


def _cut(path: str, capacity: int, end_id: int):
    """Documents to numbered pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS[path] if path in _ENCODERS else _ENCODERS.setdefault(path, Encoder(path))
        part, numbers, end = TaskContext.get().partitionId(), [0] * (capacity + 1), np.array([end_id], dtype="<u4")
        rows: list[tuple] = []
        held = 0

        def sent() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens", "part", "nth"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.concatenate([encoder.ids(text.as_py() or ""), end])
                begins = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
                for piece, (a, b) in enumerate(zip(begins, [*begins[1:], len(ids)], strict=True)):
                    raw = ids[a:b].tobytes()
                    rows.append((doc_id, piece, a, b - a, raw, zlib.crc32(raw), len(ids), part, numbers[b - a]))
                    numbers[b - a] += 1
                    held += len(raw)
                    if held >= SENT_BYTES:
                        yield sent()
                        rows, held = [], 0
        if rows:
            yield sent()

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of documents in as few sequences as the plan manages, each of at most `capacity` tokens.

    docs: doc_id integer, text string; other columns are ignored. `tokenizer` is the path of a byte-level BPE file that every machine
    has; strings of special tokens in a text are ordinary text. A document is the ids of its text, then `end_id`. One longer than
    `capacity` is cut into pieces of that length, its first piece may be shorter; others are one piece. One row per piece:
    doc_id, piece (from 0), start (ids of the document before it), length, ids (binary, little-endian unsigned 32 bit), ids_crc32 (of
    those bytes, unsigned), doc_tokens (ids of the document), sequence_id (from 0 without gaps), offset (in the sequence, from 0
    without gaps). A null or empty text is the end id alone; a null doc_id stays null; repeated rows are packed as often as they come;
    an empty table gives no rows. Tokens are stored once; a reader that leaves `ids` out does not move them again.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark, place = docs.sparkSession, folder(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(texts.mapInArrow(_cut(tokenizer, capacity, end_id), _PIECES), f"{place}/pieces")
    held = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), f"{place}/held")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row per length
    sent = spark.sparkContext.broadcast(Places(planned(counts, capacity)))  # grows with the capacity alone

    @F.arrow_udf("sequence_id long, offset long")
    def placed(length: pa.Array, number: pa.Array) -> pa.Array:
        sequence, offset = sent.value.find(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    firsts = held.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    found = pieces.join(firsts, ["part", "length"]).withColumn("at", placed("length", F.col("first") + F.col("nth")))
    return found.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")
