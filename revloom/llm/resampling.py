"""Selection of documents that look like a target set, by importance resampling over hashed words and word pairs.

An untrained splitter of the tokenizers library finds the words of the lowered text with their offsets. Each window of one or two
consecutive offset pairs is a feature, its words joined by one space, and the CRC-32 of its bytes says which bucket it counts in.
Bucket counts of all documents and of the target texts give each bucket a gain; a document's weight is the mean gain of its
features, and weights plus seeded Gumbel noise make the draw of the highest scores one without replacement. Texts are split once: what is
kept of a document is its own bucket counts, which are bounded by the number of buckets. Only sums over buckets reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import folder, stored
from revloom.operators import scan

#: What parts words of lowered text: runs of ASCII characters that are neither letters nor digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, WIDEST, SEED = 10_000, 2, 7
#: Least words of a document that may be drawn, and how many percent of those are.
LEAST_WORDS, PERCENT = 20, 25
#: Bytes of lowered text split at a time, and documents sent at a time.
CHUNK_BYTES, SENT_ROWS = 1 << 16, 2048

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_COUNTED = "row_id long, doc_id long, n_words long, n_features long, buckets binary, counts binary"


def splitter():
    """A pre-tokenizer that gives the words of lowered text with their offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(BETWEEN), "removed")


def chunks(lowered: bytes, most: int = CHUNK_BYTES) -> Iterator[str]:
    """The text in pieces of about `most` bytes, cut where no word is."""
    at = 0
    while at < len(lowered):
        end = at + most
        while end < len(lowered):
            between = np.flatnonzero(~_LETTER[np.frombuffer(lowered, np.uint8, min(most, len(lowered) - end), end)])
            if len(between):
                end += int(between[0])
                break
            end += most
        yield lowered[at:end].decode()
        at = end


def windows(text: str | None, split, widest: int = WIDEST) -> Iterator[tuple[int, Iterator[tuple[int, int]], list[int]]]:
    """All windows of 1 to `widest` consecutive words of the whole text, in lots: (words in a window, their offset pairs, their CRC-32).

    An offset pair is the first one's start and the last one's end, in characters of the text. A window's CRC is that of its words
    joined by one space, whatever lies between them.
    """
    base, raws, spans = 0, [], []  # the last words of the piece before stay, for windows that end in this one
    for piece in chunks((text or "").encode().lower()):
        old = len(raws)
        found = split.pre_tokenize_str(piece)
        raws += [word.encode() for word, _ in found]
        spans += [(base, offsets) for _, offsets in found]
        crcs = list(map(zlib.crc32, raws))
        for width in range(1, widest + 1):
            new = max(0, old - width + 1)
            pairs = ((a + first[0], b + last[1]) for (a, first), (b, last) in zip(spans[new:], spans[new + width - 1 :], strict=False))
            yield width, pairs, crcs[new:]
            crcs = list(map(zlib.crc32, raws[width:], map(zlib.crc32, repeat(b" "), crcs)))
        kept = len(raws) - min(len(raws), widest - 1)
        base, raws, spans = base + len(piece), raws[kept:], spans[kept:]


def bucket_counts(text: str | None, split, buckets: int, widest: int) -> tuple[int, int, bytes, bytes]:
    """(words, features, buckets that have some, how many each), the last two as little-endian unsigned 32 bit numbers."""
    words, found, spots, counts = 0, [], np.empty(0, np.int64), np.empty(0, np.int64)
    for width, _, crcs in windows(text, split, widest):
        words += len(crcs) if width == 1 else 0
        found += crcs
        if len(found) > CHUNK_BYTES:
            spots, counts = _merged(spots, counts, found, buckets)
            found = []
    spots, counts = _merged(spots, counts, found, buckets)
    return words, int(counts.sum()), spots.astype("<u4").tobytes(), counts.astype("<u4").tobytes()


def _merged(spots: np.ndarray, counts: np.ndarray, crcs: list[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    more, many = np.unique(np.array(crcs, np.int64) % buckets, return_counts=True)
    if not len(spots):
        return more, many
    every, at = np.unique(np.concatenate([spots, more]), return_inverse=True)
    return every, np.bincount(at, np.concatenate([counts, many])).astype(np.int64)


def _counted(buckets: int, widest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, row = splitter(), TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, SENT_ROWS):
                some = batch.slice(low, SENT_ROWS)
                out = [bucket_counts(text.as_py(), split, buckets, widest) for text in some.column("text")]
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                rest = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
                ids = pa.array(np.arange(row, row + len(out)))
                yield pa.record_batch([ids, some.column("doc_id"), *rest], names=["row_id", "doc_id", "n_words", "n_features", "buckets", "counts"])
                row += len(out)

    return run


def counted(texts: DataFrame, buckets: int = BUCKETS, widest: int = WIDEST) -> DataFrame:
    """doc_id, text to one row per text with its number of words and features and its own bucket counts."""
    return texts.mapInArrow(_counted(buckets, widest), _COUNTED)


def _summed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for spots, counts in zip(batch.column("buckets"), batch.column("counts"), strict=True):
                total[np.frombuffer(spots.as_buffer(), "<u4")] += np.frombuffer(counts.as_buffer(), "<u4")
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at), "n": pa.array(total[at])})

    return run


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of `counted`. A task adds up its own; the driver gets one number per bucket."""
    sums = rows.select("buckets", "counts").mapInArrow(_summed(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier each bucket is in the target, in thousandths of a natural logarithm, add-one smoothed."""
    buckets, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_raw + buckets) / ((float(s) + 1) * (all_target + buckets)))) for s, t in zip(raw, target, strict=True)], np.int64)


def _weighed(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            weights = []
            for spots, counts, n in zip(batch.column("buckets"), batch.column("counts"), batch.column("n_features").to_pylist(), strict=True):
                total = int(gain[np.frombuffer(spots.as_buffer(), "<u4")] @ np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
                weights.append(total // n if n else 0)
            kept = [batch.column(c) for c in ("row_id", "doc_id", "n_words", "n_features")]
            yield pa.record_batch([*kept, pa.array(weights, pa.int64())], names=["row_id", "doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of a document in thousandths, from a hash of the seed and its number; a null one counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, widest: int = WIDEST,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its weight and score, and the rank of those that are drawn.

    docs: doc_id integer, text string; target: text string; other columns are ignored. One row per row: doc_id, n_words, n_features
    (runs of 1 to `widest` words, repeats counted), weight (floored mean gain, 0 without features), score (weight plus noise),
    rank (from 1 by falling score, then doc_id, then place in the input; null if not drawn). Of the documents with at least
    `least_words` words floor(percent * N / 100) are drawn. A null or empty text has no words; a null doc_id stays null,
    shares its noise with other null ones and comes before other numbers in ties; rows that share a doc_id are ranked each. Without target texts
    gains compare with an even distribution; without documents there are no rows.
    """
    place = folder(docs.sparkSession)
    rows = stored(counted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), buckets, widest), f"{place}/counted")
    wanted = histogram(counted(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, widest), buckets)
    sent = docs.sparkSession.sparkContext.broadcast(gains(histogram(rows, buckets), wanted))  # one number per bucket
    kept = "row_id long, doc_id long, n_words long, n_features long, weight long"
    scored = rows.mapInArrow(_weighed(sent), kept).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored, f"{place}/scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = F.floor(able.agg(F.count(F.lit(1))).scalar() * percent / 100)
    ranked = scan.numbered(able.select("row_id", "doc_id", (-F.col("score")).alias("fall")), ["fall", "doc_id", "row_id"], "rank")
    ranked = ranked.where(F.col("rank") <= drawn).select("row_id", "rank")
    return scored.join(ranked, "row_id", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")
