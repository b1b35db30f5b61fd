"""A quality score for texts, learned from pairs of a better and a worse document.

Bradley-Terry: the chance that document i is preferred to j is the logistic function of w (x_i - x_j), with features x of
the text alone. The weights w come from pairs of labelled rows by Newton steps on the logistic loss. A score w x is held
against a quantile of the labelled rows' scores: the one that leaves below it as many as are labelled bad.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.llm.hashing import PIECE_BYTES, pieces, word_hashes
from revloom.llm.shared import own_name

#: Labelled rows that a model is fitted on, at most: the ones with the smallest hash of doc_id.
SAMPLE_ROWS = 20_000
#: Preference pairs drawn from the sample.
PAIRS = 200_000
RIDGE, STEPS, SEED = 1e-3, 30, 7
#: The score that stands for the threshold.
AT_THRESHOLD = 0.3

_SYMBOLS = b"#$%&*+=<>@^_~\\/{}[]"
FEATURES = (
    "upper", "digit", "space", "newline", "exclamation", "bar", "symbol", "stop", "comma", "other", "beyond_ascii",
    "words_end_in_symbol", "shouted_words", "word_bytes", "words", "distinct", "repeated", "repeated_at_two", "largest_share", "sentence_words",
)


def _classes() -> np.ndarray:
    kind = np.full(256, 9, dtype=np.int64)  # other
    for codes, k in ((range(65, 91), 0), (range(48, 58), 1), (b" ", 2), (b"\n", 3), (b"!", 4), (b"|", 5), (_SYMBOLS, 6), (b".", 7), (b",", 8), (range(97, 123), 11)):
        kind[list(codes)] = k
    kind[128:] = 10
    return kind


_KIND = _classes()


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[starts[1:]] - sums[starts[:-1]]).astype(np.float64)


def _piece_features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = len(starts) - 1
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    kind = _KIND[data]
    size = np.maximum(np.diff(starts), 1).astype(np.float64)
    for k in range(11):
        out[:, k] = np.sqrt(_per_text(kind == k, starts) / size)
    hashes, first = word_hashes(data, starts)
    words = np.maximum(np.diff(first), 1).astype(np.float64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.ones(len(data), dtype=bool)
    last[:-1] = space[1:]
    last &= ~space
    # where a text ends without a space its last byte ends a word
    last[starts[1:][starts[1:] > starts[:-1]] - 1] = ~space[starts[1:][starts[1:] > starts[:-1]] - 1]
    out[:, 11] = _per_text(last & ((kind == 6) | (kind == 4)), starts) / words
    shouted = np.zeros(len(data), dtype=bool)
    shouted[1:] = (kind[1:] == 0) & (kind[:-1] == 0)
    shouted[starts[:-1][starts[:-1] < len(data)]] = False  # what stands before is another text
    out[:, 12] = _per_text(shouted, starts) / size
    out[:, 13] = np.log1p(_per_text(~space, starts) / words)
    out[:, 14] = np.log1p(words)
    same = np.zeros((2, len(hashes)), dtype=bool)
    for gap in (1, 2):
        same[gap - 1, gap:] = hashes[gap:] == hashes[:-gap]
        for behind in range(gap):
            early = first[:-1] + behind
            same[gap - 1, early[early < len(hashes)]] = False
    for k, row in zip((16, 17), same, strict=True):
        out[:, k] = _per_text(row, first) / words if len(hashes) else 0
    for i in range(n):
        own = hashes[first[i] : first[i + 1]]
        if len(own):
            _, counts = np.unique(own, return_counts=True)
            out[i, 15] = np.log1p(len(counts)) / np.log1p(len(own))
            out[i, 18] = counts.max() / (len(own) + 4)
    out[:, 19] = np.log1p(words / (1 + _per_text(kind == 7, starts)))
    out[starts[1:] == starts[:-1]] = 0
    return out


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES per text, over the whole of it; zeros for a null or empty one."""
    if not len(texts):
        return np.zeros((0, len(FEATURES)))
    return np.concatenate([_piece_features(data, starts) for _, data, starts in pieces(texts, PIECE_BYTES)])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Model:
    """Weights for scaled features, and the threshold that the score AT_THRESHOLD stands for."""

    def __init__(self, mean, scale, weights, threshold):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.raw(x) - self.threshold + math.log(AT_THRESHOLD / (1 - AT_THRESHOLD)))


def fit(x: np.ndarray, good: np.ndarray) -> Model:
    """Weights by Newton steps over preference pairs; the threshold is the quantile at the share of bad rows.

    Without rows of either kind nothing is preferred: every text scores 0.5.
    """
    d = x.shape[1]
    mean, scale = (x.mean(0), np.maximum(x.std(0), 1e-6)) if len(x) else (np.zeros(d), np.ones(d))
    model = Model(mean, scale, np.zeros(d), math.log(AT_THRESHOLD / (1 - AT_THRESHOLD)))
    if good.all() or not good.any():
        return model
    z = np.clip((x - mean) / scale, -6, 6)
    draw = np.random.default_rng(SEED)
    difference = z[draw.choice(np.flatnonzero(good), PAIRS)] - z[draw.choice(np.flatnonzero(~good), PAIRS)]
    w = np.zeros(d)
    for _ in range(STEPS):
        p = _logistic(difference @ w)
        gradient = difference.T @ (1 - p) / PAIRS - RIDGE * w
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / PAIRS + RIDGE * np.eye(d)
        step = np.linalg.solve(curvature, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    model.threshold = float(np.quantile(z @ w, float((~good).mean()), method="midpoint"))
    return model


def held_out(doc_id: Column) -> Column:
    """True for documents that a model must not learn from: crc32 of the id as text is a multiple of 5, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents that are not held out.

    labels: doc_id, quality (1 good, 0 bad; others and null are ignored, as are documents labelled both ways). The
    driver gets the features of SAMPLE_ROWS rows at most.
    """
    told = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    told = told.where("lo = hi").select(F.col("doc_id").alias("id"), F.col("hi").alias("good"), F.md5(F.col("doc_id").cast("string")).alias("at"))
    told = told.orderBy("at", "id").limit(SAMPLE_ROWS)  # so few rows that they can be sent to all
    rows = docs.select("doc_id", "text").join(F.broadcast(told), F.col("doc_id") == F.col("id")).select("at", "id", "good", "text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = features(batch.column(3))
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), lists], names=["at", "id", "good", "x"])

    found = rows.select("at", "id", F.col("good").cast("int").alias("good"), "text").mapInArrow(run, "at string, id long, good int, x array<double>")
    found = found.orderBy("at", "id", "x").limit(SAMPLE_ROWS).collect()  # repeated rows cannot make it more
    x = np.array([r["x"] for r in found]).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["good"] == 1 for r in found], dtype=bool))


def scorer(model: Model):
    """A column function text -> score between 0 and 1; AT_THRESHOLD stands for the threshold."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(features(text)), pa.float64())

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with held_out, score (0 to 1, higher for better) and predicted (1 where score >= AT_THRESHOLD, else 0).

    docs: doc_id, text and any other columns, kept; where one has the name of an output, the output gets an underscore behind
    it. Every row is scored from its whole text; a null text as an empty one.
    Repeated rows score alike. Without labels of both kinds every score is 0.5. An empty table gives no rows.
    """
    score = scorer(learned(docs, labels))
    names = [own_name(n, docs.columns) for n in ("held_out", "score", "predicted")]
    out = docs.withColumn(names[0], held_out(F.col("doc_id"))).withColumn(names[1], score(F.col("text")))
    return out.withColumn(names[2], F.when(F.col(names[1]) >= AT_THRESHOLD, 1).otherwise(0))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted good, with all their columns as they are."""
    good = scored(docs, labels).where(F.col(own_name("predicted", docs.columns)) == 1)
    return good.select(*[F.col(f"`{c}`") for c in docs.columns])
