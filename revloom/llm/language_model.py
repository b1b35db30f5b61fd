"""Interpolated Kneser-Ney bigram model with modified discounts, counted by Spark, for scoring texts.

Counting: a task sorts the pairs of neighbouring words that it reads, counts equal ones and sends them, packed by ranges of
the first word's hash, to the range's task, which merges them, writes the range's sorted array of pair hashes with counts
to the shared folder, and sends sums per word on by ranges of that word. Those are merged and written likewise. Pairs behind a
word that a sample of the texts shows to be frequent, and those behind the begin mark, are dealt by the hash of the pair
instead, so that no range holds all of them; the sample decides about that alone. Nothing is
pruned, so the arrays grow with the corpus. Scoring: tasks map the arrays to memory and look up the sorted, distinct pairs
and words of some texts at a time.

A text's tokens are its words and one end; its first token follows a begin mark. With c the count of a pair or word, and
a(w) the number of distinct words before w:
    p(w | v) = max(c(v w) - D(c(v w)), 0) / c(v) + g(v) p(w),      g(v) = sum of D over the pairs of v, / c(v)
    p(w)     = max(a(w) - D'(a(w)), 0) / A + g' / (V + 1),         A = sum of a, V = distinct tokens, one unknown word
D has a value for counts of 1, 2 and 3 or more, from the counts of counts of all pairs, D' likewise from those of a.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.hashing import mix, pieces, word_hashes
from revloom.llm.ngram_join import COUNT_BITS, COUNT_BUCKETS, word_counts
from revloom.llm.shared import folder, runs, starts_of, stored

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: Pairs that a task sorts at a time.
SORTED_PAIRS = 1 << 22
#: One text in so many, by hash, is looked at for frequent words: those with more than 1 / FREQUENT of a range's share of tokens.
SAMPLED, FREQUENT = 64, 2
PAIRS, CONTEXTS, FOLLOWERS, WORDS = range(4)

_PAIR_ARRAYS, _WIDE_PAIR_ARRAYS = ("<u8", "<u4"), ("<u8", "<i8")  # hash, count; the latter where a count needs it
_WORD_ARRAYS = ("<u8", "<i8", "<i8", "<i8", "<i8", "<i8", "<i8")  # hash, c, c as context, a, pairs counted 1, 2, 3 or more


def in_training(doc_id: Column) -> Column:
    """Documents that the model learns from: crc32 of the id as text leaves another remainder by 5 than 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 1, F.lit(False))


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _slices(sorted_hashes: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of each range that has some of the sorted hashes."""
    cuts = np.searchsorted(_range_of(sorted_hashes, ranges), np.arange(ranges + 1))
    for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        yield r, int(cuts[r]), int(cuts[r + 1])


def _pairs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token of the texts, ends included: the hash before it, its own, and each text's first position."""
    words, first = word_hashes(data, starts)
    texts = len(starts) - 1
    ends = first[1:] + np.arange(texts)
    tokens = np.empty(len(words) + texts, np.uint64)
    is_end = np.zeros(len(tokens), dtype=bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = END, words
    begins = first[:-1] + np.arange(texts)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begins] = BEGIN
    return before, tokens, np.append(begins, len(tokens))


def frequent_words(texts: DataFrame, ranges: int) -> np.ndarray:
    """Buckets of hashes that frequent words are in, the begin mark's among them; at most FREQUENT * ranges + 1."""
    counts = word_counts(texts.where(F.pmod(F.xxhash64(texts.columns[0]), F.lit(SAMPLED)) == 0)).astype(np.int64)
    hot = np.flatnonzero(counts * FREQUENT * ranges > max(int(counts.sum()), 1))
    return np.union1d(hot, [int(BEGIN >> np.uint64(64 - COUNT_BITS))])


class Routes:
    """Which hash says in what range a pair is: its first word's, or the pair's own where that word is frequent."""

    def __init__(self, hot: np.ndarray):
        self.hot, self._table = hot, None

    def __getstate__(self):
        return {"hot": self.hot, "_table": None}

    def spread(self, before: np.ndarray) -> np.ndarray:
        if self._table is None:
            self._table = np.zeros(COUNT_BUCKETS, dtype=bool)
            self._table[self.hot] = True
        return self._table[(before >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]

    def of(self, before: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return np.where(self.spread(before), keys, before)


def even_keys(spark: SparkSession, parts: int) -> np.ndarray:
    """For each of `parts` partitions a number that Spark's hash sends there, so that as many ranges are one to a partition."""
    tried = spark.range(parts * (8 + 2 * parts.bit_length())).select(F.col("id").cast("int").alias("key"))
    found = tried.groupBy(F.pmod(F.hash("key"), F.lit(parts)).alias("part")).agg(F.min("key").alias("key")).collect()  # a row per partition
    out = np.arange(parts, dtype=np.int32)  # a partition that none was found for: any number will do
    for r in found:
        out[r["part"]] = r["key"]
    return out


def _packed_pairs(before: np.ndarray, tokens: np.ndarray, ranges: int, routes: Routes, keys: np.ndarray) -> pa.RecordBatch:
    rows = []

    def pack(r: int, before: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> None:
        own = starts_of(before)
        sizes = np.diff(np.append(own, len(before))).astype("<u4")
        rows.append((r, before[own].tobytes(), sizes.tobytes(), tokens.tobytes(), counts.tobytes()))

    order = np.lexsort((tokens, before))
    before, tokens = before[order], tokens[order]
    at = starts_of(before, tokens)
    counts = np.diff(np.append(at, len(before))).astype("<u4")
    before, tokens = before[at], tokens[at]
    spread = routes.spread(before)
    own = np.flatnonzero(~spread)
    for r, a, b in _slices(before[own], ranges):
        pack(r, before[own[a:b]], tokens[own[a:b]], counts[own[a:b]])
    dealt = np.flatnonzero(spread)
    to = _range_of(mix(mix(before[dealt]) + tokens[dealt]), ranges)
    order = np.argsort(to, kind="stable")  # within a range still by first word
    dealt, to = dealt[order], to[order]
    at = starts_of(to)
    for a, b in zip(at, np.append(at, len(to))[1:], strict=True):
        pack(int(to[a]), before[dealt[a:b]], tokens[dealt[a:b]], counts[dealt[a:b]])
    columns = list(zip(*rows, strict=True))
    to = pa.array(keys[list(columns[0])], pa.int32())
    return pa.record_batch([pa.array(columns[0], pa.int32()), to, *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["range", "to", "contexts", "sizes", "words", "counts"])


def _count_pairs(ranges: int, routes: Routes, keys: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, data, starts in pieces(batch.column(0)):
                before, tokens, _ = _pairs(data, starts)
                held.append((before, tokens))
                size += len(tokens)
                if size >= SORTED_PAIRS:
                    yield _packed_pairs(*[np.concatenate(x) for x in zip(*held, strict=True)], ranges, routes, keys)
                    held, size = [], 0
        if size:
            yield _packed_pairs(*[np.concatenate(x) for x in zip(*held, strict=True)], ranges, routes, keys)

    return run


def _write(place: str, name: str, arrays: list[np.ndarray]) -> str:
    """Writes arrays one after another to a file of its own, so that a task that runs twice disturbs nothing."""
    system, path = fs.FileSystem.from_uri(place)
    system.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a))
    return name


_SENT = "kind int, range int, to int, data array<binary>, file string, size long, stats array<long>"


def _row(kind: int, r: int, data: list[np.ndarray] = (), file: str | None = None, size: int = 0, stats: list[int] = ()) -> tuple:
    return kind, r, [a.tobytes() for a in data], file, size, [int(x) for x in stats]


def _batch(rows: list[tuple], keys: np.ndarray) -> pa.RecordBatch:
    rows = [(kind, r, int(keys[r]), *rest) for kind, r, *rest in rows]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.string(), pa.int64(), pa.list_(pa.int64()))
    names = ("kind", "range", "to", "data", "file", "size", "stats")
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _joined(column, kind: str) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _of_counts(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _merge_pairs(place: str, ranges: int, keys_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["range"]):
            r = table.column("range")[0].as_py()
            sizes = _joined(table.column("sizes"), "<u4")
            before = np.repeat(_joined(table.column("contexts"), "<u8"), sizes)
            words, counts = _joined(table.column("words"), "<u8"), _joined(table.column("counts"), "<u4")
            order = np.lexsort((words, before))
            before, words, counts = before[order], words[order], counts[order].astype(np.int64)
            at = starts_of(before, words)
            before, words, counts = before[at], words[at], np.add.reduceat(counts, at)
            keys = mix(mix(before) + words)
            order = np.argsort(keys)
            wide = len(counts) and int(counts.max()) >= 1 << 32
            file = _write(place, f"{'wide-' if wide else ''}pairs-{r}", [x[order].astype(kind) for x, kind in zip((keys, counts), _WIDE_PAIR_ARRAYS if wide else _PAIR_ARRAYS, strict=True)])
            rows = [_row(PAIRS, r, file=file, size=len(keys), stats=_of_counts(counts))]
            at = starts_of(before)
            classes = [np.add.reduceat(flag.astype(np.int64), at).astype("<u4") for flag in (counts == 1, counts == 2, counts > 2)]
            sums = [before[at], np.add.reduceat(counts, at), *classes]
            rows += [_row(CONTEXTS, to, [x[a:b] for x in sums]) for to, a, b in _slices(sums[0], ranges)]
            order = np.argsort(words, kind="stable")
            words, counts = words[order], counts[order]
            at = starts_of(words)
            totals, different = np.add.reduceat(counts, at), np.diff(np.append(at, len(words))).astype("<u4")
            words = words[at]
            rows += [_row(FOLLOWERS, to, [words[a:b], totals[a:b], different[a:b]]) for to, a, b in _slices(words, ranges)]
            yield _batch(rows, keys_of)

    return run


def _merge_words(place: str, keys_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["range"]):
            r, kinds, data = table.column("range")[0].as_py(), table.column("kind").to_numpy(), table.column("data")
            rows = []
            for k in np.flatnonzero(kinds == PAIRS).tolist():
                rows.append(_row(PAIRS, r, file=table.column("file")[k].as_py(), size=table.column("size")[k].as_py(), stats=table.column("stats")[k].as_py()))
            found = []  # (hash, c, context c, a, n1, n2, n3) per part
            for k in np.flatnonzero(kinds != PAIRS).tolist():
                arrays = [x.as_buffer() for x in data[k]]
                word = np.frombuffer(arrays[0], "<u8")
                nothing = np.zeros(len(word), np.int64)
                if kinds[k] == CONTEXTS:
                    found.append([word, nothing, np.frombuffer(arrays[1], "<i8"), nothing, *[np.frombuffer(x, "<u4") for x in arrays[2:]]])
                else:
                    found.append([word, np.frombuffer(arrays[1], "<i8"), nothing, np.frombuffer(arrays[2], "<u4"), nothing, nothing, nothing])
            if found:
                word, *sums = [np.concatenate(x) for x in zip(*found, strict=True)]
                order = np.argsort(word, kind="stable")
                word = word[order]
                at = starts_of(word)
                sums = [np.add.reduceat(s[order].astype(np.int64), at) for s in sums]
                file = _write(place, f"words-{r}", [x.astype(kind) for x, kind in zip([word[at], *sums], _WORD_ARRAYS, strict=True)])
                c, _, a = sums[:3]
                rows.append(_row(WORDS, r, file=file, size=len(at), stats=[c.sum(), (c > 0).sum(), a.sum(), (a > 2).sum(), *_of_counts(a)]))
            yield _batch(rows, keys_of)

    return run


def discounts(of_counts: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    t = [float(x) for x in of_counts]
    out = [0.0, 0.5, 1.0, 1.5]
    if t[0] and t[1]:
        y = t[0] / (t[0] + 2 * t[1])
        for k in (1, 2, 3):
            if t[k - 1] and t[k]:
                out[k] = min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.0), float(k))
    return np.array(out)


class Model:
    """Where the arrays of a trained model are, and its few global numbers. Travels to the tasks."""

    def __init__(self, place: str, ranges: int, files: dict[int, dict[int, tuple[str, int]]], pair_counts: list[int], word_stats: list[int], routes: Routes):
        self.place, self.ranges, self.files, self.routes = place, ranges, files, routes
        self.tokens, self.vocabulary, self.continuations, more, *of_counts = word_stats
        self.of_pairs, self.of_words = discounts(pair_counts), discounts(of_counts)
        taken = float(self.of_words[1] * of_counts[0] + self.of_words[2] * of_counts[1] + self.of_words[3] * more)
        self.unseen = (taken / self.continuations if self.continuations else 1.0) / (self.vocabulary + 1)


class _Arrays:
    """The arrays of a model, mapped to memory from the shared folder, which must be a mounted one for that."""

    def __init__(self, model: Model):
        where = urlparse(model.place)
        if where.scheme not in ("", "file"):
            raise ValueError(f"{model.place} cannot be mapped to memory: name a mounted folder in spark.checkpoint.dir")
        self.ranges = model.ranges
        self.files = {kind: {r: (os.path.join(where.path, name), size) for r, (name, size) in files.items()} for kind, files in model.files.items()}
        self.open: dict[tuple[int, int], list[np.ndarray]] = {}

    def _arrays(self, kind: int, r: int) -> list[np.ndarray] | None:
        if (kind, r) not in self.open:
            if r not in self.files[kind]:
                return None
            path, size = self.files[kind][r]
            out, at = [], 0
            wide = os.path.basename(path).startswith("wide-")
            for dtype in _WORD_ARRAYS if kind == WORDS else _WIDE_PAIR_ARRAYS if wide else _PAIR_ARRAYS:
                out.append(np.memmap(path, dtype, "r", at, (size,)))
                at += size * np.dtype(dtype).itemsize
            self.open[kind, r] = out
        return self.open[kind, r]

    def find(self, kind: int, keys: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
        """The values of each key, 0 where it is not there; `of` is the hash whose range the key is in."""
        order = np.argsort(_range_of(of, self.ranges), kind="stable")
        found = self._find(kind, keys[order], of[order])
        out = [np.empty_like(x) for x in found]
        for x, y in zip(out, found, strict=True):
            x[order] = y
        return out

    def _find(self, kind: int, keys: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
        width = len(_PAIR_ARRAYS if kind == PAIRS else _WORD_ARRAYS) - 1
        out = [np.zeros(len(keys), np.int64) for _ in range(width)]
        for r, a, b in _slices(of, self.ranges):
            arrays = self._arrays(kind, r)
            if arrays is None:
                continue
            own = keys[a:b]
            at = np.minimum(np.searchsorted(arrays[0], own), len(arrays[0]) - 1)
            hit = np.flatnonzero(arrays[0][at] == own)
            for x, values in zip(out, arrays[1:], strict=True):
                x[a + hit] = values[at[hit]]
        return out


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, for each x the position of its value)."""
    order = np.argsort(x)
    at = starts_of(x[order])
    back = np.empty(len(x), np.int64)
    back[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(x))))
    return x[order][at], back


def _score_piece(model: Model, arrays: _Arrays, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    before, tokens, first = _pairs(data, starts)
    words, place = _distinct(np.concatenate([before, tokens]))
    c, as_context, a, *classes = arrays.find(WORDS, words, words)
    left, right = place[: len(before)], place[len(before) :]
    # distinct pairs, by the rank of the context
    pairs, back = _distinct(left * len(words) + right)
    contexts, followers = words[pairs // len(words)], words[pairs % len(words)]
    keys = mix(mix(contexts) + followers)
    count = arrays.find(PAIRS, keys, model.routes.of(contexts, keys))[0]

    d = model.of_words[np.minimum(a, 3)]
    low = np.maximum(a - d, 0) / max(model.continuations, 1) + model.unseen
    seen = np.maximum(as_context, 1)
    back_off = np.where(as_context > 0, sum(model.of_pairs[k + 1] * n for k, n in enumerate(classes)) / seen, 1.0)
    p = np.maximum(count - model.of_pairs[np.minimum(count, 3)], 0)[back] / seen[left] + back_off[left] * low[right]
    base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
    known = c > 0
    return [np.diff(first)] + [np.add.reduceat(x, first[:-1]) for x in (known[right].astype(np.int64), base[right], np.log10(p))]


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        for batch in batches:
            for first, data, starts in pieces(batch.column("text")):
                size, known, base, score = _score_piece(model, arrays, data, starts)
                ids, held = (batch.column(c).slice(first, len(size)) for c in ("doc_id", "held_out"))
                yield pa.record_batch([
                    ids, held, pa.array(size, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(size), model.tokens), pa.int64()),
                    pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def trained(texts: DataFrame) -> Model:
    """A model of all the texts (one string column; null is empty).

    Its arrays stay in a new folder below spark.checkpoint.dir. Ranges are as many as partitions of the input, so a task
    merges about as much as one has read.
    """
    place = folder(texts.sparkSession)
    ranges = max(4, texts.select(F.spark_partition_id()).distinct().count())
    routes = Routes(frequent_words(texts, ranges))
    keys = even_keys(texts.sparkSession, ranges)
    counted = texts.mapInArrow(_count_pairs(ranges, routes, keys), "range int, to int, contexts binary, sizes binary, words binary, counts binary")
    merged = counted.repartition(ranges, "to").sortWithinPartitions("range").mapInArrow(_merge_pairs(place, ranges, keys), _SENT)
    done = merged.repartition(ranges, "to").sortWithinPartitions("range").mapInArrow(_merge_words(place, keys), _SENT)
    files: dict[int, dict[int, tuple[str, int]]] = {PAIRS: {}, WORDS: {}}
    sums = {PAIRS: [0] * 4, WORDS: [0] * 8}
    for row in stored(done.drop("data"), f"{place}/ranges").collect():  # two rows per range, not data
        files[row["kind"]][row["range"]] = row["file"], row["size"]
        sums[row["kind"]] = [x + y for x, y in zip(sums[row["kind"]], row["stats"], strict=True)]
    return Model(f"{place}", ranges, files, sums[PAIRS], sums[WORDS], routes)


def scored(docs: DataFrame) -> DataFrame:
    """Log probabilities of whole texts under a model of the documents that are in_training.

    docs: doc_id long, text string; other columns are ignored. One row per row: doc_id, held_out, n_tokens (words and an
    end), n_known (of them seen in training), train_tokens, base_score (log10 probability by word counts, half added to
    each), score (by the model). A null or blank text has the end alone. A row without doc_id is held out. Repeated rows
    score alike and count as often as they come. An empty table gives no rows; with nothing to learn from, every token is as
    likely as any other. Words are equal when their 64 bit hashes are.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = trained(docs.where(in_training(F.col("doc_id"))).select("text"))
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.withColumn("held_out", ~in_training(F.col("doc_id"))).mapInArrow(_score(model), kind)
