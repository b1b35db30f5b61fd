"""Set similarity join of documents on their word shingles, by prefixes of token combinations.

Shingles have one global order: those whose rarest word is rarest in the corpus come first. A document of n shingles
that reaches the threshold with another one lacks at most e of its shingles there. So if a prefix in the global order is
so long that e missing shingles cannot touch all its signatures, two linked documents share a signature:

* a rare shingle is a signature by itself, lost with one missing shingle;
* frequent shingles are dealt into classes by hash and every pair of a class is a signature, so a class of k shingles is
  lost only with k - 1 missing ones. The prefix is extended until rare ones and classes outweigh e.

Frequent is judged by a table of word counts of fixed size (COUNT_BUCKETS); it bends only the order, hence the cost, never
the result. Documents that share a signature are compared by parity sketches: the number of bits in which two sketches
differ is never above the number of shingles that only one of the sets has, so pairs beyond the threshold's difference are
surely no links. Pairs that pass join their documents to clusters, whose members meet in blocks of BLOCK, each pair of
blocks in a task of its own, where all pairs are verified on the whole sets. Lists of a frequent signature are split into
blocks likewise. Tasks give link counts and spanning forests, never pairs. Equal sets are one class from the start, so
copies cost one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.components import components
from revloom.llm.hashing import mix, ngram_hashes, pieces, word_hashes
from revloom.llm.shared import as_row, block_pairs, folder, may_hold, runs, smallest_reached, starts_of, stored, whole_runs

#: Buckets of the table of word counts: 4 MiB, sent to every task.
COUNT_BITS = 20
COUNT_BUCKETS = 1 << COUNT_BITS
SLICES = 16
#: Missing shingles that a class of frequent ones is meant to bear.
CLASS_SIZE = 8
#: Documents in a block; a task verifies the pairs of two blocks.
BLOCK = 512
#: Documents in a block of a signature's list, compared by sketches.
LIST_BLOCK = 2048
#: Bits of a sketch, a power of two at least the size of the set within these.
SKETCH_BITS = (64, 4096)
#: Pairs whose sketches are compared at a time.
PAIRS = 1 << 14
#: Columns of the 0/1 matrices that a task multiplies at a time.
COLUMNS = 4096


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNT_BUCKETS, np.int64)
    for batch in batches:
        for _, data, starts in pieces(batch.column(0)):
            counts += np.bincount(_bucket(word_hashes(data, starts)[0]), minlength=COUNT_BUCKETS)
    if counts.any():
        parts = [p.tobytes() for p in np.split(np.minimum(counts, 2**31 - 1).astype(np.int32), SLICES)]
        yield pa.record_batch({"slice": pa.array(range(SLICES), pa.int32()), "counts": pa.array(parts, pa.binary())})


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            got = np.frombuffer(part.as_buffer(), np.int32)
            sums[k] = np.minimum(sums[k].astype(np.int64) + got, 2**31 - 1).astype(np.int32) if k in sums else got
    yield pa.record_batch({"slice": pa.array(list(sums), pa.int32()), "counts": pa.array([v.tobytes() for v in sums.values()], pa.binary())})


def word_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all words of the one text column, by hash bucket; at most 2^31 - 1 each."""
    kind = "slice int, counts binary"
    added = texts.mapInArrow(_count_words, kind).repartition(SLICES, "slice").mapInArrow(_add_slices, kind)
    counts = np.zeros((SLICES, COUNT_BUCKETS // SLICES), np.int32)
    for row in added.collect():
        counts[row["slice"]] = np.frombuffer(row["counts"], np.int32)
    return counts.ravel()


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int, worth: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Per text its sorted distinct shingle hashes, and for each the smallest `worth` (by bucket) among its words."""
    words, first = word_hashes(data, starts)
    grams = ngram_hashes(words, width)
    weights = None
    if worth is not None:
        each = worth[_bucket(words)]
        weights = each[: len(grams)].copy()
        for i in range(1, width):
            np.minimum(weights, each[i : i + len(grams)], out=weights)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= width:
            found, at = np.unique(grams[lo : hi - width + 1], return_index=True)
            yield found, None if weights is None else weights[lo + at]
        elif hi > lo:  # the whole sequence, told apart from shingles by its length
            yield ngram_hashes(words[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo), None if worth is None else each[lo:hi].min(keepdims=True)
        else:
            yield np.empty(0, np.uint64), None if worth is None else np.empty(0, np.int32)


def _missing(n: int, percent: int) -> int:
    """The most shingles of a set of n that a partner may lack."""
    return n - -(-percent * n // 100)


def _level(n: int, percent: int) -> int:
    """Frequent shingles go to 2^level classes; it steps by one where n doubles, so by one at most between partners."""
    return max(0, (n * (100 - percent) // (100 * CLASS_SIZE)).bit_length() - 1)


def signatures(shingles: np.ndarray, weights: np.ndarray, percent: int, frequent: int) -> np.ndarray:
    """Signatures of a set; every two sets at the threshold share one (see the module's text)."""
    n = len(shingles)
    if not n:
        return shingles
    need = _missing(n, percent) + 1
    rare = weights <= frequent
    singles = shingles[rare]
    if len(singles) >= need:
        return singles[np.lexsort((singles, weights[rare]))[:need]]
    out, need = [singles], need - len(singles)
    others = shingles[~rare]
    others = others[np.lexsort((others, weights[~rare]))]
    for level in {_level(n, percent), _level(-(-percent * n // 100), percent)}:
        kind = (mix(others) & np.uint64((1 << level) - 1)).astype(np.int64)
        # a class bears as many missing ones as it has members but one: repeats of a class in the order
        seen_before = np.ones(len(kind), dtype=bool)
        seen_before[np.unique(kind, return_index=True)[1]] = False
        enough = np.searchsorted(np.cumsum(seen_before), need) + 1
        kind, taken = kind[:enough], others[:enough]
        order = np.argsort(kind, kind="stable")
        kind, taken = kind[order], taken[order]
        edges = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True]) if len(kind) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            members = np.sort(taken[a:b])
            i, j = np.triu_indices(b - a, 1)
            out.append(mix(mix(members[i]) + members[j] + np.uint64(level + 1)))
    return np.unique(np.concatenate(out))


def sketch(shingles: np.ndarray) -> bytes:
    """For each bit, whether an odd number of shingles falls on it."""
    low, high = SKETCH_BITS
    bits = min(high, max(low, 1 << (max(len(shingles), 1) - 1).bit_length()))
    odd = np.bincount((mix(shingles) >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _signed(width: int, percent: int, counts, frequent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth, row = counts.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, data, starts in pieces(batch.column("text")):
                sizes, digests, found, sketches = [], [], [], []
                for shingles, weights in shingle_sets(data, starts, width, worth):
                    sizes.append(len(shingles))
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    sketches.append(sketch(shingles))
                    found.append(signatures(shingles, weights, percent, frequent).view(np.int64))
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), pa.array(np.concatenate(found), pa.int64()))
                yield pa.record_batch({
                    "row_id": pa.array(np.arange(row, row + len(sizes)), pa.int64()), "doc_id": batch.column("doc_id").slice(first, len(sizes)),
                    "text_hash": batch.column("text_hash").slice(first, len(sizes)), "n_shingles": pa.array(sizes, pa.int64()),
                    "digest": pa.array(digests, pa.binary()), "sketch": pa.array(sketches, pa.binary()), "signatures": lists,
                })
                row += len(sizes)

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, by products of 0/1 matrices over shared shingles."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = _both(_sorted_distinct(a), _sorted_distinct(b))
    out = np.zeros((len(left), len(right)), np.float32)
    places = []
    for flat, sets in ((a, left), (b, right)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, flat)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == flat[hit]
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], owner[hit][order]))
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        ones = []
        for (at, owner), sets in zip(places, (left, right), strict=True):
            lo, hi = np.searchsorted(at, [low, low + width])
            m = np.zeros((len(sets), width), np.float32)
            m[owner[lo:hi], at[lo:hi] - low] = 1
            ones.append(m)
        out += ones[0] @ ones[1].T
    return out.astype(np.int64)


def _sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.flatnonzero(np.r_[True, x[1:] != x[:-1]])] if len(x) else x


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What is in both of two sorted arrays without repeats."""
    x = np.concatenate([a, b])
    x.sort(kind="stable")
    return x[:-1][x[1:] == x[:-1]]


class _Sketches:
    """Sketches of some rows, as words, by their width."""

    def __init__(self, column):
        raw = column.to_pylist()
        self.width = np.array([len(x) for x in raw])
        self.place = np.empty(len(raw), np.int64)
        self.words = {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            self.words[w] = np.frombuffer(b"".join([raw[k] for k in rows]), np.uint64).reshape(len(rows), -1)

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the rows a differ from the rows b, pair by pair; the wider one is folded to half its bits.

        Beyond that factor of two no two sets can link: the answer is then larger than any number.
        """
        out = np.full(len(a), np.iinfo(np.int64).max // 1000)
        a, b = np.where(self.width[a] <= self.width[b], a, b), np.where(self.width[a] <= self.width[b], b, a)
        for w, words in self.words.items():
            for other in (w, 2 * w):
                if other not in self.words:
                    continue
                pairs = np.flatnonzero((self.width[a] == w) & (self.width[b] == other))
                wide = self.words[other]
                if other != w:
                    wide = wide[:, : wide.shape[1] // 2] ^ wide[:, wide.shape[1] // 2 :]
                for low in range(0, len(pairs), PAIRS):
                    p = pairs[low : low + PAIRS]
                    out[p] = np.bitwise_count(words[self.place[a[p]]] ^ wide[self.place[b[p]]]).sum(1, dtype=np.int64)
        return out


def _may_link(sketches: _Sketches, n: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    least = np.abs(n[a] - n[b])
    out = (100 + percent) * least <= (100 - percent) * (n[a] + n[b])
    sure = np.flatnonzero(out)
    out[sure] = (100 + percent) * sketches.differing(a[sure], b[sure]) <= (100 - percent) * (n[a[sure]] + n[b[sure]])
    return out


def _plausible(percent: int):
    """From the lists of signatures to edges (a, b) that join what may be linked; no more than a list has documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["signature", "i", "j"]):
            signature, i, j, ids, n, block = (table.column(c).to_numpy() for c in ("signature", "i", "j", "vertex", "n_shingles", "block"))
            sketches = _Sketches(table.column("sketch"))
            at = starts_of(signature, i, j)
            size = np.diff(np.append(at, len(ids)))
            end = np.repeat(at + size, size)
            first, second = [], []
            # all pairs of one distance in their list at a time
            rows, distance = np.arange(len(ids)), 0
            while len(rows):
                distance += 1
                rows = rows[rows + distance < end[rows]]
                for low in range(0, len(rows), 8 * PAIRS):
                    a = rows[low : low + 8 * PAIRS]
                    b = a + distance
                    kept = _may_link(sketches, n, a, b, percent) & ((i[a] == j[a]) | (block[a] != block[b]))
                    first.append(a[kept])
                    second.append(b[kept])
            if not first:
                continue
            root = smallest_reached(len(ids), np.concatenate(first), np.concatenate(second))
            moved = np.flatnonzero(root != np.arange(len(ids)))
            a, b = ids[root[moved]], ids[moved]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            once = starts_of(a, b)
            yield pa.record_batch({"a": pa.array(a[once]), "b": pa.array(b[once])})

    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["cluster", "i", "j"]):
            cell = cell.sort_by("vertex")
            ids, weight = cell.column("vertex").to_numpy(), cell.column("weight").to_numpy()
            block, expected = cell.column("block").to_numpy(), cell.column("digest").to_pylist()
            sets: dict[int, np.ndarray] = {}
            known: set[int] = set()
            for first, data, starts in pieces(cell.column("text")):
                for k, (shingles, _) in enumerate(shingle_sets(data, starts, width), first):
                    # another text under the same doc_id, or the same row again
                    if ids[k] not in known and hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == expected[k]:
                        known.add(ids[k])
                        sets[k] = shingles
            here = np.array(sorted(sets), dtype=np.int64)
            if len(here) < 2:
                continue
            i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
            left, right = here[block[here] == i], here[block[here] == j]
            if not len(left) or not len(right):
                continue
            overlap = _overlaps([sets[k] for k in left], [sets[k] for k in right])
            sizes = [np.array([len(sets[k]) for k in side]) for side in (left, right)]
            linked = 100 * overlap >= percent * (sizes[0][:, None] + sizes[1][None, :] - overlap)
            if i == j:
                np.fill_diagonal(linked, False)
            links = np.zeros(len(ids), np.int64)
            links[left] += linked @ weight[right]
            if i != j:
                links[right] += linked.T @ weight[left]
            x, y = np.nonzero(linked)
            root = smallest_reached(len(ids), left[x], right[y])
            got = np.unique(np.concatenate([left, right]))
            got = got[links[got] > 0]
            if len(got):
                yield pa.record_batch({"vertex": pa.array(ids[got]), "links": pa.array(links[got]), "root": pa.array(ids[root[got]])})

    return run


def _known(doc_id: str):
    return F.coalesce(F.col(doc_id), F.lit(0)).alias("doc_id")


def linked_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose sets of distinct `width`-word shingles have a Jaccard similarity of `percent` / 100 or more, for 51 to 100.

    docs: doc_id long, text string; other columns are ignored. One row per row of docs: doc_id, text_hash (xxhash64 of the
    text), n_shingles, component_id (smallest doc_id reachable by links, nulls aside; null if there are only nulls),
    n_links (other rows linked directly, copies one by one), digest (of the set), row_id, root (a row_id of the component,
    which tells components apart where they share their smallest doc_id). Fewer words than `width` are one shingle. A null
    or blank text has no shingles, links with nothing and is its own component. Rows that share a doc_id are documents of
    their own. An empty table gives no rows. Shingles count as equal when their 64 bit hashes are.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = docs.sparkSession
    place = folder(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    counts = word_counts(docs.select("text"))
    frequent = 64 + 2 * int(np.median(counts))
    sent = spark.sparkContext.broadcast(counts)
    signed = stored(
        docs.mapInArrow(
            _signed(width, percent, sent, frequent), "row_id long, doc_id long, text_hash long, n_shingles long, digest binary, sketch binary, signatures array<long>"),
        f"{place}/signed")
    classes = stored(
        signed.where("n_shingles > 0").groupBy("digest").agg(
            F.min(F.struct("row_id", "doc_id", "text_hash")).alias("own"), F.count("*").alias("weight"), F.min("doc_id").alias("low"),
            F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("signatures").alias("signatures"))
        .withColumn("vertex", F.col("own.row_id")),
        f"{place}/classes")
    # ids alone until it is known which documents meet; then each one's sketch is fetched
    postings = classes.select("vertex", F.explode("signatures").alias("signature"))
    lists = stored(postings.groupBy("signature").agg(F.count("*").alias("size")).where("size > 1"), f"{place}/lists")
    shared = postings.where(may_hold(lists.select("signature"))(F.col("signature"))).join(lists, "signature")
    # near copies share dozens of signatures: of lists with the same documents one is looked through
    short = shared.where(F.col("size") <= LIST_BLOCK).groupBy("signature").agg(F.array_sort(F.collect_list("vertex")).alias("members"))
    short = short.select("members").distinct().select(F.xxhash64("members").alias("signature"), F.explode("members").alias("vertex"), F.lit(1).alias("blocks"))
    long = shared.where(F.col("size") > LIST_BLOCK).select("signature", "vertex", F.ceil(F.col("size") / F.lit(LIST_BLOCK)).cast("int").alias("blocks"))
    meeting = stored(short.union(long), f"{place}/meeting")
    sketched = meeting.join(classes.select("vertex", "n_shingles", "sketch"), "vertex")
    near = block_pairs(sketched, "signature").mapInArrow(_plausible(percent), "a long, b long")
    clusters = components(near)
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    members = (
        clusters.join(sizes, "root").join(classes.select("vertex", "digest", "weight", "own"), F.col("id") == F.col("vertex"))
        .select("vertex", "digest", "weight", _known("own.doc_id"), F.col("own.doc_id").isNull().alias("none"), "own.text_hash", F.col("root").alias("cluster"), "blocks")
    )
    members = stored(members, f"{place}/members")
    # one text per class, however many rows share its doc_id or are its copies
    one = ["doc_id", "none", "text_hash"]
    wanted = docs.select(_known("doc_id"), F.col("doc_id").isNull().alias("none"), "text_hash", "text").where(may_hold(members.select("text_hash"))(F.col("text_hash")))
    texts = members.join(wanted.groupBy(*one).agg(F.first("text").alias("text")), one).drop(*one)
    verified = stored(block_pairs(texts, "cluster").mapInArrow(_verify(width, percent), "vertex long, links long, root long"), f"{place}/verified")
    # a cluster of one block is settled by its task; the forests of others are joined
    forest = components(verified.select(F.col("root").alias("a"), F.col("vertex").alias("b")))
    links = verified.groupBy("vertex").agg(F.sum("links").alias("links"))
    found = (
        classes.select("vertex", "digest", "weight", "low").join(links, "vertex", "left").join(forest.withColumnRenamed("id", "vertex"), "vertex", "left")
        .select("digest", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "vertex").alias("root"))
    )
    least = found.groupBy("root").agg(F.min("low").alias("component_id"))
    found = found.join(least, "root").select("digest", "n_links", "component_id", "root")
    return signed.join(found, "digest", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "digest", "row_id", F.coalesce("root", "row_id").alias("root"))


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without near copies: of each group that links join, the row with the smallest doc_id stays.

    A null doc_id comes last; equal doc_ids are told apart by their text, and of equal rows one stays. Rows without words
    all stay. All columns are kept, whatever their names.
    """
    found = linked_documents(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    grouped = found.where("n_shingles > 0").groupBy("root").agg(first)
    keep = grouped.select(_known("first.doc_id"), "first.none", "first.text_hash").distinct()
    worded = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
    # the row in a struct, so that its columns meet no others; repeated rows differ by these alone, so any of them may stay
    number = F.col("doc_id").cast("long")
    rows = docs.select(as_row(docs).alias("row"), worded.alias("worded"), F.coalesce(number, F.lit(0)).alias("doc_id"), number.isNull().alias("none"), F.xxhash64("text").alias("text_hash"))
    key = ["doc_id", "none", "text_hash"]
    once = rows.where("worded").join(keep, key).dropDuplicates(key)
    return once.select("row.*").union(rows.where("NOT worded").select("row.*"))
