"""The n-gram join against all pairs of a small fixture."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revloom.llm import ngram_join as nj
from revloom.llm.queries import QUERIES


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*[words[i:] for i in range(width)], strict=False)) if len(words) >= width else frozenset([tuple(words)])


def plain(rows, width, percent):
    """(doc_id, n_shingles, component_id, n_links) by comparing every two rows."""
    sets = [shingles(t, width) for _, t in rows]
    up, links = list(range(len(rows))), Counter()

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [(d, len(s), least.get(top(i)), links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def same(got, expected):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def found(df, width, percent):
    return nj.linked_documents(df, width, percent).select("doc_id", "n_shingles", "component_id", "n_links").collect()


def near_copies(seed, n):
    """Texts in families of edited copies, sharing lines across families."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.choice([draw.randrange(30), draw.randrange(3000)])}"
    shared = [" ".join(word() for _ in range(12)) for _ in range(4)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(draw.choice([2, 6, 15, 60, 300]))] + draw.choice(shared).split()
        for _ in range(draw.choice([1, 1, 2, 8, 25])):
            copy = list(base)
            for _ in range(draw.randrange(0, max(2, len(copy) // 12))):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out[:n]


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op1_ngram_jaccard_join"](spark, folder).collect(), plain(rows, 3, 90))


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (2, 51), (1, 60), (3, 100)])
def test_families_equal_all_pairs(spark, width, percent, monkeypatch):
    rows = list(enumerate(near_copies(width, 400)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(found(df, width, percent), plain(rows, width, percent))
    # blocks of lists and clusters do not change the result
    monkeypatch.setattr(nj, "BLOCK", 3)
    monkeypatch.setattr(nj, "LIST_BLOCK", 4)
    same(found(df, width, percent), plain(rows, width, percent))


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    texts = [None, "", " \n\t", "one", "One", "one two", "ONE TWO", "a b c d e f", "A B C D E F", long, long + " end", "É é x", "é é x", "a\x1fb c d", "same same same same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one two"), (None, "lonely words here"), (None, None), (7, "a b c d e f"), (7, "other text under a number"), (3, "one")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, digest string, vertex int, signature string")
    same(found(df.repartition(4), 3, 90), plain(rows, 3, 90))


def test_one_per_group(spark):
    rows = list(enumerate(near_copies(5, 200))) + [(3, "an extra text of more than five words"), (None, None), (900, ""), (901, " "), (None, "x y z x y z x y z")]
    rows += [rows[0], rows[1]]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, digest string")
    kept = nj.one_per_group(df).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "digest"}
    by = {}
    for (d, n, c, _), (_, t) in zip(plain(rows, 5, 80), rows, strict=True):
        if n:
            by.setdefault((c, t if c is None else None), []).append((d is None, d or 0))
    expected = sorted(min(v) for v in by.values()) + [(True, 0), (False, 900), (False, 901)]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(expected)


def test_groups_that_share_their_smallest_number(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (10, a + " end"), (3, b), (11, b + " end"), (-1, "minus one is a number of its own"), (None, c), (None, c + " end"), (None, "alone with no number at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = nj.one_per_group(df).collect()
    once = [(3, a), (3, b), rows[4], rows[7]]
    assert sorted((tuple(r) for r in kept if r["text"] not in (c, c + " end")), key=str) == sorted(once, key=str)
    assert len(kept) == len(once) + 1, "one of the linked rows without a number"


def test_thresholds_of_a_half_or_less_are_refused(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for percent in (0, 50, 101):
        with pytest.raises(ValueError, match="above 50"):
            nj.linked_documents(df, 3, percent)


def test_many_rows_without_a_number(spark):
    """Rows that share a null number fetch one text per class, not one per row."""
    texts = near_copies(3, 60)
    rows = [(None, t) for t in texts for _ in range(7)] + [(5, t) for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(found(df, 3, 80), plain(rows, 3, 80))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert found(empty, 3, 90) == []
    assert nj.one_per_group(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10_000), st.integers(51, 100))
def test_linked_sets_share_a_signature(n, seed, percent):
    draw = np.random.default_rng(seed)
    a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
    weights = {int(x): int(w) for x, w in zip(a, draw.choice([1, 50, 100, 5000], len(a)), strict=True)}
    # the most that may be missing, and as many new ones as the threshold allows
    gone = nj._missing(len(a), percent)
    b = np.delete(a, draw.choice(len(a), draw.integers(0, gone + 1), replace=False))
    more = (100 * len(b) - percent * len(a)) // percent
    fresh = draw.integers(0, 2**63, draw.integers(0, max(more, 0) + 1)).astype(np.uint64)
    weights |= {int(x): int(w) for x, w in zip(fresh, draw.choice([1, 100], len(fresh)), strict=True)}
    b = np.unique(np.concatenate([b, fresh]))
    both = len(np.intersect1d(a, b))
    if 100 * both < percent * (len(a) + len(b) - both) or not both:
        return
    signed = [nj.signatures(x, np.array([weights[int(v)] for v in x]), percent, 64) for x in (a, b)]
    assert len(np.intersect1d(*signed)) or np.array_equal(a, b)


def test_sketches_never_overrate_a_difference():
    import pyarrow as pa

    draw = np.random.default_rng(1)
    for n in (1, 40, 200, 700, 6000):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 4 :], draw.integers(0, 2**63, n // 2).astype(np.uint64)]))
        s = nj._Sketches(pa.array([nj.sketch(a), nj.sketch(b)]))
        assert s.differing(np.array([0]), np.array([1]))[0] <= len(np.setxor1d(a, b)) or len(b) < len(a) / 2
