"""Hard negatives against all products in whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from revloom.llm import hard_negatives as hn
from revloom.llm.queries import QUERIES, SQL

ROWS = "vec_id long, embedding array<double>, label int, row_id int, score string, rank string, positives int, length string, wide string, vector string"


def plain(rows, is_anchor, *, positives=5, negatives=10, least=30, most=90):
    """rows: (vec_id, embedding, label), in the order of the table."""
    usable = []
    for n, (vec_id, x, label) in enumerate(rows):
        if label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            usable.append((n, vec_id, label, [math.floor(Fraction(v) * 256) for v in x]))
    out = []
    for n, vec_id, label, q in usable:
        if not is_anchor(vec_id):
            continue
        scored = [(min(max(sum(a * b for a, b in zip(q, r, strict=True)), -hn.MOST), hn.MOST), i, m, l) for m, i, l, r in usable if m != n and len(r) == len(q)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))
        for p, pid, _, _ in [s for s in scored if s[3] == label][:positives]:
            found = [s for s in scored if s[3] != label and least * p <= 100 * s[0] <= most * p][:negatives]
            out += [(vec_id, pid, rank, s[1], p, s[0]) for rank, s in enumerate(found, 1)]
    return out


def same(got, expected):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def table(spark, rows):
    # one partition, so that rows that share an id have a known order
    return spark.createDataFrame([(*r, 1, "s", "r", 2, "l", "w", "v") for r in rows], ROWS).coalesce(1)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(v, x, (l + 1) % 10 if l is not None and v % 7 == 0 else l) for v, x, l in rows]
    out = QUERIES["op12_vertical_scan_negatives"](spark, folder)
    assert dict(out.dtypes) == {**dict.fromkeys(["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"], "bigint"), "rank": "int"}
    expected = plain(rows, lambda v: v % 100 == 0)
    same(out.collect(), expected)
    assert len(expected) > 100
    assert compare(out, SQL["op12_vertical_scan_negatives"], connect(folder)) is None


def clustered(draw, n, length, labels):
    centres = draw.standard_normal((6, length))
    return [(i, (centres[draw.integers(6)] + draw.standard_normal(length) * 0.7).tolist(), int(draw.integers(labels))) for i in range(n)]


@pytest.mark.parametrize(("length", "labels", "small"), [(40, 3, False), (7, 2, True), (33, 5, True)])
def test_many_rows(spark, monkeypatch, length, labels, small):
    if small:  # many blocks of both kinds
        monkeypatch.setattr(hn, "ROW_BYTES", 40 * length * 2)
        monkeypatch.setattr(hn, "ANCHOR_BYTES", 9 * length * 2)
    rows = clustered(np.random.default_rng(length), 700, length, labels)
    got = hn.hard_negatives(table(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, least=10, most=80)
    expected = plain(rows, lambda v: v % 20 == 0, least=10, most=80)
    same(got.collect(), expected)
    assert len(expected) > 500


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0, 0.5], 1), (10, [1.0, 2.0, 0.5], 1), (10, [1.0, 2.0, 0.4], 1), (None, [1.0, 2.0, 0.5], 1), (1, None, 1), (2, [nan, 1.0, 1.0], 1), (3, [inf, 1.0, 1.0], 2),
        (4, [None, 1.0, 1.0], 2), (5, [], 1), (20, [], 1), (6, [], 2), (7, [0.5, 1.0, 0.3], 2), (7, [0.5, 1.0, 0.3], 2), (8, [0.5, 1.0, 0.3], 3), (None, [0.5, 1.0, 0.3], 2),
        (9, [0.5, 1.0, 0.3], None), (30, [0.0, 0.0, 0.0], 4), (31, [0.0, 0.0, 0.0], 4), (32, [-1.0, 0.0, 0.0], 5), (40, [1.0, 2.0], 1), (41, [1.0, 1.5], 1), (42, [0.5, 1.0], 2),
        (50, [1e300, 1.0, 0.0], 6), (51, [1e305, -1.0, 0.0], 6), (52, [2e-300, 5.0, 0.0], 7), (53, [1.7e308, 0.0, 0.0], 7), (60, [5e4, 1.0, 0.0], 8), (61, [4e4, 1e9, 0.0], 8),
        (62, [3.0, 2.0, 0.0], 9), (63, [128.0, -128.0, 127.99], 9), (64, [-128.00390625, 1 / 256, -1 / 512], 9), (-10, [0.4, 0.9, 0.2], 2), (-20, [0.4, 0.9, 0.2], 2),
        (65, [2.5e4, 1.0, 0.0], 9), (66, [2.6e4, 1e9, 0.0], 9),
    ]
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0)
    expected = plain(rows, lambda v: v is not None and v % 10 == 0)
    same(got.collect(), expected)
    assert {r[0] for r in expected} >= {0, 10, 20, 30, 40, 60}


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 1.0] if i < 60 else [0.5, 0.5], i // 60) for i in range(120)]
    same(hn.hard_negatives(table(spark, rows), F.col("vec_id") % 50 == 0).collect(), plain(rows, lambda v: v % 50 == 0))


def test_no_rows(spark):
    out = hn.hard_negatives(table(spark, []), F.col("vec_id") % 100 == 0)
    assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hn.hard_negatives(table(spark, [(1, [1.0], 1), (2, [1.0], 2)]), F.col("vec_id") % 100 == 0).collect() == []


def test_bounds_shrink_the_candidates():
    """Of clustered rows most are dropped before the last dimension, and none that belongs to the result."""
    draw = np.random.default_rng(1)
    length, n = 64, 4000
    falling = 1.0 / np.arange(1, length + 1)
    x = np.floor(256 * draw.standard_normal((n, length)) * falling)
    import pyarrow as pa

    block = hn.Columns(pa.table({"row_id": np.arange(n), "vec_id": np.arange(n), "label": np.zeros(n, np.int64), "wide": np.zeros(n, bool), "vector": [v.astype("<i2").tobytes() for v in x]}), length)
    anchor = x[0].astype(np.int64)
    bounds = hn.Bounds(block, anchor, False, np.arange(1, n))
    left = []
    while bounds.step():
        bounds.keep(bounds.high >= hn._kth_largest(bounds.low, 5))
        left.append(len(bounds.at))
    assert left == sorted(left, reverse=True) and left[len(left) // 2] < n / 4
    at, scores = hn.best_of_label(block, anchor, False, 0, 0, 5)
    every = x[1:] @ x[0]
    assert scores.tolist() == sorted(every.astype(int).tolist(), reverse=True)[:5]
