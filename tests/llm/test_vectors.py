"""Links between near vectors and nearest neighbours, against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revloom.llm import near_vectors as nv
from revloom.llm import neighbours as nb
from revloom.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int, weight int, vertex string"


def usable(x):
    return x is not None and len(x) > 0 and None not in x and bool(np.isfinite(np.array(x, dtype=np.float64)).all()) and any(x)


def links_plain(rows, cosine):
    """(vec_id, n_links, component_id, kept) by comparing every two rows."""
    units = [np.array(x, np.float32).astype(np.float64) if usable(x) else None for _, x, _ in rows]
    units = [None if u is None else u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()) for u in units]
    up, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [(r[0], links[i], least.get(top(i)), r[0] == least.get(top(i))) for i, r in enumerate(rows)]


def groups(draw, n, length):
    out = []
    while len(out) < n:
        centre = draw.standard_normal(length)
        for _ in range(draw.choice([1, 2, 10])):
            out.append((centre + draw.standard_normal(length) * draw.choice([0.0, 0.02, 0.1]) * np.linalg.norm(centre) / length**0.5).tolist())
    return out[:n]


def same(got, expected):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_links_of_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(QUERIES["op8_spherical_cap_links"](spark, folder).collect(), links_plain(rows, 0.98))


@pytest.mark.parametrize("block", [4096, 5])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    draw = np.random.default_rng(block)
    rows = [(i, x, int(draw.integers(0, 3))) for i, x in enumerate(groups(draw, 500, 24))]
    df = spark.createDataFrame([(*r, 1, "v") for r in rows], ROWS)
    same(nv.linked_vectors(df.repartition(4)).collect(), links_plain(rows, 0.98))


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [float("nan"), 1.0], 0), (8, [float("inf"), 1.0], 0),
            (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [2.0, 0.0], 0), (12, [1e-30, 0.0], 0), (13, [3e38, 3e38], 0), (14, [1e30, 1e30], 0), (None, [1.0, 0.01], 0), (2, [0.0, 1.0], 0),
            (15, [-0.0, 1.0], 0), (16, [5.0], 1), (17, [7.0], 1), (18, [-7.0], 1), (None, [9.0], 7), (None, None, None)]
    df = spark.createDataFrame([(*r, 1, "v") for r in rows], ROWS)
    same(nv.linked_vectors(df.repartition(3)).collect(), links_plain(rows, 0.98))
    doubles = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    same(nv.linked_vectors(doubles).collect(), links_plain(rows, 0.98))
    assert nv.linked_vectors(df.limit(0)).collect() == []


def nearest_plain(rows, asks, k):
    good = [(v, np.array(x, np.float32).astype(np.float64)) for v, x in rows if v is not None and usable(x)]
    most = max({len(x) for _, x in good}, key=lambda n: (sum(len(x) == n for _, x in good), -n))
    good = [(v, x) for v, x in good if len(x) == most]
    out = []
    for i, (q, x) in enumerate(good):
        if asks(q):
            found = sorted((-float(np.einsum("i,i->", x, y)), v) for j, (v, y) in enumerate(good) if j != i)[:k]
            out += [(q, rank, v, -s) for rank, (s, v) in enumerate(found, 1)]
    return out


def recall(got, expected, k=20):
    by = lambda rows: {q: {r[2] for r in rows if r[0] == q} for q in {r[0] for r in rows}}
    got, expected = by(got), by(expected)
    return np.mean([len(got[q] & e) / len(e) for q, e in expected.items()])


def test_neighbours_of_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in QUERIES["op9_projection_forest_neighbours"](spark, folder).collect()]
    expected = nearest_plain(rows, lambda q: q % 20 == 0, 20)
    assert recall(got, expected) >= 0.95
    of = dict(rows)
    for q in {r[0] for r in got}:
        mine = sorted((r for r in got if r[0] == q), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 21)) and q not in {r[2] for r in mine}
        assert [(-r[3], r[2]) for r in mine] == sorted((-r[3], r[2]) for r in mine)
        assert all(r[3] == pytest.approx(np.array(of[q], float) @ np.array(of[r[2]], float), rel=1e-12) for r in mine)


def test_recall_where_the_sample_is_a_part(spark, monkeypatch):
    monkeypatch.setattr(nb, "SAMPLE_ROWS", 800)
    draw = np.random.default_rng(8)
    rows = [(i, x) for i, x in enumerate((draw.standard_normal((4000, 32)) * draw.uniform(0.2, 3, (4000, 1))).tolist())]
    df = spark.createDataFrame([(*r, 0, 1, "v") for r in rows], ROWS)
    got = [tuple(r) for r in nb.nearest(df, F.col("vec_id") % 100 == 0, 10).collect()]
    assert recall(got, nearest_plain(rows, lambda q: q % 100 == 0, 10)) >= 0.9


@pytest.mark.parametrize("block", [4096, 3])
def test_few_odd_and_tied_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(nb, "BLOCK", block)
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(12)] + [(20, [2.0, 0.0, 1.0]), (21, None), (22, []), (23, [0.0, 0.0, 0.0]), (24, [float("nan"), 1.0, 1.0]), (25, [None, 1.0, 1.0]), (26, [1.0]),
                                                        (None, [9.0, 9.0, 9.0]), (40, [-1.0, 0.0, 0.0]), (20, [2.0, 0.0, 1.0])]
    df = spark.createDataFrame([(*r, 0, 1, "v") for r in rows], ROWS)
    for k in (5, 20):
        got = [tuple(r) for r in nb.nearest(df.repartition(3), F.col("vec_id") % 20 == 0, k).collect()]
        assert sorted(got) == sorted(nearest_plain(rows, lambda q: q % 20 == 0, k))
    assert nb.nearest(df.limit(0), F.lit(True), 5).collect() == []
    assert nb.nearest(df, F.lit(False), 5).collect() == []


def test_leaves_part_the_points():
    draw = np.random.default_rng(0)
    points = np.concatenate([draw.standard_normal((1000, 8)), np.zeros((600, 8)), np.ones((300, 8))])
    tree = nb.Tree(points, draw)
    leaves = tree.leaf_of(points)
    assert set(leaves) == set(range(tree.leaves))
    large = [np.unique(points[leaves == n], axis=0) for n in range(tree.leaves) if (leaves == n).sum() > nb.LEAF]
    assert all(len(x) == 1 for x in large), "only equal points share a large leaf"
