"""The quality classifier: held-out accuracy, what it may learn from, and odd rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revloom.llm import quality
from revloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def auc(good, bad):
    return np.mean([g > b for g in good for b in bad])


@pytest.fixture(scope="module")
def scored(spark):
    rows = QUERIES["op5_pairwise_quality"](spark, FOLDER).collect()
    return {r["doc_id"]: r for r in rows}, {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}


def test_held_out_accuracy(scored):
    rows, labels = scored
    held = [(rows[d], q) for d, q in labels.items() if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(r["held_out"] for r, _ in held)
    assert auc([r["score"] for r, q in held if q], [r["score"] for r, q in held if not q]) > 0.995
    good = [r["predicted"] for r, q in held if q == 1]
    assert np.mean(good) > 0.99, "clean documents stay"
    assert np.mean([r["predicted"] for r, q in held if q == 0]) < 0.05


def test_columns(scored):
    rows, _ = scored
    assert len(rows) == 10_000
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality.learned(docs, labels), quality.learned(docs, other)
    assert np.array_equal(a.weights, b.weights) and a.threshold == b.threshold


def test_odd_rows(spark):
    texts = [None, "", " \n ", "x" * 100_000, "word " * 50_000, "Fine words stand here, and they go on.", "Fine words stand here, and they go on.", "\x00 é 你好"]
    docs = spark.createDataFrame([(i, t, "s", 1.0) for i, t in enumerate(texts)] + [(None, "a b", "s", 2.0), (3, "again", "s", 0.0)], "doc_id long, text string, held_out_by string, x double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1), (4, 0), (6, None), (6, 7), (7, 0), (7, 1), (None, 1), (8, 1)], "doc_id long, quality int")
    out = quality.scored(docs, labels)
    rows = out.collect()
    assert len(rows) == len(texts) + 2 and out.columns[:4] == docs.columns
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert rows[5]["score"] == rows[6]["score"] and rows[0]["score"] == rows[1]["score"]
    assert rows[8]["held_out"] is True
    assert quality.good_documents(docs, labels).columns == docs.columns


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)]):
        found = quality.scored(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert [(round(r["score"], 12), r["predicted"]) for r in found] == [(0.5, 1), (0.5, 1)]
    assert quality.scored(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect() == []


def test_features_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["one two two.", None, "THREE!! four | five", "", "six " * 50, "no end\n"])
    whole = quality.features(texts)
    monkeypatch.setattr(quality, "PIECE_BYTES", 5)
    assert np.allclose(whole, quality.features(texts)) and np.allclose(whole[2:4], quality.features(texts.slice(2, 2)))
    assert not whole[1].any() and not whole[3].any()


def test_preference_order_is_learned():
    draw = np.random.default_rng(0)
    x = draw.standard_normal((400, len(quality.FEATURES)))
    good = x[:, 3] - 0.5 * x[:, 7] > -0.4
    model = quality.fit(x, good)
    s = model.score(x)
    assert auc(s[good][:50], s[~good][:50]) > 0.99
    assert abs((s < quality.AT_THRESHOLD).mean() - (~good).mean()) < 0.01


SYMBOLS = b"#$%&*+=<>@^_~\\/{}[]"


def plain_features(text):
    """The features of one text, byte by byte and word by word."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(quality.FEATURES)
    tests = [
        lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57, lambda b: b == 32, lambda b: b == 10, lambda b: b == 33, lambda b: b == 124, lambda b: b in SYMBOLS,
        lambda b: b == 46, lambda b: b == 44, None, lambda b: b >= 128,
    ]
    found = [sum(map(test, data)) if test else 0 for test in tests]
    found[9] = len(data) - sum(found) - sum(97 <= b <= 122 for b in data)
    out = [math.sqrt(n / len(data)) for n in found]
    words = data.split()
    lower = [w.lower() for w in words]
    n = max(len(words), 1)
    out.append(sum(w[-1] in SYMBOLS or w[-1] == 33 for w in words) / n)
    out.append(sum(65 <= a <= 90 and 65 <= b <= 90 for a, b in zip(data, data[1:], strict=False)) / len(data))
    out += [math.log1p(sum(map(len, words)) / n), math.log1p(n)]
    out.append(math.log1p(len(set(lower))) / math.log1p(len(words)) if words else 0.0)
    out += [sum(a == b for a, b in zip(lower, lower[gap:], strict=False)) / n for gap in (1, 2)]
    out.append(max(lower.count(w) for w in set(lower)) / (len(words) + 4) if words else 0.0)
    out.append(math.log1p(n / (1 + data.count(b"."))))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aB \n\t!.,|#é1", max_size=60)), max_size=5))
def test_features_against_plain_ones(texts):
    got = quality.features(pa.array(texts, pa.string()))
    assert np.allclose(got, np.array([plain_features(t) for t in texts]).reshape(len(texts), len(quality.FEATURES)), atol=1e-12)


def solved(a, b):
    """Gauss, by rows."""
    rows = [[*r, x] for r, x in zip(a, b, strict=True)]
    n = len(rows)
    for i in range(n):
        top = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[top] = rows[top], rows[i]
        for k in range(n):
            if k != i:
                f = rows[k][i] / rows[i][i]
                rows[k] = [x - f * y for x, y in zip(rows[k], rows[i], strict=True)]
    return [r[n] / r[i] for i, r in enumerate(rows)]


def plain_fit(x, good, pairs):
    """(weights, threshold): the ridge-penalised logistic loss of the pairs brought to its minimum, without a matrix product."""
    d, n = len(x[0]), len(x)
    mean = [sum(r[k] for r in x) / n for k in range(d)]
    scale = [max(math.sqrt(sum((r[k] - mean[k]) ** 2 for r in x) / n), 1e-6) for k in range(d)]
    z = [[min(max((r[k] - mean[k]) / scale[k], -6), 6) for k in range(d)] for r in x]
    differences = [[a - b for a, b in zip(z[i], z[j], strict=True)] for i, j in pairs]
    w = [0.0] * d
    for _ in range(25):
        gradient, curvature = [-quality.RIDGE * v for v in w], [[quality.RIDGE * (i == j) for j in range(d)] for i in range(d)]
        for v in differences:
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(v, w, strict=True))))
            for i in range(d):
                gradient[i] += v[i] * (1 - p) / len(pairs)
                for j in range(d):
                    curvature[i][j] += v[i] * v[j] * p * (1 - p) / len(pairs)
        w = [a + b for a, b in zip(w, solved(curvature, gradient), strict=True)]
    raw = sorted(sum(a * b for a, b in zip(r, w, strict=True)) for r in z)
    place = (n - 1) * (sum(not g for g in good) / n)
    return w, (raw[math.floor(place)] + raw[math.ceil(place)]) / 2 if place != int(place) else raw[int(place)]


def test_fit_against_a_plain_one(monkeypatch):
    """Whole scores of texts, from plain features and a plain fit on the same preference pairs."""
    draw = np.random.default_rng(3)
    words = ["fine", "words", "stand", "HERE", "go!!", "on.", "x9", "buy", "|", "#now", "é"]
    texts = [" ".join(draw.choice(words[: 11 if i % 3 == 0 else 7], draw.integers(1, 30))) for i in range(60)]
    good = [i % 3 != 0 for i in range(60)]
    monkeypatch.setattr(quality, "PAIRS", 200)
    model = quality.fit(quality.features(pa.array(texts)), np.array(good))
    again = np.random.default_rng(quality.SEED)
    pairs = list(zip(again.choice([i for i in range(60) if good[i]], 200).tolist(), again.choice([i for i in range(60) if not good[i]], 200).tolist(), strict=True))
    weights, threshold = plain_fit([plain_features(t) for t in texts], good, pairs)
    assert np.allclose(model.weights, weights, atol=1e-6) and abs(model.threshold - threshold) < 1e-6
