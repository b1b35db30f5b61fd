"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revloom.llm import resampling
from revloom.llm.queries import QUERIES

#: The words, as the contract writes them.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def features_of(text, widest=2):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, widest + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, *, percent=25, least=20, buckets=10_000, widest=2, seed=7):
    """(doc_id, n_words, n_features, weight, score, rank) per row, in their order."""
    spot = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f in features_of(text, widest):
                counts[spot(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        found = [gain[spot(f)] for f in features_of(text, widest)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words_of(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((i for i, r in enumerate(out) if r[1] >= least), key=lambda i: (-out[i][4], out[i][0] is not None, out[i][0] or 0))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][5] = rank
    return [tuple(r) for r in out]


def same(got, expected):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = plain(rows, target)
    out = QUERIES["op11_target_resampling"](spark, folder)
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    same(out.collect(), [(d, n, w, s, r) for d, _, n, w, s, r in expected])
    assert sum(r[5] is not None for r in expected) > 100


def odd_rows():
    draw = random.Random(3)
    texts = ["", None, " ", "a", "a b", "A-B_c", "é É ß ẞ İ 你好 世界", "\x00a\x7fb{c}", "Ǆ x\u0085y", "x" * 200_000, "ab " * 60_000,
             *[" ".join(draw.choice(["alpha", "Beta", "42", "日本"]) for _ in range(30)) for _ in range(40)], "w " * 19, "w " * 20]
    rows = list(enumerate(texts)) + [(None, "one two " * 15), (None, "three four " * 15), (5, "alpha beta " * 12), (5, "alpha beta " * 12), (-3, "42 " * 25)]
    return rows, ["alpha beta 42", "日本 Alpha", "", None]


@pytest.mark.parametrize("widest", [1, 2, 3])
def test_odd_rows(spark, widest):
    rows, target = odd_rows()
    fields = "doc_id int, text string, row_id int, score string, rank string, n_words string, buckets int, weight int, counts int, fall int, _one int"
    docs = spark.createDataFrame([(*r, 1, "s", "r", "w", 2, 3, 4, 5, 6) for r in rows], fields).repartition(3)
    wanted = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    out = resampling.resampled(docs, wanted, percent=60, buckets=97, widest=widest)
    expected = plain(rows, target, percent=60, buckets=97, widest=widest)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    # rows that share a doc_id and a score may change places
    same([tuple(r)[:5] for r in out.collect()], [r[:5] for r in expected])
    drawn = [tuple(r) for r in out.collect() if r.rank is not None]
    assert sorted(r[5] for r in drawn) == list(range(1, len(drawn) + 1)) == list(range(1, sum(r[5] is not None for r in expected) + 1))
    key = lambda r: (-r[4], r[0] is not None, r[0] or 0)
    assert [key(r) for r in sorted(drawn, key=lambda r: r[5])] == sorted(key(r) for r in expected if r[5] is not None)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(docs, target).collect() == []
    rows = [(i, "same words again " * 10) for i in range(8)]
    same(resampling.resampled(spark.createDataFrame(rows, docs.schema), target).collect(), plain(rows, []))
    same(resampling.resampled(docs, spark.createDataFrame([(1, "x")], target.schema)).collect(), [])


@settings(max_examples=150, deadline=None)
@given(st.text(), st.integers(1, 3))
def test_windows(text, widest):
    got = [(n, lot) for n, pairs, crcs in resampling.windows(text, resampling.splitter(), widest) for lot in zip(pairs, crcs, strict=True)]
    assert sorted(c for _, (_, c) in got) == sorted(zlib.crc32(f.encode()) for f in features_of(text, widest))
    lowered = text.translate(LOWER)
    for n, ((a, b), crc) in got:
        w = words_of(lowered[a:b])
        assert len(w) == n and zlib.crc32(" ".join(w).encode()) == crc


def test_long_texts_are_split_where_no_word_is(monkeypatch):
    monkeypatch.setattr(resampling.chunks, "__defaults__", (7,))
    text = "aé 你好世界你好世界 b-c  dddddddddddddddddddd e \U0001f389\U0001f389 f" * 5
    got = [(n, p, c) for n, pairs, crcs in resampling.windows(text, resampling.splitter(), 3) for p, c in zip(pairs, crcs, strict=True)]
    assert sorted(c for _, _, c in got) == sorted(zlib.crc32(f.encode()) for f in features_of(text, 3))
    for n, (a, b), crc in got:
        assert zlib.crc32(" ".join(words_of(text[a:b])).encode()) == crc and len(words_of(text[a:b])) == n
