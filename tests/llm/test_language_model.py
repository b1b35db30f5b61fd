"""The bigram model against a plain one in dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from revloom.llm import language_model as lm
from revloom.llm.queries import QUERIES


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["</s>"]


def plain(rows):
    train = [words(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["<s>", *t], t, strict=False))
    a, by, total = Counter(w for _, w in pairs), defaultdict(lambda: [0, 0, 0]), Counter()
    for (v, _), n in pairs.items():
        by[v][min(n, 3) - 1] += 1
        total[v] += n

    def discount(values):
        t = [sum(1 for x in values if x == k) for k in (1, 2, 3, 4)]
        return lm.discounts(t)

    d, e = discount(pairs.values()), discount(a.values())
    n, size, all_a = sum(c.values()), len(c), sum(a.values())
    unseen = (sum(e[min(x, 3)] for x in a.values()) / all_a if all_a else 1) / (size + 1)

    def chance(v, w):
        low = max(a[w] - e[min(a[w], 3)], 0) / max(all_a, 1) + unseen
        if v not in total:
            return low
        k = pairs[v, w]
        return max(k - d[min(k, 3)], 0) / total[v] + sum(x * y for x, y in zip(d[1:], by[v], strict=True)) / total[v] * low

    out = []
    for i, text in rows:
        t = words(text)
        held = i is None or zlib.crc32(str(i).encode()) % 5 == 1
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (size + 1))) for w in t)
        out.append((i, held, len(t), sum(c[w] > 0 for w in t), n, base, sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *t], t, strict=False))))
    return out, chance, c


def same(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


def test_query_equals_plain_model(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op7_kneser_ney_scoring"](spark, folder).collect(), plain(rows)[0])


def test_chances_sum_to_one(spark):
    rows = [(i, t) for i, t in enumerate(["a b c a b", "b c", "c a a", "", "a b d", "e"])]
    _, chance, c = plain(rows)
    for v in ("<s>", "a", "b", "never"):
        assert sum(chance(v, w) for w in c) + chance(v, "unknown") == pytest.approx(1)


def test_odd_rows(spark):
    texts = [None, "", "  \n ", "A a a b \x00 É é", "x " * 30_000, "same words", "same words", "\x1f x\x0by"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same words"), (5, "same words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS held_out", "1 AS score")
    same(lm.scored(df.repartition(3)).collect(), plain(rows)[0])


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.scored(empty).collect() == []
    rows = [(None, "a b")]
    got = lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same(got, plain(rows)[0])
    assert got[0]["score"] == 0 and got[0]["train_tokens"] == 0


def test_discounts():
    assert lm.discounts([0, 0, 0, 0]).tolist() == [0, 0.5, 1.0, 1.5]
    y = 10 / (10 + 2 * 4)
    assert lm.discounts([10, 4, 2, 1]).tolist() == pytest.approx([0, 1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5])


def test_only_a_mounted_folder_can_be_mapped():
    model = lm.Model("hdfs://store/x", 4, {lm.PAIRS: {}, lm.WORDS: {}}, [0] * 4, [0] * 8, lm.Routes(np.empty(0, np.int64)))
    with pytest.raises(ValueError, match="mounted"):
        lm._Arrays(model)


def test_frequent_words_are_spread(spark, monkeypatch):
    """Every text begins with one word that all others follow: its pairs are in all ranges, and the model is the same."""
    monkeypatch.setattr(lm, "SAMPLED", 2)
    rows = [(i, " ".join(f"the w{(i * 31 + k) % 4000}" for k in range(40))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    texts = df.select("text")
    routes = lm.Routes(lm.frequent_words(texts, 12))
    assert 1 < len(routes.hot) <= 2 * 12 + 1
    sent = texts.mapInArrow(lm._count_pairs(12, routes, np.arange(12)), "range int, to int, contexts binary, sizes binary, words binary, counts binary")
    sizes = sorted(r[0] for r in sent.groupBy("range").agg(F.sum(F.length("words"))).select("sum(length(words))").collect())
    assert len(sizes) == 12 and sizes[-1] < 3 * sum(sizes) / 12
    together = texts.mapInArrow(lm._count_pairs(12, lm.Routes(np.empty(0, np.int64)), np.arange(12)), "range int, to int, contexts binary, sizes binary, words binary, counts binary")
    assert together.groupBy("range").agg(F.sum(F.length("words")).alias("n")).agg(F.max("n")).first()[0] > 4 * sum(sizes) / 12
    same(lm.scored(df).collect(), plain(rows)[0])


def test_counts_beyond_32_bits(tmp_path):
    """A pair that is more frequent than 32 bits can say keeps its count."""
    import pyarrow as pa

    def packed(n):
        before, words = np.array([5], "<u8"), np.array([7, 9], "<u8")
        counts = np.array([n, 3], "<u4")
        return {"range": 0, "contexts": before.tobytes(), "sizes": np.array([2], "<u4").tobytes(), "words": words.tobytes(), "counts": counts.tobytes()}

    schema = pa.schema([("range", pa.int32()), *[(c, pa.binary()) for c in ("contexts", "sizes", "words", "counts")]])
    batch = pa.RecordBatch.from_pylist([packed(2**32 - 1)] * 3, schema)
    out = [r for b in lm._merge_pairs(str(tmp_path), 1, np.arange(1))(iter([batch])) for r in b.to_pylist()]
    files = {lm.PAIRS: {0: next((r["file"], r["size"]) for r in out if r["kind"] == lm.PAIRS)}, lm.WORDS: {}}
    model = lm.Model(str(tmp_path), 1, files, [0] * 4, [0] * 8, lm.Routes(np.empty(0, np.int64)))
    keys = lm.mix(lm.mix(np.array([5, 5, 5], np.uint64)) + np.array([7, 9, 8], np.uint64))
    assert lm._Arrays(model).find(lm.PAIRS, keys, keys)[0].tolist() == [3 * (2**32 - 1), 9, 0]


@pytest.mark.parametrize("parts", [1, 4, 32, 211])
def test_a_range_per_partition(spark, parts):
    keys = lm.even_keys(spark, parts)
    df = spark.createDataFrame([(int(k),) for k in keys], "to int").repartition(parts, "to")
    assert df.select(F.spark_partition_id()).distinct().count() == parts
