"""The pipeline: its stages, what each keeps, and the rows at its end."""

import zlib

import numpy as np
import public_tokenizers
from test_native import lines_plain, plan_plain
from test_ngram_join import plain
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from revloom.llm import quality

FOLDER = "/root/testdata/sf0.001"


def test_registered(spark):
    names = entry.queries()
    assert names["pipeline"] is cp.run
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "pipeline" not in entry.oracle_sql() and cp.ORACLE_SQL is None


def test_rows_equal_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.learned(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    import pyarrow as pa

    rows = [r.asDict() for r in docs.collect()]
    score = model.score(quality.features(pa.array([r["text"] for r in rows])))
    rows = [r for r, s in zip(rows, score, strict=True) if s >= 0.3]

    cut = {d: (t, gone) for d, t, _, gone in lines_plain([(r["doc_id"], r["text"], r["source"]) for r in rows], cp.MIN_SITES)}
    rows = [r | {"text": cut[r["doc_id"]][0]} for r in rows if not cut[r["doc_id"]][1] or cut[r["doc_id"]][0].strip(" ")]
    kept = {d for d, n, c, _ in plain([(r["doc_id"], r["text"]) for r in rows], 5, 80) if not n or d == c}
    rows = [r for r in rows if r["doc_id"] in kept]
    times = {}
    for d, _, _ in plan_plain([(r["doc_id"], r["text"], r["source"]) for r in rows], repeats=cp.MAX_REPEATS):
        times[d] = times.get(d, 0) + 1
    assert set(times) == kept

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    expected = {}
    for r in rows:
        ids = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 0], dtype="<u4")
        expected[r["doc_id"]] = (len(ids), times[r["doc_id"]], ids)
    got = {}
    pieces = cp.run(spark, FOLDER).collect()
    for p in pieces:
        n, _, ids = expected[p["doc_id"]]
        assert p["doc_tokens"] == n and p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"]
    assert got == {d: n * k for d, (n, k, _) in expected.items()}
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert all(sum(n for _, n in x) <= 1024 and sorted(x)[0][0] == 0 for x in sequences.values())


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, "en", None, None), (2, "", None, "a", 0), (None, "some words of a document here", "en", "b", 3), (4, "x " * 20_000, "en", "c", 1), (5, "same text of six words here", "en", "d", 1),
            (5, "same text of six words here", "en", "d", 1), (6, "same text of six words here", "en", "e", 1)]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, signature string")
    for name, stage in cp.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, FOLDER)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() >= 0 if given is docs else out.count() == 0
    kept = cp.without_near_copies(spark, docs, FOLDER).where("doc_id IN (5, 6)").collect()
    assert len(kept) == 1 and kept[0]["doc_id"] == 5
