"""Helpers: word hashes, runs of sorted batches, the filter before joins, the shared folder."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revloom.llm import hashing, shared

TEXT = st.one_of(st.none(), st.text(alphabet=st.sampled_from(" \t\n\x0b\x1f\x85aAbéÉ#"), max_size=20))


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=8), st.sampled_from([3, 40]))
def test_words_are_split_and_lowered(texts, most):
    seen = {}
    for first, data, starts in hashing.pieces(pa.array(texts, pa.string()), most):
        hashes, begin = hashing.word_hashes(data, starts)
        for k in range(len(starts) - 1):
            words = (texts[first + k] or "").encode().lower().split()
            own = hashes[begin[k] : begin[k + 1]]
            assert len(own) == len(words)
            for w, h in zip(words, own.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_of_arrow_arrays():
    texts = pa.array(["skip", "one two", None, "three"])
    [(_, data, starts)] = list(hashing.pieces(texts.slice(1)))
    assert bytes(data) == b"one twothree" and starts.tolist() == [0, 7, 7, 12]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 2)), max_size=40), st.integers(1, 7))
def test_runs_stay_whole(rows, size):
    rows.sort()
    table = pa.table({"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int32()), "n": pa.array(range(len(rows)), pa.int64())})
    batches = table.to_batches(max_chunksize=size)
    got = [(t.column("a")[0].as_py(), t.column("b")[0].as_py(), t.column("n").to_pylist()) for t in shared.runs(iter(batches), ["a", "b"])]
    expected = [(*k, [n for n, r in enumerate(rows) if r == k]) for k in sorted(set(rows))]
    assert got == expected
    assert sum(len(t) for t in shared.whole_runs(iter(batches), ["a"])) == len(rows)


def test_filter_loses_nothing(spark):
    values = spark.range(0, 5000, 7).select(F.col("id").alias("v"))
    passed = spark.range(5000).where(shared.may_hold(values)(F.col("id"))).collect()
    got = {r["id"] for r in passed}
    assert set(range(0, 5000, 7)) <= got and len(got) < 800
    none = shared.may_hold(values.limit(0))
    assert spark.range(10).where(none(F.col("id"))).count() == 0


def test_smallest_reached():
    assert shared.smallest_reached(7, np.array([6, 3, 5, 4]), np.array([3, 1, 4, 6])).tolist() == [0, 1, 2, 1, 1, 1, 1]
    assert shared.smallest_reached(2, np.array([], int), np.array([], int)).tolist() == [0, 1]


def session(setting, master):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default), sparkContext=context)


def test_folder_is_the_named_one():
    assert shared.folder(session("hdfs://store/checks/", "yarn")).startswith("hdfs://store/checks/revloom-")
    own = shared.folder(session(None, "local[4]"))
    assert own.startswith("file:///") and own.rsplit("/", 1)[0] == shared.folder(session(None, "local[4]")).rsplit("/", 1)[0]
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            shared.folder(session(None, master))
