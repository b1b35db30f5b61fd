"""Packing against the tokenizer library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revloom.llm import packing
from revloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


@pytest.fixture(scope="module")
def library():
    return lambda text: LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(rows, pieces, library, capacity=1024):
    """rows: (doc_id, text) of distinct doc_ids; pieces with crc32 of ids."""
    of, sequences = {}, {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert set(of) == {d for d, _ in rows}
    for doc_id, text in rows:
        ids, at = np.array([*library(text), 0], dtype="<u4"), 0
        for p in sorted(of[doc_id], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert 0 < p["length"] <= capacity and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and at & (at - 1) == 0, "padded"


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op3_cost_balanced_packing"](spark, folder).collect(), library)


def test_odd_rows(spark, library):
    draw = random.Random(1)
    odd = ["", None, " ", "  a  b ", "\n\n", "a\tb \n c", "<|endoftext|> x", "don't  stop", "é ß 你好 世界 🎉‍ x", "a  b", " lead", "trail ", "\x00 \x1f \x85 x",
           "word " * 40_000, "x" * 3000, "".join(draw.choice(" ab\n\t'sé1.") for _ in range(20_000))]
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "no number")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, start int, ids string")
    pieces = packing.packed(df.repartition(3), PATH)
    check(rows, pieces.selectExpr("*", "crc32(ids) AS ids_crc32").collect(), library)
    assert packing.packed(df.limit(0), PATH).collect() == []
    twice = packing.packed(df.where("doc_id = 8").union(df.where("doc_id = 8")), PATH, capacity=4).collect()
    assert len({(p["start"], p["sequence_id"]) for p in twice}) == len(twice) and len({p["start"] for p in twice if p["start"] == 0}) == 1
    with pytest.raises(ValueError):
        packing.packed(df, PATH, capacity=1000)


def test_blocks_follow_one_another(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_SEQUENCES", 4)
    monkeypatch.setattr(packing, "SENT_BYTES", 100)
    draw = random.Random(2)
    rows = [(i, " ".join(f"word{draw.randrange(99)}" for _ in range(draw.randrange(1, 90)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    check(rows, packing.packed(df, PATH, capacity=64).selectExpr("*", "crc32(ids) AS ids_crc32").collect(), library, 64)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'  a1.é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_word_by_word_is_the_whole_text(text):
    assert packing._encoder(PATH).ids(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_between_words(library, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_CHARS", 7)
    encoder = packing._encoder(PATH)
    for text in ("one two  three\n four five", "abcdefghijklmnop qrs", "a b c d e f g h i j k", "  x   y   z        w"):
        assert encoder.ids(text).tolist() == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=40), st.integers(1, 12))
def test_balance_fills_sequences(lengths, n):
    rooms = [16] * min(n, sum(lengths) // 16)
    parts = packing.balance(lengths, rooms)
    assert [sum(b - a for _, a, b in x) for x in parts] == rooms
    taken = {}
    for x in parts:
        for piece, a, b in x:
            taken.setdefault(piece, []).append((a, b))
    for piece, spans in taken.items():
        spans.sort()
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False)) and spans[-1][1] <= lengths[piece]


def test_costs_are_balanced():
    lengths = [600, 500, 400, 300, 300, 200, 200, 100, 100, 372]
    costs = [sum(packing.cost(b - a) for _, a, b in x) for x in packing.balance(lengths, [1024] * 3)]
    assert max(costs) < 1.15 * min(costs)
