"""Packing by exact complements, against the tokenizer library and bounds on the number of sequences."""

import random
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revloom.llm import exact_packing as ep
from revloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


def first_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= x), None)
        if at is None:
            rooms.append(capacity - x)
        else:
            rooms[at] -= x
    return len(rooms)


def check(rows, pieces, capacity):
    """rows: (doc_id, text), doc_ids distinct; returns the lengths of the sequences."""
    of, sequences = {}, {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert set(of) == {d for d, _ in rows}
    for doc_id, text in rows:
        ids, at = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4"), 0
        mine = sorted(of[doc_id], key=lambda p: p["start"])
        assert [p["piece"] for p in mine] == list(range(len(mine)))
        assert len(mine) == -(-len(ids) // capacity) and all(p["length"] == capacity for p in mine[1:])
        for p in mine:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        sizes.append(at)
    return sizes


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op13_exact_complement_packing"](spark, folder)
    longs = dict.fromkeys(["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"], "bigint")
    assert dict(out.dtypes) == {**longs, "piece": "int"}
    pieces = out.collect()
    sizes = check(rows, pieces, 2048)
    assert len(sizes) <= -(-sum(sizes) // 2048) + 1, "hardly more sequences than the tokens need"
    assert len(sizes) <= first_fit_decreasing([p["length"] for p in pieces], 2048)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_odd_rows(spark, capacity):
    draw = random.Random(1)
    odd = ["", None, " ", "  a  b ", "\n\n", "<|endoftext|> x", "don't  stop", "é ß 你好 世界 🎉‍ x", "\x00 \x1f \x85 x", "word " * 3000, "x" * 500, "".join(draw.choice(" ab\n\t'sé1.") for _ in range(5000))]
    rows = [*enumerate(odd), (None, "no number"), *[(100 + i, "a b c " * draw.randrange(9)) for i in range(200)]]
    fields = "doc_id int, text string, part string, nth string, ids string, length string, offset string, at string, first string"
    docs = spark.createDataFrame([(*r, *"abcdefg") for r in rows], fields).repartition(5)
    out = ep.packed(docs, PATH, capacity=capacity)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = out.collect()
    sizes = check(rows, pieces, capacity)
    assert len(sizes) <= first_fit_decreasing([p["length"] for p in pieces], capacity)
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in pieces)
    assert {p["sequence_id"] for p in pieces} == set(range(len(sizes)))


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "same text")] * 50, "doc_id long, text string").repartition(3)
    pieces = ep.packed(docs, PATH, capacity=8).collect()
    assert len(pieces) == 50 and {(p["piece"], p["start"], p["ids_crc32"]) for p in pieces} == {(0, 0, pieces[0]["ids_crc32"])}
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == 50
    assert ep.packed(docs.limit(0), PATH).collect() == []
    with pytest.raises(ValueError, match="positive"):
        ep.packed(docs, PATH, capacity=0)


def test_ids_do_not_move_where_they_are_not_read(spark):
    docs = spark.createDataFrame([(i, "text " * i) for i in range(30)], "doc_id long, text string")
    plan = ep.packed(docs, PATH).drop("ids")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and not any("ids#" in line for line in scans)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30)))))
def test_plan_uses_each_piece_once(case):
    capacity, counts = case
    plan = ep.planned(counts, capacity)
    used = Counter()
    for times, held in plan:
        assert times > 0 and sum(held) <= capacity
        for x in held:
            used[x] += times
    assert used == Counter(counts)
    places, at = ep.Places(plan), {}
    for length, n in counts.items():
        for number in range(n):
            sequence, offset = places.find(np.array([length]), np.array([number]))
            at.setdefault(int(sequence[0]), []).append((int(offset[0]), length))
    assert set(at) == set(range(places.sequences))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=13, max_size=13), st.lists(st.integers(1, 12), max_size=12))
def test_sums_against_all_combinations(counts, taken):
    """What the index says stays right while pieces are taken."""
    left = [0, *counts[1:]]
    sums = ep.Sums(left)
    for x in [0, *taken]:
        left[x] -= 1 if left[x] else 0
        for gap in range(1, 13):
            exists = any(sum(c) == gap and all(left[y] >= n for y, n in Counter(c).items()) for k in (1, 2, 3) for c in combinations_with_replacement(range(1, gap + 1), k))
            found = sums.filling(gap)
            assert (found is not None) == exists
            assert found is None or (sum(found) == gap and all(left[y] >= n for y, n in Counter(found).items()))


def test_near_the_fewest_sequences():
    draw = random.Random(2)
    for capacity, lengths in [(2048, [min(2048, int(draw.lognormvariate(5.5, 1.2)) + 1) for _ in range(20_000)]), (2048, [draw.randint(600, 1400) for _ in range(3000)]), (100, [draw.choice([34, 33, 51, 49, 26, 7]) for _ in range(5000)])]:
        sequences = sum(times for times, _ in ep.planned(Counter(lengths), capacity))
        floor = max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))
        assert sequences <= first_fit_decreasing(lengths, capacity) and (sequences <= 1.01 * floor or capacity != 2048 or min(lengths) >= 600)
