"""Line dedup and source mixing: SQL agreement, plain versions, odd rows, and no Python on their main path."""

import hashlib
import math
from collections import defaultdict

import pytest
from oracle import compare, connect

from revloom.llm import line_dedup, mixing
from revloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string, n_lines int, copy string"


@pytest.mark.parametrize("name", ["op4_line_dedup", "op10_temperature_mixing", "op6_warc_normaliser"])
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), SQL[name], connect(FOLDER)) is None


@pytest.mark.parametrize("name", ["op4_line_dedup", "op10_temperature_mixing"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def docs(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, "z") for r in rows], DOCS)


def lines_plain(rows, least):
    sites, first = defaultdict(set), {}
    for doc_id, text, source in rows:
        for k, line in enumerate([] if text is None else text.split("\n")):
            if line.strip(" "):
                sites[line].add(source)
                place = (doc_id is None, doc_id or 0, k)
                first[line] = min(first.get(line, place), place)
    out = []
    for doc_id, text, source in rows:
        lines = [] if text is None else text.split("\n")
        keep = [x for k, x in enumerate(lines) if not x.strip(" ") or len(sites[x] - {None}) < least or first[x] == (doc_id is None, doc_id or 0, k)]
        out.append((doc_id, None if text is None else "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def test_lines_equal_plain_version(spark):
    rows = [(i, f"own {i}\nmany\n\n{'some' if i % 2 else 'few' if i < 4 else 'none of it'}\nmany", f"s{i % 12}") for i in range(60)]
    rows += [(100, None, "s1"), (101, "", "s2"), (102, "many", None), (None, "many\nsome", "s3"), (None, None, None), (7, "many\nother", "s4"), (0, rows[0][1], "s0"), (103, "many", "s5")]
    rows += [(104, "\n".join(["many", "x"] * 5_000), "s6")]
    for least in (1, 3, 6, 12, 13):
        got = line_dedup.without_spread_lines(docs(spark, rows).drop("n_lines").repartition(3), least)
        assert got.columns == ["doc_id", "text", "source", "lang", "copy", "n_lines", "n_removed"]
        key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in (r[0], r[1] or "", *r[2:]))
        assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect()), key=key) == sorted(lines_plain(rows, least), key=key)


def test_sketches_and_exact_counts_meet(spark):
    """Lines on 40 to 60 sites against a threshold of 50: those near it are counted exactly."""
    rows = [(1000 * n + s, f"line {n}", f"site {s}") for n in range(40, 61) for s in range(n)]
    spread = line_dedup.spread_lines(line_dedup.line_table(docs(spark, rows)), 50)
    assert spread.count() == 11


def test_lines_of_no_documents(spark):
    assert line_dedup.without_spread_lines(docs(spark, [])).collect() == []


def plan_plain(rows, entropy=None, repeats=None, budget=None, seed=0):
    words = lambda t: len(t.encode().split()) if t else 0
    by = defaultdict(list)
    for doc_id, text, source in rows:
        by[source].append((doc_id, words(text)))
    total = sum(n for x in by.values() for _, n in x)
    sizes = {s: sum(n for _, n in x) for s, x in by.items()}
    p = {s: n / total for s, n in sizes.items() if n}

    def holds(k):
        w = [x ** (k / 2**20) for x in p.values()]
        if entropy is not None:
            return math.log(sum(w)) - sum(x * math.log(x) for x in w) / sum(w) >= entropy * math.log(len(w))
        r = [x / y for x, y in zip(w, p.values(), strict=True)]
        return max(r) / min(r) <= repeats

    lo, hi = 0, 2**20
    if entropy is not None:
        if not holds(hi):
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if holds(mid) else (lo, mid)
            hi = lo
        a = hi / 2**20
    else:
        if holds(lo):
            hi = lo
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if holds(mid) else (mid, hi)
        a = hi / 2**20
    w = {s: x**a for s, x in p.items()}
    out = []
    for s, docs_of in by.items():
        if s not in p:
            out += [(d, s, 0) for d, _ in docs_of]
            continue
        weight = round(w[s] / sum(w.values()), 12)
        spend = budget * weight if budget is not None else total * max(p[x] / w[x] for x in p) * w[s]
        quota = math.floor(spend + 0.5)
        copies, rest = divmod(quota, sizes[s])
        name = lambda d: "" if d is None else str(d)
        key = lambda d: hashlib.md5(f"{seed}|{copies}|{name(d)}".encode()).hexdigest() + "|" + name(d)  # noqa: B023, E731
        units = defaultdict(int)
        for d, n in docs_of:
            units[key(d)] += n
        upto, taken = 0, set()
        for k in sorted(units):
            upto += units[k]
            if upto <= rest and rest:
                taken.add(k)
        for d, _ in docs_of:
            out += [(d, s, c) for c in range(copies + (key(d) in taken))]
    return out


ROWS = [(i, "word " * (1 + i % 7), f"s{min(i % 11, 3)}") for i in range(300)] + [
    (None, "a b c", "s1"), (None, "d", "s1"), (5, "twice the same", "s2"), (5, "twice the same", "s2"), (400, None, "s0"), (401, "", "empty"), (402, None, "empty"), (403, "no source here", None),
]


@pytest.mark.parametrize("how", [{"target_entropy": 0.9}, {"target_entropy": 0.999, "budget": 500}, {"target_entropy": 0.1}, {"max_repeats": 2.0}, {"max_repeats": 1.0}, {"max_repeats": 1e9},
                                 {"target_entropy": 0.99, "budget": 50_000}])
def test_mixture_equals_plain_version(spark, how):
    got = mixing.mixed(docs(spark, ROWS).drop("copy"), seed=3, **how)
    assert got.columns == ["doc_id", "text", "source", "lang", "n_lines", "copy", "place"]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    plain = plan_plain(ROWS, how.get("target_entropy"), how.get("max_repeats"), how.get("budget"), 3)
    assert sorted((tuple(r) for r in got.select("doc_id", "source", "copy").collect()), key=key) == sorted(plain, key=key)


def test_no_row_is_lost_without_a_budget(spark):
    got = mixing.mixed(docs(spark, ROWS).drop("copy"), max_repeats=2.0)
    first = got.where("copy = 0")
    assert first.count() == len(ROWS)
    assert got.agg({"copy": "max"}).first()[0] <= 1


def test_mixture_of_nothing(spark):
    assert mixing.mixed(docs(spark, []).drop("copy"), target_entropy=0.9).collect() == []
    only_empty = [(1, "", "a"), (2, None, "b")]
    assert mixing.mixed(docs(spark, only_empty).drop("copy"), max_repeats=2.0).count() == 2
    with pytest.raises(ValueError):
        mixing.mixed(docs(spark, []).drop("copy"))
