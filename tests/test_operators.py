"""Operators on small frames, including hot keys, NULL keys and the other way beyond a size check."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.operators import aggregates, changes, dims, joins, reshape, scan, schema, text_index, windows


def test_clean_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `a b` int")
    with pytest.raises(ValueError, match="both clean to"):
        schema.clean_names(df)


def test_flatten_and_nested_text(spark):
    df = spark.createDataFrame([(1, (2, (3,)), [4])], "id int, a struct<b:int, c:struct<d:int>>, l array<int>")
    assert schema.flatten(df).columns == ["id", "a.b", "a.c.d", "l"]
    assert schema.nested_to_json(df).columns == ["id", "_a", "_l"]


def test_joins_on_null_keys(spark, rows):
    a = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.absent_from(a, b, ["k"])) == [(3,)]
    assert rows(joins.present_in(a, b, ["k"])) == [(1,), (None,)]
    assert rows(joins.with_presence(a, b, ("k", "k"), "x")) == [(1, True), (3, False), (None, False)]


def test_update_from(spark, rows):
    t = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "id int, v string")
    s = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, None, 1), (None, "n", 1)], "k int, v string, o int")
    assert rows(joins.update_from(t, s, [("id", "k")], {"v": "v"}, [F.col("o")])) == [(1, "a"), (2, None), (None, "old")]


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("ranges", [None, 1, 3])
def test_floor_tier(spark, rows, ranges):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (10.0,), (99.0,), (None,), (NAN,), (INF,), (-INF,)], "v double")
    tiers = spark.createDataFrame([(50.0,), (0.0,), (10.0,), (None,), (50.0,)], "t double")
    expected = [(-1.0, 0.0), (0.0, 0.0), (10.0, 10.0), (5.0, 0.0), (99.0, 50.0), (None, 0.0), (NAN, 50.0), (INF, 50.0), (-INF, 0.0)]
    assert list(map(repr, rows(joins.floor_tier(df, tiers, "v", "t", ranges)))) == sorted(map(repr, expected))
    odd = tiers.unionByName(spark.createDataFrame([(NAN,), (INF,), (-INF,)], "t double"))
    found = {repr(r.v): repr(r.t) for r in joins.floor_tier(df, odd, "v", "t", ranges).collect()}
    assert found == {"-1.0": "-inf", "0.0": "0.0", "5.0": "0.0", "10.0": "10.0", "99.0": "50.0", "None": "-inf", "nan": "nan", "inf": "inf", "-inf": "-inf"}


@pytest.mark.parametrize("kind", ["bigint", "decimal(25,0)"])
def test_floor_tier_beyond_doubles(spark, rows, kind):
    df = spark.createDataFrame([(2**53 + i,) for i in range(4)], "v bigint").selectExpr(f"CAST(v AS {kind}) AS v")
    tiers = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**53 + 3,)], "t bigint").selectExpr(f"CAST(t AS {kind}) AS t")
    assert [(int(v), int(t)) for v, t in rows(joins.floor_tier(df, tiers, "v", "t"))] == [(2**53, 2**53), (2**53 + 1, 2**53 + 1), (2**53 + 2, 2**53 + 1), (2**53 + 3, 2**53 + 3)]


def test_floor_tier_with_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.col("id") / 10).alias("v"))
    tiers = spark.range(500).select((F.col("id") * 0.7).alias("t"))
    got = {(r.v, r.t) for r in joins.floor_tier(df, tiers, "v", "t", 16).collect()}
    steps = sorted(r[0] for r in tiers.collect())
    assert got == {(r.v, max(s for s in steps if s <= r.v)) for r in df.collect()}


def test_floor_without_tiers(spark, rows):
    df = spark.createDataFrame([(1.0,)], "v double")
    assert rows(joins.floor_tier(df, spark.createDataFrame([], "t double"), "v", "t")) == [(1.0, None)]


def test_next_within(spark, rows):
    d = dt.date
    deals = spark.createDataFrame([(1, "a", d(2024, 1, 1)), (2, "a", d(2024, 3, 1)), (3, "b", d(2024, 1, 1)), (4, None, d(2024, 1, 1))], "id int, k string, d date")
    events = spark.createDataFrame(
        [(20, "a", d(2024, 3, 1)), (19, "a", d(2024, 3, 1)), (30, "a", d(2025, 3, 1)), (40, "b", d(2024, 1, 1)), (41, "b", d(2025, 1, 1))], "e int, k string, d date"
    )
    out = joins.next_within(deals, events, "k", "d", "d", "e", 12, "nxt").select("id", "nxt")
    assert rows(out) == [(1, 19), (2, None), (3, None), (4, None)]


def test_containing(spark, rows):
    texts = spark.createDataFrame([(1, "setup-ab12cd.exe"), (2, "x-ab12cd-.exe ab12cd"), (3, "--a.b(c)-zz"), (4, None), (5, "ab"), (6, "x😀abc-😀bcdef.")], "k int, t string")
    tokens = spark.createDataFrame([("ab12cd",), ("b(c)",), ("a.b",), ("zzz",), (None,), ("",), ("setup-ab12cd.exe ",), ("?abc",), ("😀abc",), ("😀bcdef",)], "token string")
    found = rows(joins.containing(texts, "k", "t", tokens, "token"))
    assert found == [("a.b", 3), ("ab12cd", 1), ("b(c)", 3), ("😀abc", 6), ("😀bcdef", 6)]


def test_containing_looks_into_each_word_once(spark, rows, monkeypatch):
    """The words of many texts are cut into pieces once, not the texts; copies of a row and tokens with white space count as ever."""
    texts = spark.createDataFrame([(k, f"alpha beta-{k % 3} gamma\tdelta") for k in range(60)] + [(7, "alpha beta-1 gamma\tdelta"), (None, "alpha")], "k int, t string")
    tokens = spark.createDataFrame([("lph",), ("a-2",), ("gamma\td",), ("a beta-0 g",), ("a  b",), ("\t",), ("delta.",)], "token string")
    cut = []
    real = joins._by_pieces
    monkeypatch.setattr(joins, "_by_pieces", lambda df, *rest: cut.append(df) or real(df, *rest))
    found = rows(joins.containing(texts, "k", "t", tokens, "token"))
    assert cut[0].count() == 6
    want = [(x, k) for k in [*range(60), 7] for x in ("lph", "a-2", "gamma\td", "a beta-0 g", "\t") if x in f"alpha beta-{k % 3} gamma\tdelta"]
    assert found == sorted(want, key=repr)


def shuffled(plan):
    """Rows that the exchanges of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = plan.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled(plan.children().apply(k)) for k in range(plan.children().size()))


def test_containing_moves_no_row_per_word_of_a_text(spark):
    """Words travel once per block of texts, and pairs not at all: few rows for many texts with the same words."""
    words = [F.concat(F.lit("word"), (F.col("id") * n) % 40) for n in range(1, 30)]
    texts = spark.range(0, 3000, 1, 4).select(F.col("id").alias("k"), F.concat_ws(" ", F.lit("same"), *words).alias("t"))
    tokens = spark.createDataFrame([("ord0",), ("am",), ("ame",), ("word40",), ("rd39",)], "token string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        found = joins.containing(texts, "k", "t", tokens, "token", frame=(" ", " "))
        got = found.collect()
    finally:
        spark.conf.unset(name)
    held = {r.k: r.t for r in texts.collect()}
    assert sorted(map(tuple, got)) == sorted((x.token, k) for x in tokens.collect() for k, t in held.items() if len(x.token) != 6 and x.token in t)
    assert len(got) > 8000 and 0 < shuffled(found._jdf.queryExecution().executedPlan()) < 3000


@pytest.mark.parametrize(("most", "frame"), [(1 << 16, ("-", ".")), (7, (" ", " ")), (1, ("-", "-"))])
def test_containing_in_blocks_of_any_size(spark, rows, monkeypatch, most, frame):
    """All kinds of white space and tokens, null and repeated keys, copies of rows: as a search in each text, however texts are put in blocks."""
    monkeypatch.setattr(text_index, "BLOCK_TEXTS", most)
    monkeypatch.setattr(joins, "CUT_CHARS", 50)
    draw = random.Random(5)
    parts = ["a", "b", "ab-cd", "sixsix", "-sixsix.", "word", "😀x", "ñandú", " ", " ", "\t", "\n", "\x0b", "\x1c", "\xa0", "\u3000", "-", "."]
    given = [(draw.choice([None, "k1", "k2", f"k{n}"]), draw.choice(["", None, *["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(6)]])) for n in range(60)]
    tokens = ["a", "ab", "ba", " ", " a", "\t", "sixsix", "wordsi", "ab-cda", "d😀x", "😀", "ord", "xsix", "a\xa0b", "word\xa0", "word\x1cw", "x\u3000wo", "b word", "ñandú", "ndúñan", "dúñandúñ", "", None, "a"]
    texts = spark.createDataFrame(given + given[:9], "k string, t string").repartition(3)
    found = rows(joins.containing(texts, "k", "t", spark.createDataFrame([(x,) for x in tokens], "token string"), "token", frame=frame))
    held = [(x, k, frame[0] + x + frame[1] if len(x) == 6 else x, t) for x in set(tokens) - {"", None} for k, t in given + given[:9] if k is not None and t is not None]
    assert found == sorted(((x, k) for x, k, y, t in held if y in t), key=repr) and len({x for x, _ in found}) > 8


def test_join_all_deals_the_pairs_of_a_key(spark, rows, monkeypatch):
    monkeypatch.setattr(joins, "SHARE_ROWS", 50)
    one = spark.range(0, 700, 1, 4).select(F.when(F.col("id") < 690, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("a"))
    two = spark.range(0, 650, 1, 4).select(F.lit("hot").alias("k"), F.col("id").alias("b")).unionByName(spark.createDataFrame([("695", 1), ("695", 2), ("no", 3)], "k string, b long"))
    out = joins.join_all(one, two, "k")
    assert out.columns == ["k", "a", "b"] and rows(out.where("k <> 'hot'")) == [("695", 695, 1), ("695", 695, 2)]
    per_task = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(per_task) == out.distinct().count() == 690 * 650 + 2 and max(per_task) < 0.1 * sum(per_task)


def test_id_map_is_the_chained_full_join(spark, rows):
    def side(data):
        return spark.createDataFrame(data, "id string, account string")

    a = [("1", "x"), ("1", None), ("2", None), ("2", "bad"), ("3", "y"), ("bad", "q"), ("6", None), (None, "n")]
    c = [("1", "z"), ("2", None), ("4", None), ("5", "w"), ("5", None), ("bad2", "k")]
    u = [("1", "u1"), ("2", "u2"), ("2", None), ("3", "u3"), ("5", "u5"), ("7", None), ("8", "u8"), ("6", "u6")]
    got = rows(joins.id_account_map(side(a), side(c), side(u), bad_ids=["bad"], bad_accounts=["bad"]))
    sql = spark.sql(
        """SELECT DISTINCT coalesce(CASE WHEN a.id = 'bad' THEN NULL ELSE a.id END, c.id, u.id) AS id,
                  coalesce(CASE WHEN a.account = 'bad' THEN NULL ELSE a.account END, c.account, u.account) AS account
           FROM {a} a FULL JOIN {c} c ON a.id = c.id FULL JOIN (SELECT DISTINCT * FROM {u}) u ON u.id = c.id
           WHERE coalesce(a.id, c.id, u.id) IS NOT NULL""",
        a=side(a), c=side(c), u=side(u),
    )
    assert got == rows(sql)


def test_missing_combinations(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    got = spark.createDataFrame([(1, "x", 0), (1, None, 1), (None, "y", 2), (9, "x", 0), (1, "x", 77)], "g int, a string, n int")
    lists = {"a": spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "a string"), "n": spark.range(3).selectExpr("CAST(id AS int) AS n")}
    out = rows(joins.missing_combinations(df, ["k"], got, [("k", "g")], lists))
    every = {(k, a, n) for k in (1, 2, None) for a in ("x", "y", None) for n in range(3)}
    assert out == sorted(every - {(1, "x", 0), (1, None, 1), (None, "y", 2)}, key=repr)


def test_missing_combinations_of_long_lists(spark):
    """A million combinations per key, a key at a time in words of 64."""
    names = spark.range(10_000).select(F.concat(F.lit("n"), F.col("id")).alias("a"))
    years = spark.range(100).select(F.col("id").cast("int").alias("n"))
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    # key 1 lacks a few, key 2 has what no list has, key 3 has all but one name
    full = names.crossJoin(years)
    got = full.where("NOT (a IN ('n7', 'n9999') AND n % 50 = 3)").withColumn("g", F.lit(1)).unionByName(full.where("a <> 'n42'").withColumn("g", F.lit(3)))
    got = got.unionByName(spark.createDataFrame([("none", 5, 2), ("n1", 500, 2)], "a string, n int, g int"))
    out = joins.missing_combinations(df, ["k"], got, [("k", "g")], {"a": names, "n": years})
    assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {1: 4, 2: 1_000_000, 3: 100}
    assert sorted((r.a, r.n) for r in out.where("k = 1").collect()) == [("n7", 3), ("n7", 53), ("n9999", 3), ("n9999", 53)]
    assert out.where("k = 2").select("a", "n").exceptAll(full).isEmpty()


def test_missing_combinations_with_a_list_per_key(spark, rows):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, "none"), (4, None)], "k int, t string")
    names = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", None), ("q", "y"), (None, "z")], "t string, a string")
    got = spark.createDataFrame([(1, "p", "x", 0), (2, "q", None, 1), (2, "p", "x", 1), (1, "p", "z", 0)], "g int, t string, a string, n int")
    out = rows(joins.missing_combinations(df, ["k", "t"], got, [("k", "g"), ("t", "t")], {"a": names, "n": spark.range(2).selectExpr("CAST(id AS int) AS n")}))
    assert out == sorted([(1, "p", "x", 1), (1, "p", "y", 0), (1, "p", "y", 1), (2, "q", None, 0), (2, "q", "y", 0), (2, "q", "y", 1)], key=repr)


def test_winnowing(spark):
    """Few pieces per character, and every token of eight characters or more shares one with a text that holds it."""
    draw = random.Random(9)
    texts = ["".join(draw.choice("abcdefgh ijkléß你\U0001f389") for _ in range(3000)) for _ in range(4)] + ["", "ab", "aaaaaaaaaaaaaaaaaaaaaa"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("p", joins.winnowed("t", *joins.PIECES[8]))
    cut = {r.k: set(r.p) for r in df.collect()}
    assert sum(len(cut[k]) for k in range(4)) < 0.5 * sum(map(len, texts[:4])) and cut[4] == cut[5] == set()
    spots = [(k, at, draw.randint(8, 20)) for k in (0, 1, 2, 3, 6) for at in range(0, len(texts[k]) - 20, 61)]
    tokens = spark.createDataFrame([(k, texts[k][at : at + n]) for k, at, n in spots], "k int, t string").withColumn("p", joins.winnowed("t", *joins.PIECES[8]))
    for r in tokens.collect():
        assert r.p and set(r.p) <= cut[r.k]


def test_joined_text(spark):
    data = [("hot", f"{i:06d}") for i in range(150_000)] + [("hot", "dup")] * 57 + [("cold", "b"), ("cold", "a"), ("cold", None), ("none", None), (None, "n")]
    df = spark.createDataFrame(data, "k string, v string")
    whole = {r.k: tuple(r)[1:] for r in aggregates.joined_text(df, ["k"], "v", "t", chunk_bytes=1 << 30).collect()}
    text = ",".join(sorted(v for k, v in data if k == "hot"))
    assert whole == {"cold": (0, "a,b", 3), "none": (0, None, 1), None: (0, "n", 1), "hot": (0, text, 150_057)}
    out = aggregates.joined_text(df, ["k"], "v", "t", chunk_bytes=100).collect()
    hot = sorted((r.part, r.t, r["count"]) for r in out if r.k == "hot")
    assert ",".join(t for _, t, _ in hot) == text and all(len(t) <= 107 and n == 150_057 for _, t, n in hot)
    assert [p for p, _, _ in hot] == list(range(len(hot)))
    assert sorted((r.k, r.t, r["count"]) for r in out if r.k == "none") == [("none", None, 1)]


def test_joined_text_of_long_and_repeated_values(spark):
    data = [("a", "é" * 30), ("a", "b"), ("a", "b"), ("a", "c" * 500), ("a", "")] + [("a", "ab")] * 1000
    df = spark.createDataFrame(data, "k string, v string")
    out = sorted((r.part, r.t) for r in aggregates.joined_text(df, ["k"], "v", "t", sep=", ", chunk_bytes=64).collect())
    assert ", ".join(t for _, t in out) == ", ".join(sorted(v for _, v in data))
    once = sorted((r.part, r.t) for r in aggregates.joined_text(df, ["k"], "v", "t", unique=True, chunk_bytes=64).collect())
    assert ",".join(t for _, t in once) == ",".join(sorted({v for _, v in data}))


@pytest.mark.parametrize("ranges", [None, 1, 7, 64])
def test_scans(spark, ranges):
    draw = random.Random(5)
    data = [(draw.choice(["a", "b", None]) if i % 3 else "hot", i // 500, i, draw.choice([None, 1, 5, -3])) for i in range(4000)]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "s string, d long, i long, v long").repartition(5)
    ordered = sorted(data, key=lambda r: ((r[0] is not None, r[0] or ""), r[1], r[2]))
    sums, lags, total, last = {}, {}, {}, {}
    for s, _, i, v in ordered:
        lags[i] = last.get(s)
        last[s] = v
        if v is not None:
            total[s] = total.get(s, 0) + v
        sums[i] = total.get(s)
    assert {r.i: r.sum for r in scan.running_sum(df, ["s"], ["d", "i"], "v", "sum", ranges).collect()} == sums
    assert {r.i: r._lag_v for r in scan.with_previous(df, ["s"], ["d", "i"], ["v"], ranges).collect()} == lags
    assert {r.i: r.n for r in scan.numbered(df, ["s", "d", "i"], "n", ranges).collect()} == {r[2]: n for n, r in enumerate(ordered, 1)}


def test_scans_of_no_rows(spark):
    none = spark.createDataFrame([], "s string, d long, v long")
    assert scan.running_sum(none, ["s"], ["d"], "v", "sum").collect() == scan.with_previous(none, ["s"], ["d"], ["v"]).collect() == scan.numbered(none, ["d"], "n").collect() == []


def test_floor_listed(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (10.0,), (99.0,), (None,), (NAN,)], "v double")
    tiers = spark.createDataFrame([(50, 3, "c"), (0, 1, "a"), (10, 2, "b"), (None, 0, "n"), (50, 4, "d")], "t int, tier int, name string")
    out = {repr(r.v): (r.x.t, r.x.tier, r.x.name) for r in joins.floor_listed(df, tiers, "v", "t", "tier", "x").collect()}
    assert out == {"-1.0": (0, 1, "a"), "0.0": (0, 1, "a"), "5.0": (0, 1, "a"), "10.0": (10, 2, "b"), "99.0": (50, 3, "c"), "None": (0, 1, "a"), "nan": (50, 3, "c")}
    none = joins.floor_listed(df, tiers.where("t > 1000"), "v", "t", "tier", "x")
    assert {r.x for r in none.collect()} == {None}


def test_lag_difference_across_buckets(spark):
    data = [("s", dt.date(2024, 1, 30) + dt.timedelta(days=i * 9), float(i * i)) for i in range(12)] + [("t", dt.date(2024, 5, 1), 4.0)]
    out = windows.lag_difference(spark.createDataFrame(data, "k string, d date, v double"), ["k"], ["d"], {"x": "v"})
    got = {(r.k, r.d): r.x for r in out.collect()}
    assert [got[("s", d)] for k, d, _ in data if k == "s"] == [None, *[float(2 * i - 1) for i in range(1, 12)]]
    assert got[("t", dt.date(2024, 5, 1))] is None


def test_lag_difference_one_global_series(spark, rows):
    data = [(dt.date(2024, m, 1), float(m * 10)) for m in (1, 2, 5)]
    out = windows.lag_difference(spark.createDataFrame(data, "d date, v double"), [], ["d"], {"x": "v"})
    assert sorted((r.d.month, r.x) for r in out.collect() if r.x is not None) == [(2, 10.0), (5, 30.0)]


def test_lag_difference_moves_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "timestamp_seconds(id * 7) AS t", "id AS v").repartition(4)
    out = windows.lag_difference(df, ["k"], ["t"], {"x": "v"})
    assert {r.x for r in out.collect()} == {None, 3}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_usage_change_bounds(spark):
    last = dt.date(2024, 6, 30)
    day = lambda n: last - dt.timedelta(days=n)
    data = [("a", last, 100), ("a", day(1), 1), ("a", day(32), 2), ("a", day(33), 4), ("a", day(62), 8), ("a", day(63), 16), ("a", None, 5), ("b", last, 3)]
    got = {r[0]: tuple(r)[1:] for r in windows.usage_change(spark.createDataFrame(data, "a string, d date, v long"), "a", "d", "v").collect()}
    assert got == {"a": (12, 3, last, -0.75, -75.0), "b": (0, 0, last, 0.0, 0.0)}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = windows.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_change_set_is_idempotent(spark, rows):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 2), (None, "n", 0)], "k int, v string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 3), (None, "n", 0)], "k int, v string, n int")
    changed = changes.change_set(before, after, "k")
    assert rows(changed.select("k", "action")) == [(1, "noop"), (2, "update"), (3, "delete"), (4, "insert"), (None, "noop")]
    applied = changes.apply_change_set(before, changed, "k")
    assert rows(applied) == rows(after)
    assert {r.action for r in changes.change_set(applied, after, "k").collect()} == {"noop"}


def test_change_set_with_copies_and_a_hot_key(spark, rows):
    before = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x")] + [(3, "h")] * 500, "k int, v string")
    after = spark.createDataFrame([(1, "b"), (1, "a"), (2, "y"), (2, "z")] + [(3, "h")] * 500, "k int, v string")
    out = changes.change_set(before, after, "k")
    assert rows(out) == [(1, "noop", "b"), (2, "update", "z"), (3, "noop", "h")]
    plan = changes.change_set(before, after, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Join " not in plan and plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan


def test_stale_rows(spark, rows):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", None, "z")], "id string, n int, t string")
    upload = spark.createDataFrame([("a", 9, "X")], "id string, n int, t string")
    assert rows(changes.null_out_stale(target, upload, "id", "n", ["n"])) == [("a", 9, "X"), ("b", None, "y")]
    copies = upload.union(upload).union(spark.createDataFrame([("a", 3, "Z"), ("d", None, None)], "id string, n int, t string"))
    assert rows(changes.null_out_stale(target, copies, "id", "n", ["n"])) == [("a", 9, "X"), ("b", None, "y"), ("d", None, None)]


def test_json_schema_and_quarantine(spark, rows):
    docs = spark.createDataFrame([(1, '{"a":1,"b":{"c":"x"}}'), (2, '{"a":2,"d":[{"e":true}],"n":null}'), (3, "{oops"), (4, None)], "id int, j string")
    found = reshape.json_schema(docs, "j")
    assert set(found.names) == {"a", "b", "d", "n"}
    parsed = reshape.parse_json(docs, "j", found)
    assert rows(reshape.unreadable(parsed, "j").select("id")) == [(3,), (4,)]
    assert rows(reshape.readable(parsed, "j").select("id", F.col("doc.a").cast("int"))) == [(1, 1), (2, 2)]


def test_json_schema_of_odd_names_and_top_levels(spark, rows):
    texts = ['{"VOIDED":1,"a.AVOID":"x","OBJECT<":{"VOID":null},"q`VOID":2}', "[1,2]", '[{"VOIDED":3}]', "5", '"VOID"', "null", "", None, ' \n{"VOIDED":4}', '{"l":[null]}']
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    found = reshape.json_schema(docs, "j")
    assert set(found.names) == {"VOIDED", "a.AVOID", "OBJECT<", "q`VOID", "l"} and found["OBJECT<"].dataType["VOID"].dataType == T.StringType()
    parsed = reshape.parse_json(docs, "j", found)
    assert [r.id for r in reshape.unreadable(parsed, "j").select("id").orderBy("id").collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert rows(reshape.readable(parsed, "j").select("id", F.col("doc.VOIDED"))) == [(0, 1), (8, 4), (9, None)]
    assert reshape.json_schema(docs.where("id = 1"), "j") == T.StructType([])


def test_child_rows_and_unpivot(spark, rows):
    df = spark.createDataFrame([(1, [("x", [1])]), (2, []), (3, None)], "id int, items array<struct<n:string, l array<int>>>")
    assert rows(reshape.child_table(df, ["id"], "items")) == [(1, "x", "[1]")]
    wide = spark.createDataFrame([(1, 5, None)], "id int, `data.Jan` int, `data.Feb` int")
    assert rows(reshape.unpivot_prefix(wide, "data.", "m", "v")) == [(1, "Feb", None), (1, "Jan", 5)]
    maps = spark.createDataFrame([(1, "p", {"a": 2}), (2, "p", {}), (3, "q", None), (4, "q", {"b": None, "c": 5}), (5, None, {"d": 1}), (6, None, None), (7, "none", None)], "id int, g string, m map<string,int>")
    held = {1: {"a": 2}, 4: {"c": 5}, 5: {"d": 1}}
    groups = {1: "p", 2: "p", 3: "q", 4: "q", 5: None, 6: None, 7: "none"}
    names = {"p": ["a"], "q": ["b", "c"], None: ["d"], "none": []}
    assert rows(reshape.unpivot_map(maps, "m", "k", "v")) == sorted([(i, g, n, held.get(i, {}).get(n)) for i, g in groups.items() for n in "abcd"], key=repr)
    assert rows(reshape.unpivot_map(maps, "m", "k", "v", per=["g"])) == sorted([(i, g, n, held.get(i, {}).get(n)) for i, g in groups.items() for n in names[g]], key=repr)
    wide = spark.createDataFrame([(1, 2, None), (2, None, None)], "id int, `m.a` int, `m.b` int")
    as_map = spark.createDataFrame([(1, {"a": 2, "b": None}), (2, None)], "id int, m map<string,int>")
    assert rows(reshape.unpivot_prefix(wide, "m.", "k", "v")) == rows(reshape.unpivot_map(as_map, "m", "k", "v"))


def test_groups(spark, rows):
    df = spark.createDataFrame([("Term Flip",), ("None such",), (None,)], "v string")
    dim = dims.group_rows(spark, {"d": {"flip": ["Term Flip"], "term": ["Term Flip"], "open": [None]}})
    assert rows(dims.classify(df, "v", dim, "d")) == [("None such", None), ("Term Flip", "flip"), ("Term Flip", "term"), (None, "open")]
    assert rows(df.select(dims.groups_of("v", {"x": ["Term Flip"], "y": [None]}))) == [(["x"],), (["y"],), ([],)]
    assert dims.other_values(["a", None, "b"], {"g": ["a", "c"]}) == [None, "b"]
    assert "Closed Won" in dims.all_values(dims.STAGES) and len(dims.all_values(dims.REGIONS)) == 10


def test_json_fields(spark, rows):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "no")], "id int, j string")
    assert rows(reshape.json_fields(df, "j", {"k": "INT"}).select("id", "k")) == [(1, 3), (2, None)]
    assert isinstance(reshape.json_schema(df, "j"), T.StructType)
