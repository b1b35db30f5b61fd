"""Lookups, updates from another table, floor / interval / containment joins and id maps."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.keys import same
from revloom.operators import scan, text_index
from revloom.operators.windows import first_per_key


def pairs(left: str, right: str, on: list[tuple[str, str]] | list[str]) -> Column:
    """Null-safe join condition between two aliased frames.

    All joins here are hashed on its null-safe form, also where NULL keys cannot match: a side that comes out of an
    aggregation is then exchanged once more, and both sides stay plain exchanges that the adaptive skew join can
    split when one key holds a large part of the rows.
    """
    return same([F.col(f"{left}.`{a}`") for a, _ in _named(on)], [F.col(f"{right}.`{b}`") for _, b in _named(on)])


def _named(on: list) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with all keys, the only ones an equality can match."""
    return df.where(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]))


def left_lookup(df: DataFrame, other: DataFrame, on: list[tuple[str, str]], take: dict[str, str]) -> DataFrame:
    """Left equi join taking {new name: column of `other`}. NULL keys match nothing, copies fan out."""
    l = df.drop(*[n for n in take if n not in dict(on)]).alias("l")
    r = _keyed(other, [b for _, b in on]).alias("r")
    return l.join(r, pairs("l", "r", on), "left").select("l.*", *[F.col(f"r.`{c}`").alias(n) for n, c in take.items()])


def _key_rows(other: DataFrame, on: list, unique: bool) -> DataFrame:
    """The key columns of `other`, each key once: copies go before the shuffle, unless there are none."""
    keys = other.select(*[F.col(f"`{b}`") for b in dict.fromkeys(b for _, b in _named(on))])
    return keys if unique else keys.distinct()


def absent_from(df: DataFrame, other: DataFrame, on: list[tuple[str, str]] | list[str], *, unique: bool = False) -> DataFrame:
    """Rows whose key is not in `other`; a NULL key counts as a value of its own. `unique`: other has no copies."""
    return df.alias("l").join(_key_rows(other, on, unique).alias("r"), pairs("l", "r", on), "left_anti")


def present_in(df: DataFrame, other: DataFrame, on: list[tuple[str, str]] | list[str], *, unique: bool = False) -> DataFrame:
    """Rows whose key is in `other`, each once; a NULL key counts as a value of its own. `unique` as above."""
    return df.alias("l").join(_key_rows(other, on, unique).alias("r"), pairs("l", "r", on), "left_semi")


def with_presence(df: DataFrame, other: DataFrame, on: tuple[str, str], alias: str) -> DataFrame:
    """True / False column: is the key in `other`? (IN as a value, not as a filter.)"""
    keys = _keyed(other, [on[1]]).select(F.col(on[1]).alias("_key"), F.lit(True).alias("_in")).distinct()
    return left_lookup(df, keys, [(on[0], "_key")], {alias: "_in"}).withColumn(alias, F.coalesce(alias, F.lit(False)))


def lookup_or_default(df: DataFrame, table: DataFrame, key: str, value: str, default) -> DataFrame:
    """One attribute per key, `default` for keys without one. A key with several values gets the smallest."""
    one = _keyed(table, [key]).groupBy(key).agg(F.min(value).alias(value))
    found = left_lookup(df, one, [(key, key)], {value: value})
    return found.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def update_from(
    target: DataFrame, source: DataFrame, on: list[tuple[str, str]], take: dict[str, str], order: list[Column] | None = None,
    only: Column | None = None,
) -> DataFrame:
    """UPDATE ... FROM: columns {target: source column} set from the matching row, kept where none matches.

    Of several matches the first in `order` is used; leave it out when the source has every key once (its primary
    key), which saves a shuffle. `only` limits which target rows may change.
    """
    keys = list(dict.fromkeys(b for _, b in on))
    one = _keyed(source, keys)
    one = first_per_key(one, keys, order) if order else one
    one = one.select(*keys, F.struct(*[F.col(s).alias(t) for t, s in take.items()]).alias("_new"))
    l, r = target.alias("l"), one.alias("r")
    cond = pairs("l", "r", on)
    if only is not None:
        l = target.withColumn("_may", only).alias("l")
        cond = cond & F.col("l._may")
    hit = F.col("r._new").isNotNull()
    out = [
        F.when(hit, F.col("r._new")[c]).otherwise(F.col(f"l.`{c}`")).alias(c) if c in take else F.col(f"l.`{c}`")
        for c in target.columns
    ]
    return l.join(r, cond, "left").select(*out)


def floor_tier(df: DataFrame, tiers: DataFrame, value: str, threshold: str, ranges: int | None = None) -> DataFrame:
    """Row's greatest threshold <= its value, or the lowest threshold when there is none, as `threshold`.

    Values and thresholds are compared as SQL compares their types, NaN above all numbers. A NULL value gets the lowest threshold. An
    as-of merge: a sample of the thresholds cuts them into ranges that each begin with a threshold, so the answer to a value is
    in its own range. Rows go there once, each gets its answer in one pass over the sorted range, and nothing is joined
    back. A range with many rows, as a sample shows, is dealt to several tasks by a hash of the row, its thresholds to each of them.
    Neither side has to be small.
    """
    ranges = ranges or scan.default_ranges(df)
    kind = tiers.schema[threshold].dataType
    wide = df.select(F.col(value).alias("v")).union(tiers.select(F.col(threshold).alias("v"))).schema["v"].dataType
    steps = tiers.select(F.col(threshold).alias("_t")).where("_t IS NOT NULL").distinct().withColumn("_v", F.col("_t").cast(wide))
    cuts = scan.cuts(steps, F.struct("_v"), ranges)
    other = [c for c in df.columns if c != threshold]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in other]).alias("_row"), F.col(value).cast(wide).alias("_v"))
    some = scan.placed(scan.sampled(rows, F.col("_row"), ranges * scan.SAMPLED_PER_RANGE), cuts, F.struct("_v"), ranges)
    held = some.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    tasks = F.ceil(F.col("n") * F.lit(ranges) / F.sum("n").over(Window.partitionBy(F.lit(0)))).cast("int")  # a row per range
    one = df.sparkSession.range(ranges + 1).select(F.col("id").cast("int").alias("_range"), F.lit(1).alias("tasks"))
    every = held.select("_range", tasks.alias("tasks")).union(one).groupBy("_range").agg(F.max("tasks").alias("tasks"))
    listed = F.array_sort(F.collect_list(F.struct("_range", "tasks")))
    dealt = every.agg(F.transform(listed, lambda x: x["tasks"])).scalar()  # by number of range, from 0
    rows = scan.placed(rows, cuts, F.struct("_v"), ranges)
    shares = F.get(dealt, F.col("_range"))
    rows = rows.withColumn("_share", F.pmod(F.xxhash64("_row"), shares)).withColumn("_t", F.lit(None).cast(kind))
    steps = scan.placed(steps, cuts, F.struct("_v"), ranges).withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), (shares - 1).cast("long"))))
    both = rows.unionByName(steps, allowMissingColumns=True)
    # of equal values the thresholds come first
    seen = Window.partitionBy("_range", "_share").orderBy("_v", F.col("_t").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_t", F.last("_t", ignorenulls=True).over(seen)).where("_row IS NOT NULL")
    return found.select("_row.*", F.coalesce("_t", tiers.agg(F.min(threshold)).scalar()).alias(threshold))


#: Rows that a declared tier list may have.
LISTED_TIERS = 1 << 16


def floor_listed(df: DataFrame, tiers: DataFrame, value: str, threshold: str, prefer: str, alias: str) -> DataFrame:
    """The whole row of the floor tier as a struct `alias`, for a tier list that the caller knows to be short (LISTED_TIERS rows at most).

    The list goes into the plan as one sorted array and is searched in each row where it is: no join, no shuffle, no job beforehand. Values
    meet thresholds as in `floor_tier`; of several tiers with one threshold the one with the smallest `prefer` counts.
    """
    rest = [c for c in tiers.columns if c not in (threshold, prefer)]
    one = tiers.where(F.col(threshold).isNotNull()).groupBy(threshold).agg(F.min(F.struct(prefer, *rest)).alias("_rest"))
    listed = one.agg(F.array_sort(F.collect_list(F.struct(threshold, "_rest.*")))).scalar()
    found = df.withColumn("_listed", listed).withColumn("_at", scan.position("_listed", F.col(value), LISTED_TIERS, threshold))
    return found.withColumn(alias, F.get("_listed", F.greatest(F.col("_at") - 1, F.lit(0)))).drop("_listed", "_at")


def next_within(
    df: DataFrame, events: DataFrame, key: str, date: str, event_date: str, event_id: str, months: int, alias: str
) -> DataFrame:
    """Id of the key's first event after the row's date and less than `months` later, NULL when there is none.

    Several events on one day: the smallest id. Both sides are cut to one row per key and day before they meet,
    so no pairs are formed inside a key and a window partition is bounded by the calendar.
    """
    day = F.col(date).cast("date")
    asked = df.select(F.col(key).alias("k"), day.alias("d")).distinct().withColumn("e", F.lit(None).cast(T.StringType()))
    offered = events.groupBy(F.col(key).alias("k"), F.col(event_date).cast("date").alias("d"))
    offered = offered.agg(F.min(event_id).cast("string").alias("e"))
    both = asked.unionByName(offered).where("k IS NOT NULL AND d IS NOT NULL")
    both = both.groupBy("k", "d").agg(F.max("e").alias("e"), F.max(F.col("e").isNull()).alias("asked"))

    # newest first, so the nearest later event is the last one seen: one pass over a key
    later = Window.partitionBy("k").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.last(F.when(F.col("e").isNotNull(), F.struct("d", "e")), ignorenulls=True).over(later)
    found = both.withColumn("hit", hit).where("asked")
    found = found.where(F.col("hit.d") < F.add_months("d", months)).select("k", "d", "hit.e")
    kind = events.schema[event_id].dataType
    out = left_lookup(df.withColumn("_d", day), found, [(key, "k"), ("_d", "d")], {alias: "e"}).drop("_d")
    return out.withColumn(alias, F.col(alias).cast(kind))


#: By the shortest token they serve: (characters of a piece, neighbouring pieces of which the one with the least hash is taken).
PIECES = {8: (5, 4), 4: (3, 2), 2: (2, 1), 1: (1, 1)}


#: Characters that are cut into pieces at a time. Bounds the memory of a task.
CUT_CHARS = 1 << 20


def winnowed(text: str | Column, size: int, window: int) -> Column:
    """Distinct hashes of the pieces of `size` characters that are the least of some `window` neighbouring ones.

    Every stretch of size + window - 1 characters holds one, and the same stretch the same one, wherever it stands. NULL has none.
    """
    most = CUT_CHARS

    def of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(how many each text has, hashes)."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        n = len(codes) - size - window + 2
        if n <= 0:
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint64)
        pieces = np.zeros(n + window - 1, np.uint64)
        for k in range(size):
            pieces = pieces * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(pieces)] + np.uint64(1)
        for by in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            pieces = (pieces ^ pieces >> np.uint64(33)) * np.uint64(by)
        pieces ^= pieces >> np.uint64(33)
        least = pieces[:n]
        for k in range(1, window):
            least = np.minimum(least, pieces[k : k + n])
        inside = owner[:n] == owner[size + window - 2 :]
        owner, least = owner[:n][inside], least[inside]
        order = np.lexsort((least, owner))
        owner, least = owner[order], least[order]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])])[: len(owner)]
        return np.bincount(owner[new], minlength=len(texts)), least[new]

    @F.arrow_udf("array<long>")
    def cut(texts: pa.Array) -> pa.Array:
        counts, hashes, some, chars = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)], [], 0
        for x in texts.to_pylist():
            some.append(x or "")
            chars += len(some[-1])
            if chars >= most:
                found = of_texts(some)
                counts.append(found[0]), hashes.append(found[1])
                some, chars = [], 0
        found = of_texts(some)
        counts.append(found[0]), hashes.append(found[1])
        ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes).view(np.int64)))

    return cut(F.col(text) if isinstance(text, str) else text)


#: Longest tokens that are looked up among all pieces of their length.
SHORT = 2


def containing(
    texts: DataFrame, key: str, text: str, tokens: DataFrame, token: str, *, framed_length: int = 6,
    frame: tuple[str, str] = ("-", "."),
) -> DataFrame:
    """Distinct (token, key) pairs where the text holds the token.

    A token of `framed_length` characters must stand between the two frame characters; others match anywhere. What stands in
    frames is cut out of the texts and looked up as it is, and so are pieces of up to SHORT characters. A longer token without white
    space can only be inside a word, and a text has each of its words once, so such tokens are looked for in the different words of
    all texts (`_by_pieces`), and a text has the tokens of its words. Words and pieces are those of a stored index (`text_index`), so
    that texts do not travel, nor a row per word of a text or per pair. Only tokens with white space are looked for in the texts
    themselves. Tokens are literal text; `key` has a text each.
    """
    wanted = tokens.select(F.col(token).alias("token")).where("token <> ''").distinct()
    held = texts.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_held"))
    is_framed, is_short, spaced = F.length("token") == framed_length, F.length("token") <= SHORT, F.col("token").rlike(r"\s")
    plain = wanted.where(~is_framed & ~is_short)

    asked = F.when(is_framed, F.lit(text_index.FRAMES)).when(is_short, F.length("token")).when(~spaced, F.lit(text_index.WORDS))
    index = text_index.index(held, "_key", "_held", wanted.agg(F.collect_set(asked)).scalar(), frame, framed_length)
    as_they_are = index.where(F.col("kind") == text_index.PIECE).join(wanted.where(is_framed | is_short).select(F.col("token").alias("piece")), "piece")

    own = index.where(F.col("kind") == text_index.WORD)
    words = own.select(F.col("piece").alias("_word")).distinct()
    of_words = _by_pieces(words, "_word", plain.where(~spaced)).where(F.contains("_word", "token"))
    of_words = of_words.groupBy("_word").agg(F.array_join(F.collect_list("token"), " ").alias("_tokens"))
    in_words = own.join(of_words, F.col("piece") == F.col("_word")).select("block", F.lit(text_index.WORD).alias("kind"), F.col("_tokens").alias("piece"), "texts")
    rows = as_they_are.select(index.columns).unionByName(in_words).unionByName(index.where(F.col("kind") == text_index.KEYS))
    found = text_index.pairs_of(rows, "_key", held.schema["_key"].dataType)

    # texts move only if there is a token with white space
    maybe = _by_pieces(held, "_held", plain.where(spaced), "_key")
    any_spaced = plain.agg(F.coalesce(F.max(spaced), F.lit(False))).scalar()
    in_texts = maybe.join(held.where(any_spaced), "_key").where(F.contains("_held", "token"))
    return found.select("token", "_key").unionByName(in_texts.select("token", "_key")).withColumnRenamed("_key", key)


def _by_pieces(texts: DataFrame, text: str, wanted: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct (`key`, token) pairs, or (`text`, token) of distinct texts, among which are all where the text holds the token; others must be sorted out.

    Of a text's pieces only those with the least hash among their neighbours are kept, some two in five characters; the same choice
    made in a token is a part of it, so a token is looked for by one of its pieces: the one that is in the fewest texts, or, for texts
    without a key, such as words, where a candidate is a row that is there already, the one that the fewest tokens have. Tokens too short
    for such a choice have shorter pieces, which texts give only if there are such tokens. Only keys and hashes travel.
    """
    kind = F.coalesce(*[F.when(F.length("token") >= n, F.lit(n)) for n in sorted(PIECES, reverse=True)])
    wanted = wanted.withColumn("_kind", kind)
    own = F.concat(*[winnowed(F.when(F.col("_kind") == n, F.col("token")), *how) for n, how in PIECES.items()])
    of_token = wanted.select("token", F.explode(own).alias("piece"))
    asked = wanted.agg(F.collect_set("_kind")).scalar()
    cut = F.concat(*[winnowed(F.when(F.array_contains("_kinds", n), F.col(text)), *how) for n, how in PIECES.items()])
    of_text = texts.withColumn("_kinds", asked).where(F.size("_kinds") > 0).select(key or text, F.explode(cut).alias("piece"))
    if key is None:
        shared = of_token.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("piece")))
        rare = shared.groupBy("token").agg(F.min(F.struct("n", "piece")).alias("rare"))
        return of_text.join(rare.select("token", F.col("rare.piece").alias("piece")), "piece").select(text, "token")
    of_text = of_text.join(of_token.select("piece").distinct(), "piece", "left_semi")
    common = of_text.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    # a token with a piece that no text has is in none
    ranked = of_token.join(common, "piece", "left").groupBy("token").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("rare"))
    rare = ranked.where("rare.n > 0").select("token", F.col("rare.piece").alias("piece"))
    return of_text.join(rare, "piece").select(key, "token").distinct()


#: Rows of a side in one share of `join_all`: a share of both sides gives at most about its square of rows.
SHARE_ROWS, SHARE_TASKS = 3000, 200


def join_all(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of two sides that both have many rows with one key. All their pairs are the result, dealt evenly.

    A task's work here is the pairs that it makes, which the size of its input does not show, so they are dealt beforehand: a key's rows
    are cut into shares by their hash, and each share of a side meets each of the other in a cell of its own.
    """
    sizes = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_others")), key)
    shares = {n: F.ceil(F.col(n) / SHARE_ROWS) for n in ("_rows", "_others")}
    sizes = sizes.select(key, *[c.cast("long").alias(n) for n, c in shares.items()])
    tasks = max(SHARE_TASKS, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def dealt(df: DataFrame, own: str, other: str, at: str, against: str) -> DataFrame:
        share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        # by a given number of tasks, so that small inputs are not put together
        return df.join(sizes, key).select(*[F.col(f"`{c}`") for c in df.columns], share.alias(at), every.alias(against)).repartition(tasks, key, "_at", "_against")

    l, r = dealt(left, "_rows", "_others", "_at", "_against"), dealt(right, "_others", "_rows", "_against", "_at")
    return l.join(r, [key, "_at", "_against"]).drop("_at", "_against")


def listed(dim: DataFrame) -> Column:
    """The distinct values of a one-column list as one sorted array, NULL among them, for use in any plan."""
    name = dim.columns[0]
    values = F.sort_array(F.collect_set(F.struct(name)))  # a struct keeps the NULL
    return dim.agg(F.transform(values, lambda s: s[name])).scalar()


#: Combinations that a word of a bitmap stands for.
WORD_BITS = 64


def missing_combinations(df: DataFrame, keys: list[str], got: DataFrame, on: list[tuple[str, str]], lists: dict[str, DataFrame]) -> DataFrame:
    """One row per row of df and combination of the `lists` that `got` does not have for its key.

    `on`: (key column, column of got); the other columns of got are named as the lists. A list has a column of its name and, where it
    depends on the key, key columns (each key then has its own values; one without a list was asked nothing). Values are
    numbered, so a combination is a number and what a key has is a bitmap, in words of WORD_BITS combinations with a row each. Only
    missing combinations become rows, and no row holds more than a word. NULL is a value like others, but not in a list's keys.
    """
    have = got.select(*[F.col(f"`{b}`").alias(a) for a, b in on], *[c for c in got.columns if c not in [b for _, b in on]])
    spine, numbers, stride = df.select(*keys), {}, F.lit(1).cast("long")
    have = have.withColumn("_spot", F.lit(0).cast("long"))
    for i, (name, values) in enumerate(lists.items()):
        scope = [c for c in values.columns if c != name]
        once = _keyed(values, scope).distinct() if scope else values.distinct()
        # the lists are parameters: one numbering per list, not per row
        numbered = once.withColumn("_at", (F.row_number().over(Window.partitionBy(*(scope or [F.lit(0)])).orderBy(name)) - 1).cast("long"))
        numbers[name] = (scope, numbered)
        size = numbered.groupBy(*scope).agg(F.count(F.lit(1)).alias(f"_n{i}"))
        if scope:
            spine, have = spine.join(size, scope), have.join(size, scope)
        else:
            total = size.scalar()
            spine, have = spine.withColumn(f"_n{i}", total), have.withColumn(f"_n{i}", total)
        h, v = have.alias("h"), numbered.alias("v")
        have = h.join(v, pairs("h", "v", [*scope, name])).select("h.*", "v._at").withColumn("_spot", F.col("_spot") + F.col("_at") * stride).drop("_at")
        stride = stride * F.col(f"_n{i}")
    bit = F.expr(f"shiftleft(1L, cast(_spot % {WORD_BITS} AS INT))")
    words = have.withColumn("_word", F.expr(f"_spot div {WORD_BITS}")).groupBy(*[a for a, _ in on], "_word").agg(F.bit_or(bit).alias("_bits"))
    spine = spine.withColumn("_total", stride).where("_total > 0").withColumn("_word", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_total - 1) div {WORD_BITS}"))))
    l, r = spine.alias("l"), words.alias("r")
    both = l.join(r, pairs("l", "r", [*[a for a, _ in on], "_word"]), "left").select("l.*", F.coalesce("r._bits", F.lit(0).cast("long")).alias("_bits"))
    last = F.least(F.lit(WORD_BITS - 1).cast("long"), F.col("_total") - 1 - F.col("_word") * WORD_BITS)
    unset = F.filter(F.sequence(F.lit(0).cast("long"), last), lambda b: F.getbit("_bits", b.cast("int")) == 0)
    out = both.select("*", F.explode(unset).alias("_bit")).withColumn("_spot", F.col("_word") * WORD_BITS + F.col("_bit"))
    for i, (name, (scope, numbered)) in enumerate(numbers.items()):
        out = out.withColumn("_at", F.col("_spot") % F.col(f"_n{i}")).withColumn("_spot", F.expr(f"_spot div _n{i}"))
        out = out.join(numbered, [*scope, "_at"]).drop("_at")
    return out.select(*keys, *lists)


def id_account_map(
    activity: DataFrame, contracts: DataFrame, reported: DataFrame, *, bad_ids: list[str] = (), bad_accounts: list[str] = ()
) -> DataFrame:
    """Distinct (id, account) over three sources with columns id, account.

    It is the full outer join activity = contracts = reported on id, account taken from the first source that
    has one, `bad_*` values of the activity source read as missing. The third source meets the second only: an id
    known to activity and reported but not to contracts keeps both accounts. The rule depends on which sources know
    an id, so it is written with one row of flags per id: a much repeated id never multiplies.
    """
    def listed(c: Column, values) -> Column:
        return F.when(c.isin(*values), None).otherwise(c) if values else c

    a = activity.select(F.lit("a").alias("src"), "id", listed(F.col("account"), bad_accounts).alias("account"))
    c = contracts.select(F.lit("c").alias("src"), "id", "account")
    u = reported.select(F.lit("u").alias("src"), "id", "account")
    rows = a.unionByName(c).unionByName(u).where("id IS NOT NULL").distinct()

    def any_of(cond: Column) -> Column:
        return F.max(F.when(cond, 1).otherwise(0)) == 1

    src, empty = F.col("src"), F.col("account").isNull()
    flags = rows.groupBy("id").agg(
        any_of(src == "a").alias("in_a"), any_of((src == "a") & empty).alias("open_a"),
        any_of(src == "c").alias("in_c"), any_of((src == "c") & empty).alias("open_c"),
        any_of(src == "u").alias("in_u"),
    )
    f = left_lookup(rows, flags, [("id", "id")], {c: c for c in flags.columns if c != "id"})
    from_c = F.col("in_c") & (~F.col("in_a") | F.col("open_a"))  # contracts decide where activity leaves it open
    from_u = ~F.col("in_c") | (from_c & F.col("open_c"))
    falls_through = (
        F.when(src == "a", F.col("in_c")).when(src == "c", F.col("in_u")).otherwise(F.lit(False))
    )
    used = (
        F.when(src == "a", ~empty | ~falls_through)
        .when(src == "c", from_c & (~empty | ~falls_through))
        .otherwise(from_u)
    )
    out_id = F.when((src == "a") & ~F.col("in_c"), listed(F.col("id"), bad_ids)).otherwise(F.col("id"))
    return f.where(used).select(out_id.alias("id"), "account").distinct()
