"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens raised to an exponent, normalised. The exponent is found by bisection: it is the
one nearest to 1 that meets a target entropy, or a limit on how often the smallest sources are repeated. The weights are
realised as permutations of each source: as many whole copies as its quota of tokens holds, then the head of one more
permutation. Permutations are ordered by md5 of seed, copy and doc_id, cut into blocks; the cutoff is found from the sums
of blocks and the rows of one block. Documents need no shuffle: each is compared with the cutoff of its source. Only
built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.llm.shared import as_row, folder, own_name, stored

#: Exponents are multiples of 2^-STEPS; a job tries 2^HALVINGS - 1 of them, that is HALVINGS halvings at once.
STEPS, HALVINGS = 20, 5


def tokens(text: Column) -> Column:
    """Words of a text, as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: int, copy: Column, doc_id: str = "doc_id") -> Column:
    """Where a row stands in a copy's permutation: a text of 32 hex digits, then the doc_id."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat_ws("|", F.lit(str(seed)), copy.cast("string"), name)), F.lit("|"), name)


def exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """The largest exponent in [0, 1] whose weights have an entropy of `target_entropy` times that of equal weights, or the
    smallest for which, when the least repeated source is seen once, none is seen more than `max_repeats` times.

    shares: p double (positive, sums to 1). 1 where the target holds without change or there are no sources; where nothing
    meets the target, the exponent that comes nearest (0 or 1).
    """
    lo, hi = 0, 1 << STEPS

    def holds(tried: list[int]) -> list[bool]:
        a = F.explode(F.array(*[F.lit(k / 2**STEPS) for k in tried])).alias("a")
        raised = shares.select("p", a).withColumn("w", F.pow("p", "a"))
        if target_entropy is not None:
            # with weights w / Z: ln Z - sum(w ln w) / Z
            out = raised.groupBy("a").agg((F.log(F.sum("w")) - F.sum(F.col("w") * F.log("w")) / F.sum("w") >= F.lit(target_entropy) * F.log(F.count("*"))).alias("ok"))
        else:
            out = raised.groupBy("a").agg((F.max(F.col("w") / F.col("p")) / F.min(F.col("w") / F.col("p")) <= F.lit(max_repeats)).alias("ok"))
        ok = {round(r["a"] * 2**STEPS): r["ok"] for r in out.collect()}
        return [ok.get(k, True) for k in tried]

    # entropy falls with the exponent: the largest that holds; repeats fall too: the smallest that holds
    first, last = holds([lo, hi])
    if target_entropy is not None:
        if last:
            return 1.0
        while hi - lo > 1:
            tried = sorted({lo + (hi - lo) * i // 2**HALVINGS for i in range(1, 2**HALVINGS)} - {lo, hi})
            good = [k for k, ok in zip(tried, holds(tried), strict=True) if ok]
            lo, hi = max([lo, *good]), min([hi, *(k for k in tried if k not in good)])
        return lo / 2**STEPS
    if first:
        return 0.0
    while hi - lo > 1:
        tried = sorted({lo + (hi - lo) * i // 2**HALVINGS for i in range(1, 2**HALVINGS)} - {lo, hi})
        good = [k for k, ok in zip(tried, holds(tried), strict=True) if ok]
        hi, lo = min([hi, *good]), max([lo, *(k for k in tried if k not in good)])
    return hi / 2**STEPS


def quotas(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None, seed: int = 0) -> DataFrame:
    """One row per source: source, tokens, weight, quota (tokens), copies (whole ones), cutoff (last order key of the part copy).

    docs: doc_id, text, source. Without a budget, the quotas are the smallest with which no source loses a row.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a limit on repeats")
    place = folder(docs.sparkSession)
    sized = stored(docs.select("doc_id", "source", tokens(F.col("text")).alias("tokens")), f"{place}/sized")
    sources = stored(sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), f"{place}/sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.where("tokens > 0").select("source", "tokens", "rows", (F.col("tokens") / F.lit(float(total or 1))).alias("p"))
    a = exponent(shares, target_entropy, max_repeats)
    raised = shares.withColumn("w", F.pow("p", F.lit(a)))
    norm = raised.agg(F.sum("w"), F.max(F.col("p") / F.col("w"))).first()
    weight = F.round(F.col("w") / F.lit(norm[0] or 1.0), 12)
    # the source least repeated comes once: budget * weight = tokens there
    spend = F.lit(float(budget)) * weight if budget is not None else F.lit(float(total) * (norm[1] or 1.0)) * F.col("w")
    plan = raised.select("source", "tokens", "rows", weight.alias("weight"), F.floor(spend + 0.5).cast("long").alias("quota"))
    plan = plan.withColumn("copies", F.floor(F.col("quota") / F.col("tokens")).cast("long")).withColumn("rest", F.col("quota") - F.col("copies") * F.col("tokens"))
    plan = plan.withColumn("blocks", F.ceil(F.sqrt("rows")).cast("long"))
    plan = stored(plan, f"{place}/plan")

    part = sized.join(plan.where("rest > 0").select("source", "copies", "rest", "blocks"), "source").withColumn("key", order_key(seed, F.col("copies")))
    block = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("blocks") / F.lit(2**32)).cast("long")
    part = part.select("source", "rest", "tokens", "key", block.alias("block"))
    sums = part.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("tokens"), F.max("key").alias("last"))
    upto = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("tokens").over(upto))
    sums = stored(sums.where(F.col("upto") - F.col("tokens") <= F.col("rest")), f"{place}/blocks")
    within = sums.where("upto <= rest").groupBy("source").agg(F.max("last").alias("cutoff"))
    # the one block of a source that the quota ends in
    edge = part.join(sums.where("upto > rest").select("source", "block", (F.col("upto") - F.col("tokens")).alias("before")), ["source", "block"])
    edge = edge.groupBy("source", "rest", "before", "key").agg(F.sum("tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    ends = edge.withColumn("upto", F.col("before") + running).where("upto <= rest").groupBy("source").agg(F.max("key").alias("cutoff"))
    cutoffs = within.union(ends).groupBy("source").agg(F.max("cutoff").alias("cutoff"))
    out = plan.join(cutoffs, plan["source"].eqNullSafe(cutoffs["source"]), "left").select(plan["source"], "tokens", "weight", "quota", "copies", "cutoff")
    return stored(out, f"{place}/quotas")


def mixed(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None, seed: int = 0) -> DataFrame:
    """docs, each row as often as the mixture takes it, with `copy` (long, from 0) and `place` (text that orders the whole
    mixture at random).

    docs: doc_id, text, source and any other columns, kept; where one is called copy or place, the operator's own gets an
    underscore behind its name. A source's quota is its weight times `budget` tokens; a part copy
    ends before it would pass the quota. Rows of a source that share a doc_id go together, as do those without one. A null
    source is a source of its own. Sources without any word have no share and come once. An empty table gives no rows.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    plan = quotas(docs.select("doc_id", "text", named.alias("source")), target_entropy, max_repeats, budget, seed)
    rows = docs.select(as_row(docs).alias("row"), named.alias("source"))
    taken = rows.join(plan.select("source", "copies", "cutoff"), "source", "left")
    more = F.when(order_key(seed, F.col("copies"), "row.doc_id") <= F.col("cutoff"), 1).otherwise(0)
    times = F.when(F.col("copies").isNull(), 1).otherwise(F.col("copies") + more).cast("long")
    taken = taken.withColumn("times", times).where("times > 0")
    each = taken.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("copy"))
    name = F.concat_ws("|", F.lit(str(seed)), F.col("copy").cast("string"), F.coalesce("row.source", F.lit("")), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))
    return each.select("row.*", F.col("copy").alias(own_name("copy", docs.columns)), F.md5(name).alias(own_name("place", docs.columns)))
