"""A product tag on accounts, following whether a matching active customer exists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.text import add_tag, remove_tag, remove_tag_exact
from revloom.operators.changes import changed_only
from revloom.operators.joins import left_lookup, present_in


def matches(accounts: DataFrame, others: DataFrame, tag: str, active: str = "Active Account") -> tuple[DataFrame, DataFrame]:
    """(candidates with their number of matches, scope and domain; ids of the customers per scope and domain).

    An account that has the tag or a linked id counts every customer of its domain, another only active ones and
    only if there are any. The customers are counted per domain before they meet the accounts: a domain shared
    by many of both never forms pairs.
    """
    linked = F.col("areas").contains(tag) | F.col("linked_id").isNotNull()
    scoped = accounts.withColumn("scope", F.when(linked, "all").otherwise("active"))
    scopes = F.array_compact(F.array(F.lit("all"), F.when(F.col("status") == active, F.lit("active"))))
    pool = others.where(F.col("domain").isNotNull()).select("domain", "id", F.explode(scopes).alias("scope"))
    per_domain = pool.groupBy("scope", "domain").agg(F.count("id").alias("n_ids"), F.count(F.lit(1)).alias("n_rows"))
    on = [("scope", "scope"), ("domain", "domain")]
    counted = left_lookup(scoped, per_domain, on, {"n_rows": "n_rows", "n_ids": "n_ids"})
    candidates = counted.where((F.col("scope") == "all") | F.col("n_rows").isNotNull()).withColumns({
        "match_count": F.coalesce("n_rows", F.lit(1)), "matched": F.coalesce("n_ids", F.lit(0)) > 0,
    }).drop("n_rows", "n_ids")
    return candidates, pool.withColumnRenamed("id", "matched_id").where("matched_id IS NOT NULL")


def retag(candidates: DataFrame, tag: str, exact: bool = False) -> DataFrame:
    """Accounts whose tag list changes: added where a match exists, removed where none is left.

    `exact` treats the list as elements; otherwise the tag is handled as text, wherever it occurs.
    """
    has_tag = F.coalesce(F.col("areas").contains(tag), F.lit(False))
    due = candidates.where(~F.col("matched") | ~has_tag)
    if exact:
        new = F.when(F.col("matched"), add_tag("areas", tag)).otherwise(F.coalesce(remove_tag_exact("areas", tag), F.lit("")))
    else:
        tagged = add_tag("areas", tag)
        new = F.when(F.col("matched"), tagged).otherwise(remove_tag(tagged, tag))
    upload = due.select("id", new.alias("areas"))
    changed = changed_only(candidates.select("id", "areas"), upload, "id", ["areas"])
    return changed.withColumn("areas", F.nullif("areas", F.lit("")))


def run(sources: dict[str, DataFrame], tag: str, exact: bool = False) -> dict[str, DataFrame]:
    """Sources: accounts(id, areas, domain, linked_id), customers(id, domain, status).

    The matches of a candidate are the `domain_ids` of its scope and domain. `before` has the tags as they were.
    """
    candidates, ids = matches(sources["accounts"], sources["customers"], tag)
    update = retag(candidates, tag, exact)
    return {
        "candidates": candidates, "domain_ids": ids, "account_update": update,
        "before": present_in(sources["accounts"].select("id", "areas"), update, ["id"]),
    }
