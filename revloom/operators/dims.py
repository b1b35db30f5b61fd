"""Named groups of domain values (deal types, stages, regions, funnels) and classification by them.

Groups overlap, so a value may be in several. Product lines are a customer's own data: pass them as groups of
the same shape; a later definition of a group replaces an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.functions.text import as_col

# The domain's own names.
DEAL_TYPES = {
    "flip": ["Grandfathered Renewal", "Subscription", "Subscription Flip", "Term Flip", "SAP Flip"],
    "term_flip": ["Term Flip"],
    "maintenance_flip": ["Subscription Flip"],
    "sap_flip": ["SAP Flip"],
    "new_business": ["New Logo", "New Business", "Pilot / POC"],
    "expansion": ["Existing Customer", "Add-on Sales", "Existing Business", "On Premise to SaaS", "Perpetual to Term"],
    "services": ["Professional Services"],
    "junk": ["null", "Temporary", "Expenses"],
    "renewal": ["Renewal", "Renewal Business"],
}
STAGES = {
    "won": ["5-Closed", "Closed Won"],
    "lost": ["99-Lost", "Closed Lost"],
    "closed": ["5-Closed", "Closed Won", "99-Lost", "Closed Lost"],
    "junk": [
        "Unqualified", "Disqualified", "Needs Analysis", "0-Suspect", "Attempting Contact", "Discovery", "Temporary",
        "Untouched", "No Response", "Closed Deferred", "Identified", "Alternate Configuration", "Data Quality", "Nurture",
    ],
}
REGIONS = {
    "emea": ["Nordics", "Other", "Eastern Europe", "Rest of EMEA", "DACH", "UK", "APJ", "Benelux"],
    "north_america": ["North America", "LATAM"],
}
FUNNELS = {"all": ["Expansion", "New Sales - Outbound", "New Sales - Inbound"]}

GROUP_SETS = {"deal_type": DEAL_TYPES, "stage": STAGES, "region": REGIONS, "funnel": FUNNELS}


def group_rows(spark: SparkSession, group_sets: dict[str, dict[str, list]] | None = None) -> DataFrame:
    """Long form (group_set, group, value) of the group definitions."""
    sets = GROUP_SETS if group_sets is None else group_sets
    rows = [(s, g, v) for s, groups in sets.items() for g, values in groups.items() for v in dict.fromkeys(values)]
    return spark.createDataFrame(rows, "group_set string, `group` string, value string")


def all_values(groups: dict[str, list]) -> list:
    """Every value of a set of groups once, in the order they are defined."""
    return list(dict.fromkeys(v for values in groups.values() for v in values))


def other_values(every: list, groups: dict[str, list]) -> list:
    """Values of `every` that are in none of the groups."""
    known = set(all_values(groups))
    return [v for v in dict.fromkeys(every) if v not in known]


def classify(df: DataFrame, value: str, dim: DataFrame, group_set: str) -> DataFrame:
    """One row per (row, group of its value); a value in no group keeps one row with NULL group.

    The lookup is null-safe: a group may list NULL as a value.
    """
    d = dim.where(F.col("group_set") == group_set).select("group", "value").alias("d")
    l = df.alias("l")
    return l.join(d, F.col(f"l.`{value}`").eqNullSafe(F.col("d.value")), "left").select("l.*", "d.group")


def groups_of(value, groups: dict[str, list]) -> Column:
    """Names of all groups a value is in, as an array; no join, the lists are part of the plan."""
    v = as_col(value)
    hits = [F.when(_in(v, values), F.lit(name)) for name, values in groups.items()]
    return F.array_compact(F.array(*hits))


def _in(v: Column, values: list) -> Column:
    listed = v.isin([x for x in values if x is not None])
    listed = F.coalesce(listed, F.lit(False))
    return listed | v.isNull() if None in values else listed
