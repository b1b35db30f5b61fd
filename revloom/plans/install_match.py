"""Downloads that were installed: tokens of leads found in installer names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.joins import containing, join_all, present_in


def installs(payload: DataFrame) -> DataFrame:
    """Tracking text of install events: the second entry of their properties."""
    token = F.try_element_at("properties", F.lit(2))
    return payload.where(F.col("type") == "install").select(token.alias("install")).where("install IS NOT NULL").distinct()


def run(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Sources: payload(type, properties), leads(id, token, verified, token_present).

    `matches` has a row per lead and installer text that holds its token. A text is known by its hash until it is found.
    """
    leads = sources["leads"].where(~F.col("verified") & F.col("token_present"))
    found = installs(sources["payload"]).withColumn("install_key", F.sha2("install", 256))
    pairs = containing(found, "install_key", "install", leads, "token")
    named = pairs.join(found, "install_key").select("token", "install")
    update = present_in(leads, pairs, ["token"]).select("id").distinct()
    return {
        "matches": join_all(leads, named, "token").select("id", "token", "verified", "token_present", "install"),
        "lead_update": update.withColumn("verified", F.lit(True)),
        "before": update.withColumn("verified", F.lit(False)),
    }
