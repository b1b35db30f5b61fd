"""Invoices against orders: what is missing, and totals side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions.keys import text_key
from revloom.functions.numbers import null_subtract, per_rate
from revloom.operators.joins import absent_from, left_lookup, present_in

# Report groups, and the invoice status that counts as won.
ROYALTY, ROYALTY_GROUP, OTHER_GROUP, WON_STATUS = "Royalty", "SAP - Royalty", "Contracted", "Sent"

KEYS = ["quarter", "product", "rpt_group", "region", "segment", "account_id"]


def valued(df: DataFrame, sources: dict[str, DataFrame], default_product: str) -> DataFrame:
    """Product, group and status; amount in the base currency, in whole units. Rows without a product have their deal's."""
    out = left_lookup(df, sources["rates"], [("currency", "iso_code")], {"_rate": "rate"})
    if "product" not in df.columns:
        out = left_lookup(out, sources["deals"], [("deal_id", "id")], {"product": "product"})
    return out.withColumns({
        "product": F.coalesce("product", F.lit(default_product)),
        "value": F.round(per_rate("amount", "_rate")),
        "rpt_group": F.when(F.col("type") == ROYALTY, ROYALTY_GROUP).otherwise(OTHER_GROUP),
        "won_validated": F.coalesce(F.col("invoice_status") == WON_STATUS, F.lit(False)),
    }).drop("_rate")


def labelled(df: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Region and segment of the account, name of the deal."""
    out = left_lookup(df, sources["accounts"], [("account_id", "id")], {"region": "region", "segment": "segment"})
    return left_lookup(out, sources["deals"], [("deal_id", "id")], {"deal_name": "name"})


def side_by_side(orders: DataFrame, invoices: DataFrame, keys: list[str]) -> DataFrame:
    """Won, forecast and row count per key on both sides and their differences.

    Full outer, with NULL keys meeting NULL keys: both sides are stacked and grouped once, so the comparison
    costs one partially aggregated shuffle and no join.
    """
    def measures(df: DataFrame, side: str) -> DataFrame:
        amount = F.coalesce(F.col("value"), F.lit(0.0))
        won = F.col("won_validated")
        return df.select(
            *keys,
            F.when(won, amount).otherwise(0.0).alias(f"{side}_won"),
            F.when(~won, amount).otherwise(0.0).alias(f"{side}_forecast"),
            F.lit(1).cast("bigint").alias(f"{side}_n"),
        )

    stacked = measures(orders, "order").unionByName(measures(invoices, "invoice"), allowMissingColumns=True)
    names = [f"{side}_{m}" for side in ("order", "invoice") for m in ("won", "forecast", "n")]
    totals = stacked.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
    checks: dict[str, Column] = {f"{m}_check": null_subtract(f"order_{m}", f"invoice_{m}") for m in ("won", "forecast", "n")}
    return totals.withColumns(checks)


def master_check(orders: DataFrame, invoices: DataFrame, accounts: DataFrame) -> DataFrame:
    """Both sides by account first; region and segment, which follow from it, are looked up for the sums alone."""
    totals = side_by_side(orders, invoices, [k for k in KEYS if k not in ("region", "segment")])
    out = left_lookup(totals, accounts, [("account_id", "id")], {"region": "region", "segment": "segment"})
    return out.withColumn("helper", text_key(*KEYS))


def run(sources: dict[str, DataFrame], since, default_product: str = "Default") -> dict[str, DataFrame]:
    """Sources: invoices(id, account_id, deal_id, type, invoice_status, billing_start, amount, currency, test),
    orders(id, account_id, deal_id, product, type, invoice_status, effective_date, amount, currency, invoice_id, test),
    accounts(id, region, segment), deals(id, name, product), rates(iso_code, rate); accounts and deals have a row per id."""
    day = F.lit(str(since)).cast("date")
    invoices = sources["invoices"].where(~F.col("test") & (F.col("billing_start") >= day))
    orders = sources["orders"].where(~F.col("test") & (F.col("effective_date") >= day) & F.col("invoice_id").isNotNull())
    named = orders.select("invoice_id")

    def prepared(df: DataFrame, quarter: str) -> DataFrame:
        return valued(df, sources, default_product).withColumn("quarter", F.col(quarter))

    # what is not matched goes before any lookup
    kept = prepared(present_in(invoices, named, [("id", "invoice_id")]), "billing_start")
    missing = prepared(absent_from(invoices, named, [("id", "invoice_id")]), "billing_start")
    orders = prepared(orders, "effective_date")
    return {
        "missing_invoices": labelled(missing, sources),
        "master_check": master_check(orders, kept, sources["accounts"]),
        "orders": labelled(orders, sources).withColumn("helper", text_key(*KEYS)),
        "invoices": labelled(kept, sources).withColumn("helper", text_key(*KEYS)),
    }
