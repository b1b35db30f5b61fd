"""The whole usage sync on the small tables: outputs agree with each other."""

from pyspark.sql import functions as F

from revloom.plans import usage_sync
from revloom.queries.registry import Tables
from revloom.queries.usage import AS_OF, sync_sources


def test_outputs_agree(spark):
    s = sync_sources(Tables(spark, "/root/testdata/sf0.001"))
    s["crm_usage"] = usage_sync.usage_periods(s["usage_periods"], s["contracts"], s["products"])
    out = usage_sync.run(s, AS_OF, portal_product="P", instance_product="I")
    keys = usage_sync.record_key(out["daily_usage"]).select("record_key").distinct()
    loaded = s["crm_daily"].select("record_key").distinct()
    inserted, deleted = out["daily_insert"].select("record_key"), out["daily_delete"].select("record_key").distinct()
    assert inserted.intersect(deleted).count() == 0
    assert loaded.subtract(deleted).union(inserted).exceptAll(keys).count() == 0
    assert keys.count() == inserted.count() + loaded.subtract(deleted).count()
    assert {r.action for r in out["period_changes"].select("action").distinct().collect()} == {"noop"}
    update = out["account_update"]
    assert update.count() == update.select("id").distinct().count()
    reporting = out["daily_usage"].select("account_id").distinct().count()
    assert update.where(F.col("usage_last_30").isNotNull()).count() == reporting
