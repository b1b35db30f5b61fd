"""New files of a landing folder through a batch job, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from revloom.operators.windows import first_per_key
from revloom.plans import telemetry
from revloom.sources import keyed
from revloom.sources.writers import overwrite

SOURCE = "id BIGINT, creationDate STRING, data STRING"


def load_documents(
    spark: SparkSession, landing: str, target: str, checkpoint: str, schema: T.StructType, *, load_name: str,
    split: Callable[[DataFrame], dict[str, DataFrame]] = telemetry.nodes, id_table: str = "product_statistics", key: str = telemetry.KEY,
) -> None:
    """Telemetry files (one JSON row per line: id, creationDate, data) to the family's child tables.

    Each batch drops ids that are loaded already and copies inside the batch, writes its own partition of every
    table and the id table last. The id table lies in hash partitions of the id, of which a batch reads those that its ids
    are in: the cost follows the batch, not the history. `load_name` belongs to the checkpoint folder. A batch that is run again
    after a failure replaces its partitions, so rows are never doubled.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        once = first_per_key(batch, ["id"], [F.col("creationDate").asc_nulls_last(), F.col("data").asc_nulls_last()])
        ids = keyed.read(spark, f"{target}/{id_table}", keyed.met(once, ["id"]))
        loaded = ids.select(key) if ids is not None else spark.createDataFrame([], f"`{key}` BIGINT")
        parsed = telemetry.new_documents(once, loaded, schema)
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables = {**split(parsed), "unreadable": telemetry.quarantine(parsed)}
            for name in sorted(tables, key=lambda n: n == id_table):
                stamped = tables[name].withColumn("load_id", F.lit(f"{load_name}-{batch_id}"))
                if name == id_table:
                    overwrite(stamped.withColumn(keyed.PART, keyed.part_of([key])), f"{target}/{name}", partition_by=[keyed.PART, "load_id"])
                else:
                    overwrite(stamped, f"{target}/{name}", partition_by=["load_id"])
        finally:
            parsed.unpersist()

    stream = spark.readStream.schema(SOURCE).json(landing)
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
