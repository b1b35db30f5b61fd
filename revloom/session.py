"""Session settings the jobs count on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINTS = "spark.checkpoint.dir"
#: Temporary folders of local sessions, by application.
_OWN: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # no call site per expression: building a wide plan from Python is several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Tasks after a shuffle are cut small, from many partitions, so that what one sorts or hashes does not grow with the input.
#: A session that sets its own sizes keeps them.
BOUNDED = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


#: Those that a running session can take over, so that queries split hot keys in any session.
TRAVELLING = [n for n in SETTINGS if n.startswith("spark.sql.adaptive.")]


def settle(spark: SparkSession) -> None:
    """Gives a session that came from elsewhere the adaptive settings that the joins count on."""
    for name in TRAVELLING:
        if spark.conf.get(name, None) != SETTINGS[name]:
            spark.conf.set(name, SETTINGS[name])
    for name, value in BOUNDED.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def local(cores: int | str = 8, app: str = "revloom") -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(cores)).config("spark.driver.memory", "12g")
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    Where none is named, as in tests, local sessions get a temporary one; a cluster must name it, since its machines
    share no temporary folder. What is written there stays until the caller empties the folder.
    """
    top = spark.conf.get(CHECKPOINTS, None) or spark.sparkContext.getCheckpointDir()
    if not top:
        master, name = spark.sparkContext.master, spark.sparkContext.applicationId
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINTS} to a folder that all machines share")
        if name not in _OWN:
            _OWN[name] = "file://" + tempfile.mkdtemp(prefix="revloom-")
        top = _OWN[name]
    return f"{top.rstrip('/')}/revloom-{uuid.uuid4().hex}"
