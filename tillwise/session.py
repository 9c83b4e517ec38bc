"""Session settings the package is tuned for. Every function also works on a session built elsewhere."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM never compiles a method above 8000 bytes of bytecode. Typing a wide feed can exceed that
    # when fused into one method; above this limit Spark keeps the operators of that stage separate.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "tillwise", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; on a cluster leave ``master`` to spark-submit.

    With adaptive execution ``spark.sql.shuffle.partitions`` is only the upper bound that small
    stages are coalesced from. Set it to about (largest shuffle in bytes / 128 MB): 200 suits
    tens of gigabytes, a 100 TB fact table wants tens of thousands.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
