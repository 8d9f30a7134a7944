"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Sessions are merged before they are shuffled, so one busy key sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Of a repeated JSON key the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Timestamps with statistics that filters can skip row groups by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Recording the Python line of every column call costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "clickmill", master: str | None = None, **extra: str) -> SparkSession:
    """Start (or join) a session; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
