"""Spark session settings for survey jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning: AQE coalesces small shuffle partitions, turns joins
# whose measured side is small into broadcast joins (with local shuffle
# reads), and splits skewed partitions of a shuffled join -- even when that
# costs an extra shuffle for a following aggregate (forceOptimizeSkewedJoin),
# because a hot haul or zone must never pin one task.
SURVEY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # the size measured at run time decides, whatever the static estimate said
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # AQE sizes post-shuffle partitions to ~128 MB from a generous initial
    # count, so one setting works from test data to 100 TB inputs
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def survey_session(app: str = "estuary", master: str | None = None,
                   shuffle_partitions: int | None = None,
                   conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the survey defaults.

    On a cluster leave ``master`` unset and set ``shuffle_partitions`` to
    roughly (largest shuffle in bytes) / 128 MB -- AQE coalesces the small
    ones, and sort/aggregate buffers spill to disk beyond executor memory.
    Local tests pass ``master="local[8]"``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SURVEY_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
