"""A session with the settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a job can take over as they are; anything else is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: joins between two large sides have their hot
    # partitions cut into several tasks, and small partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Report and expression files are small (0.1 to 1 MB): a lower open cost
    # packs more of them into one scan task.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
