"""One session builder: UTC, adaptive execution, Arrow transfer."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.windowExec.buffer.in.memory.threshold": "100000",
}


def build_session(app: str = "aeros", master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """extra may name connector packages, catalog extensions and sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | (extra or {})).getOrCreate()
