"""A session with the settings the engine is planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "sievework", **conf: str) -> SparkSession:
    """Adaptive plans, UTC, and Arrow; everything else is the cluster's own, `conf` wins over all."""
    own = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return SparkSession.builder.appName(app).config(map=own | conf).getOrCreate()
