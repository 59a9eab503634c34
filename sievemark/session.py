"""Session settings for local runs; on a cluster the session is given."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def local_session(cores: int = 8, settings: Mapping[str, str] | None = None) -> SparkSession:
    """A local session in UTC with one shuffle partition per core and no user interface."""
    defaults = {
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sievemark")
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
