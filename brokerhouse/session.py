"""Session settings the engine expects; a cluster may set any of them itself."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "brokerhouse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; `conf` overrides, e.g. shuffle partitions on a laptop."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
