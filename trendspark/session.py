"""Session set-up from a settings mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULT_SETTINGS: Mapping[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",
    # no call-site capture per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    app_name: str = "trendspark",
    settings: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Build (or reuse) a session; ``settings`` override the defaults above.

    Cluster-specific values (file system classes, result size, checkpoint folder)
    belong in ``settings`` or in the submit command, not here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return builder.config(map={**DEFAULT_SETTINGS, **(settings or {})}).getOrCreate()
