"""Session factory and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

#: Settings for any master; a cluster's own submit configuration wins where it names them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """The active session, or a new one with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so that Python workers can import it anywhere."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return spark
    root = Path(__file__).resolve().parent
    fd, path = tempfile.mkstemp(prefix="textloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
    return spark
