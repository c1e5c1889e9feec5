"""Session settings the operators rely on, and the package for Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Stored instants are UTC wall-clock times. The JVM does not compile methods
# above 8000 bytes, so a stage that would generate one, such as staging with
# its many patterns, runs faster operator by operator.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Adaptive execution re-plans joins from measured sizes and splits skewed
# partitions. Small Arrow batches keep pages of HTML from piling up in a
# Python worker.
SESSION_CONF = RUNTIME_CONF | {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "shelftrack", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators need on a session that was built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers the package, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="shelftrack-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/shelftrack", "zip", str(package.parent), package.name))
