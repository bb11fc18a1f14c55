"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_ZONE = "UTC"

# Runtime settings: a measurement's date is the date in the session zone, so the zone must not depend on the host.  The
# adaptive settings are Spark's defaults, stated because skew handling and small-partition merging depend on them.  The
# JVM does not compile methods above 8000 bytes, so a wide projection is better split than fused into one of these.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": SESSION_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings a session must be built with.  Call-site capture costs several driver round trips per Column call, more than
# a short query takes to run.
BUILD_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "trilayer", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks.  On a cluster use the cluster's own session and `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**BUILD_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
