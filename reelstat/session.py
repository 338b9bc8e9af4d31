"""Session setup shared by the jobs, the tests and the bench."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# What the results depend on. Everything else (executors, memory, object store) is the cluster's business.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Runtime re-planning: partition sizing, skewed joins, skewed rebalance before a write.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """The session of a job. `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**ADAPTIVE_CONF, **SEMANTIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings the results depend on."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="reelstat-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that every executor can reach")
    return _own_dir()
