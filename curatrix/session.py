"""Sessions with the settings that the engine expects; a cluster's own settings always win."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: For jobs whose rows are long texts: an executor holds a batch of each of its tasks twice, in the JVM and in Python.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at a few MB in this session, in place of the engine's 64, unless it has a size of its own. Results do not change."""
    said = spark.conf.getAll
    for k, v in SMALL_BATCHES.items():
        if k not in said:
            spark.conf.set(k, v)


def build_session(master: str | None = None, name: str = "curatrix", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()
