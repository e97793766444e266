"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; partitions: shuffle partitions (leave it to the cluster's setting at scale)."""
    b = SparkSession.builder.appName("kindred").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
