"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    b = SparkSession.builder.master(master).config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
