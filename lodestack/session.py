"""Session builder with the settings that the queries count on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; anything else is left to the cluster."""
    b = SparkSession.builder.appName("lodestack")
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return b.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
