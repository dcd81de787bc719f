"""Session defaults for local runs; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "intentspark", **conf: str) -> SparkSession:
    cores = "8"
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = master[6:-1]
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "12g"),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
