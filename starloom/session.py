"""Spark session settings used by the tests, the bench and the examples."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session in UTC with adaptive execution; `conf` overrides any setting."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("starloom")
    for key, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """Written down in the cluster's spark.checkpoint.dir, so that rounds don't lengthen the lineage; in the warehouse only where none is set.

    On several machines a warehouse in a local folder is an error, as executors wouldn't see each other's files.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not re.match(r"local(\[|$)", spark.sparkContext.master) and not re.match(r"(?!file:)[\w+.-]+:", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(warehouse + "/checkpoints")
    return df.checkpoint(eager=True)
