"""Writers: planes by frame, tables whose rows replace older ones, handoffs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import select


def write_planes(planes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per frame; a frame's pixels are dealt by its rows' own partitions, so a large frame is no single task."""
    planes.write.mode(mode).partitionBy("frame").parquet(path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The table that `write_upserted` completed last."""
    versions = spark.read.text(f"{path}/versions").orderBy(F.desc("value")).limit(1).collect()  # one name
    return spark.read.parquet(f"{path}/{versions[0].value}")


def write_upserted(new: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Rows of `new` (unique by key) replace those with their key; others stay.

    Each call writes a whole version into a folder of its own and then names it, so readers never see half a table.
    """
    spark = new.sparkSession
    number = 0
    table = new
    try:
        versions = spark.read.text(f"{path}/versions")
        number = versions.count()
        order = [F.col("__from")]
        both = latest(spark, path).withColumn("__from", F.lit(0)).unionByName(new.withColumn("__from", F.lit(1)), allowMissingColumns=True)
        table = select.keep_one(both, keys, order, largest=True).drop("__from")
    except Exception as e:  # the first version: there is no list of versions yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    name = f"v{number:09d}-{uuid.uuid4().hex[:8]}"
    table.write.parquet(f"{path}/{name}")
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("append").text(f"{path}/versions")


def write_handoff(groups: DataFrame, path: str, head: dict[str, object]) -> None:
    """One JSON row: the head's values and the distinct offsets of all groups from 0 on, in order.  Groups are pointings, few against frames."""
    offsets = groups.where("group_id >= 0").select(F.round("group_dx", 6).alias("group_dx"), F.round("group_dy", 6).alias("group_dy")).distinct()
    row = offsets.agg(F.sort_array(F.collect_list(F.struct("group_dx", "group_dy"))).alias("groups"))
    row.select(*(F.lit(v).alias(k) for k, v in head.items()), "groups").coalesce(1).write.mode("overwrite").json(path)
