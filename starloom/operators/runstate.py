"""Run state as tables: closures of the stage graph, missing work, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The stage graph, as (before, after).
STAGE_EDGES = [
    ("tess_ffi_download", "wcs_grouping"),
    ("wcs_grouping", "mapping"),
    ("mapping", "ps1_download"),
    ("ps1_download", "ps1_process"),
    ("ps1_process", "downsample"),
    ("downsample", "diff"),
    ("wcs_grouping", "downsample"),
    ("mapping", "downsample"),
]


def ancestors(edges: DataFrame) -> DataFrame:
    """(stage, ancestor) for a graph of stages (before, after), by doubling until nothing is new; graphs are tens of rows."""
    known = edges.select(F.col("after").alias("stage"), F.col("before").alias("ancestor")).distinct()
    size = known.count()
    while True:
        further = known.alias("a").join(known.alias("b"), F.col("a.ancestor") == F.col("b.stage")).select("a.stage", "b.ancestor")
        known = known.union(further).distinct()
        new = known.count()
        if new == size:
            return known
        size = new


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(present.select(*keys).distinct(), keys, "left_anti")


def claim(df: DataFrame, status: str, expected: str, new: str) -> DataFrame:
    """Compare and set: rows in state `expected` move to `new`; `claimed` tells which did."""
    hit = F.coalesce(F.col(status) == expected, F.lit(False))
    return df.withColumns({"claimed": hit, status: F.when(hit, F.lit(new)).otherwise(F.col(status))})


def fill_stages(targets: DataFrame, stages: list[str], present: DataFrame, key: str) -> DataFrame:
    """(key, stage) of every target and stage that isn't present yet; the stages are a fixed, short list."""
    wanted = targets.select(key).distinct().withColumn("stage", F.explode(F.array(*map(F.lit, stages))))
    return missing(wanted, present, [key, "stage"])


def ready(df: DataFrame, status: str, states: list[str], due: str, now, limit: int, order: list[str]) -> DataFrame:
    """The next batch: rows in one of the states, due by `now` or without a time."""
    return df.where(F.col(status).isin(*states) & (F.col(due).isNull() | (F.col(due) <= now))).orderBy(*order).limit(limit)
