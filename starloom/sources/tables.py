"""Readers: Parquet tables, fixed-width and delimited text with given schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (name, start from 1, length, type)
FIELD = tuple[str, int, int, str]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixed_width(df: DataFrame, line: str, fields: Sequence[FIELD]) -> DataFrame:
    """Fields by position, trimmed; an empty or unreadable number becomes null."""
    return df.select("*", *(F.trim(F.substring(line, at, n)).try_cast(kind).alias(name) for name, at, n, kind in fields))


def tokens(df: DataFrame, text: str, separators: str = "[/,]", name: str = "token") -> DataFrame:
    """One row per trimmed, non-empty part."""
    parts = F.transform(F.split(text, separators), lambda p: F.trim(p))
    return df.withColumn(name, F.explode(F.filter(parts, lambda p: p != "")))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Delimited text with a header, `#` comments and a declared schema; ids never pass through floats."""
    return spark.read.csv(path, schema=schema, header=True, comment="#", encoding="UTF-8", mode="PERMISSIVE")
