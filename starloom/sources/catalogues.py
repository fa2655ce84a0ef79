"""Readers of targets, star catalogues, frame planes and handoffs: required columns are checked, ids never pass through floats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions import names, scalars
from starloom.operators import select

#: The columns of the two kinds of target lists.
NORMALIZED = ("sector", "camera", "ccd", "target_ra", "target_dec", "target_name", "enabled")
EVENTS = ("id", "ra", "dec", "tess_coverage")
#: Texts that mean an enabled target.
ENABLED = ("1", "true", "yes", "y", "t")
#: planes' columns, and the schema of a handoff from frames to templates.
PLANE = "frame string, x int, y int, value double"
HANDOFF = (
    "schema_version int, sector int, camera int, ccd int, x_min int, y_min int, x_max int, y_max int, reference_ffi_path string, groups array<struct<group_dx: double, group_dy: double>>"
)


def text_table(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with a header and # comments; all columns are text, their names trimmed and in lower case."""
    df = spark.read.csv(path, header=True, comment="#", inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.toDF(*(c.strip().lstrip("﻿").lower() for c in df.columns))


def required(spark: SparkSession, path: str, schema: str, optional: str = "") -> DataFrame:
    """The columns of `schema`, which must be there, and those of `optional` that are; unreadable values are null."""
    df = text_table(spark, path)
    wanted = StructType.fromDDL(schema)
    missing = [f.name for f in wanted if f.name.lower() not in df.columns]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    more = [f for f in StructType.fromDDL(optional)] if optional else []
    fields = [*wanted, *(f for f in more if f.name.lower() in df.columns)]
    return df.select(*(F.col(f"`{f.name.lower()}`").try_cast(f.dataType).alias(f.name) for f in fields))


def targets(spark: SparkSession, path: str) -> DataFrame:
    """(sector, camera, ccd, target_ra, target_dec, target_name, label) of a normalized list's enabled rows, or of an event list, a row per coverage."""
    df = text_table(spark, path)
    has = lambda cols: set(cols) <= set(df.columns)
    if has(EVENTS) and "sector" not in df.columns:
        chips = df.select(names.event_name(F.col("id")).alias("target_name"), "ra", "dec", F.explode(names.coverage(F.col("tess_coverage"))).alias("c"))
        rows = chips.select("c.sector", "c.camera", "c.ccd", F.col("ra").alias("target_ra"), F.col("dec").alias("target_dec"), "target_name")
    elif has(NORMALIZED):
        on = F.coalesce(F.trim("enabled"), F.lit(""))
        rows = df.where((on == "") | scalars.truthy(on, ENABLED)).select(*NORMALIZED[:-1])
    else:
        raise ValueError(f"{path}: missing {sorted(set(NORMALIZED) - set(df.columns))} for a target list, or {sorted(set(EVENTS) - set(df.columns))} for an event list")
    typed = rows.select(
        *(F.col(c).cast("int") for c in NORMALIZED[:3]), *(F.col(c).cast("double") for c in NORMALIZED[3:5]), F.trim("target_name").alias("target_name")
    )
    return typed.withColumn("label", names.target_label(F.col("sector"), F.col("camera"), F.col("ccd"), F.col("target_name")))


def sexagesimal(text: Column, digits: int) -> Column:
    """Units of a packed number such as 123045.5 (`digits` for the whole units): whole, sixtieths and their sixtieths."""
    form = rf"^(\d{{{digits}}})(\d{{2}})(\d{{2}}(?:\.\d*)?)$"
    part = lambda i: F.regexp_extract(text, form, i).try_cast("double")
    return F.when(text.rlike(form), part(1) + part(2) / 60 + part(3) / 3600)


def bright_stars(lines: DataFrame, line: str = "value") -> DataFrame:
    """(hr, ra, dec, vmag) from fixed columns: number, hours packed, sign, degrees packed, magnitude; unreadable rows go."""
    text = F.col(line)
    field = lambda at, n: F.trim(F.substring(text, at, n))
    position = r"^\s*(\d+)\s+([0-9.]+)([+-])([0-9.]+)\s+([0-9.+-]+)"
    part = lambda i: F.regexp_extract(text, position, i)
    sign = F.when(part(3) == "-", -1).otherwise(1)
    rows = lines.select(
        field(1, 4).try_cast("int").alias("hr"), (15 * sexagesimal(part(2), 2)).alias("ra"),
        (sign * sexagesimal(part(4), 2)).alias("dec"), part(5).try_cast("double").alias("vmag"),
    )
    return rows.dropna()


def unique_stars(stars: DataFrame, key: str = "source_id", order: Sequence[str] = ("ra", "dec")) -> DataFrame:
    """One row per star, the first by `order`; rows without an id (null or -1) go."""
    return select.keep_one(stars.where(F.col(key).isNotNull() & (F.col(key) != -1)), [key], list(order))


def planes(spark: SparkSession, path: str, frames: Sequence[str] | None = None) -> DataFrame:
    """Planes written by frame; only the wanted frames' folders are read."""
    df = spark.read.schema(PLANE).parquet(path)
    return df if frames is None else df.where(F.col("frame").isin(*frames))


def cropped(plane: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    """The pixels in the half-open box (x_min, x_max, y_min, y_max), counted from its corner."""
    x0, x1, y0, y1 = box
    x, y = F.col("x"), F.col("y")
    return plane.where((x >= x0) & (x < x1) & (y >= y0) & (y < y1)).withColumns({"x": x - x0, "y": y - y0})


def handoff(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HANDOFF).json(path)
