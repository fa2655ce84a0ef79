"""Gain of strap columns over the background, per frame and column, smoothed along time.

Straps are metal strips behind columns of a detector, which reflect light back into them.  Columns are strips of a frame's
pixels, frames of one column one series: both groups are bounded by the detector and the stretch of frames between gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.kernel_fit import named
from starloom.session import checkpointed

#: Bits of the pixel mask.
SOURCE, STRAP = 1, 4


def clipped(values: np.ndarray, low: float, high: float, rounds: int = 5) -> np.ndarray:
    """Rows of values with NaN for those more than `low` deviations below or `high` above the row's median."""
    values = values.copy()
    for _ in range(rounds):
        middle, spread = np.nanmedian(values, axis=1, keepdims=True), np.nanstd(values, axis=1, keepdims=True)
        out = (values < middle - low * spread) | (values > middle + high * spread)
        if not out.any():
            break
        values[out] = np.nan
    return values


def column_gains(pixels: DataFrame, strip: int = 64, rounds: int = 5) -> DataFrame:
    """(frame, x, gain): the clipped median over a strap column of value / background; columns without a usable pixel have none.

    pixels: (frame, x, y, value, background, mask); sources, zeros and unknown ratios don't count.
    """
    usable = (F.col("mask").bitwiseAND(STRAP) > 0) & (F.col("mask").bitwiseAND(SOURCE) == 0)
    ratio = F.col("value") / F.nullif(F.col("background"), F.lit(0.0))
    rows = pixels.where(usable).select("frame", "x", F.floor(F.col("x") / strip).alias("strip"), ratio.alias("ratio")).where("ratio != 0 AND NOT isnan(ratio) AND abs(ratio) < double('infinity')")

    def of_strip(part: pd.DataFrame) -> pd.DataFrame:
        columns, at = np.unique(part["x"].to_numpy(), return_inverse=True)
        order, counts = np.argsort(at, kind="stable"), np.bincount(at)
        values = np.full((len(columns), counts.max()), np.nan)
        values[at[order], np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)] = part["ratio"].to_numpy(float)[order]
        return pd.DataFrame({"frame": named(part["frame"].iloc[0], len(columns)), "x": columns, "gain": np.nanmedian(clipped(values, 3.0, 2.0, rounds), axis=1)})

    return rows.groupBy("frame", "strip").applyInPandas(of_strip, f"frame {pixels.schema['frame'].dataType.simpleString()}, x long, gain double")


def quiet_stretches(frames: DataFrame, gap: float) -> DataFrame:
    """(frame, t, stretch, n) of the frames (frame, t, mean) whose mean background isn't outlying: stretches between gaps, with their sizes.

    One row per frame.
    """

    def quiet(rows: pd.DataFrame) -> pd.DataFrame:
        mean = rows["mean"].to_numpy(float)
        kept = clipped(mean[None, :], 3.0, 3.0)
        return rows[mean < np.nanmedian(kept) + 5 * np.nanstd(kept)][["frame", "t"]]

    kind = frames.schema["frame"].dataType.simpleString()
    calm = frames.withColumn("__all", F.lit(1)).groupBy("__all").applyInPandas(quiet, f"frame {kind}, t double")
    w = Window.partitionBy(F.lit(1)).orderBy("t", "frame")
    parted = calm.withColumn("stretch", F.sum((F.col("t") - F.lag("t").over(w) > gap).cast("long")).over(w)).withColumn("stretch", F.coalesce("stretch", F.lit(0)))
    return parted.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("stretch")))


def linear_smooth(values: np.ndarray, window: int) -> np.ndarray:
    """The line fitted to the window about each place, at that place; both ends take the line of their outermost window."""
    half, u = window // 2, np.arange(window) - window // 2
    means = np.convolve(values, np.full(window, 1 / window), mode="valid")
    slope = lambda part: (u @ part) / (u @ u)
    head, tail = values[:window], values[-window:]
    return np.concatenate((means[0] + slope(head) * u[:half], means, means[-1] + slope(tail) * u[half + 1 :]))


def smooth_gains(gains: DataFrame, stretches: DataFrame, least: int = 100) -> DataFrame:
    """`gains` with those of stretches of more than `least` frames smoothed over a quarter of the stretch; a column's frames without a gain count as 1."""
    long = stretches.where(F.col("n") > least)
    columns = gains.agg(F.collect_set("x").alias("columns"))  # one row, of a detector's strap columns
    grid = long.join(F.broadcast(columns)).select("frame", "t", "stretch", F.explode("columns").alias("x"))
    series = grid.join(gains, ["frame", "x"], "left").select("frame", "t", "stretch", "x", F.coalesce("gain", F.lit(1.0)).alias("gain"))

    def of_column(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["t", "frame"], kind="stable")
        window = len(part) // 4
        return part[["frame", "x"]].assign(smooth=linear_smooth(part["gain"].to_numpy(float), window + (window % 2 == 0)))

    smooth = series.groupBy("stretch", "x").applyInPandas(of_column, f"frame {gains.schema['frame'].dataType.simpleString()}, x long, smooth double")
    return gains.join(smooth, ["frame", "x"], "full").select("frame", "x", F.coalesce("smooth", "gain").alias("gain"))


def with_strap_gain(pixels: DataFrame, floor: float = 1.001, gap: float = 0.5, least: int = 100) -> DataFrame:
    """Adds `gain` and `corrected`, the background times it, to rows (frame, t, x, y, value, background, mask).

    Gains below the floor, and columns without straps, count 1.
    """
    rows = pixels.drop("gain", "corrected")
    frames = checkpointed(rows.groupBy("frame").agg(F.min("t").alias("t"), F.avg("background").alias("mean")))
    gains = smooth_gains(checkpointed(column_gains(rows)), checkpointed(quiet_stretches(frames, gap)), least)
    gain = F.when(F.col("gain") >= floor, F.col("gain")).otherwise(1.0)
    return rows.join(gains, ["frame", "x"], "left").withColumn("gain", gain).withColumn("corrected", F.col("background") * F.col("gain")).select(*rows.columns, "gain", "corrected")
