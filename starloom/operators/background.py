"""Background of each frame from the unmasked pixels: a mesh of clipped medians, filled, smoothed and drawn out to pixels again.

Strips of boxes are computed side by side, a frame's mesh (its pixels over the box's area) as one group; pixels get their level by
an equality join with the mesh cell they lie in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.kernel_fit import named


def box_for(box: int, nx: int, ny: int) -> int:
    """At least 4 pixels, and at least two boxes across the frame."""
    return max(4, min(box, min(nx, ny) // 2))


def clipped_medians(values: np.ndarray, kappa: float, rounds: int) -> np.ndarray:
    """Of each row of values, NaN where missing, within kappa deviations of the median, clipped up to `rounds` times."""
    values = values.copy()
    for _ in range(rounds):
        middle, spread = np.nanmedian(values, axis=1, keepdims=True), np.nanstd(values, axis=1, keepdims=True)
        out = np.abs(values - middle) > kappa * spread
        if not out.any():
            break
        values[out] = np.nan
    return np.nanmedian(values, axis=1)


def box_levels(planes: DataFrame, box: int, exclude: float = 0.5, kappa: float = 3.0, rounds: int = 10) -> DataFrame:
    """(frame, bx, by, level) of every box with a pixel; level is null where more than `exclude` of the box's pixels are masked, unknown or beyond the frame."""
    bad = F.col("value").isNull() | F.isnan("value") | (F.coalesce("mask", F.lit(0)) > 0 if "mask" in planes.columns else F.lit(False))
    rows = planes.select("frame", F.floor(F.col("x") / box).alias("bx"), F.floor(F.col("y") / box).alias("by"), F.when(~bad, F.col("value").cast("double")).alias("value"))

    def of_strip(strip: pd.DataFrame) -> pd.DataFrame:
        boxes, at = np.unique(strip["bx"].to_numpy(), return_inverse=True)
        order = np.argsort(at, kind="stable")
        counts = np.bincount(at)
        place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        values = np.full((len(boxes), counts.max()), np.nan)
        values[at[order], place] = strip["value"].to_numpy(float)[order]
        good = np.isfinite(values).sum(axis=1)
        used = (box * box - good <= exclude * box * box) & (good > 0)
        level = np.full(len(boxes), np.nan)
        if used.any():
            level[used] = clipped_medians(values[used], kappa, rounds)
        return pd.DataFrame({"frame": named(strip["frame"].iloc[0], len(boxes)), "bx": boxes, "by": strip["by"].iloc[0], "level": pd.Series(level).astype(object).where(used, None)})

    kind = planes.schema["frame"].dataType.simpleString()
    return rows.groupBy("frame", "by").applyInPandas(of_strip, f"frame {kind}, bx long, by long, level double")


def filled_by_distance(levels: np.ndarray, neighbours: int) -> np.ndarray:
    """Unknown boxes get the mean of the nearest known ones, weighted by one over the distance; of equals the first by row and column."""
    y, x = np.nonzero(np.isfinite(levels))
    out = levels.copy()
    for i, j in zip(*np.nonzero(~np.isfinite(levels))):
        away = np.hypot(y - i, x - j)
        near = np.argsort(away, kind="stable")[:neighbours]
        out[i, j] = np.average(levels[y[near], x[near]], weights=1 / away[near])
    return out


def median_filtered(levels: np.ndarray, size: int) -> np.ndarray:
    """Of the boxes of a square about each that lie in the mesh."""
    half = size // 2
    padded = np.pad(levels, half, constant_values=np.nan)
    return np.nanmedian(np.lib.stride_tricks.sliding_window_view(padded, (size, size)).reshape(*levels.shape, -1), axis=2)


def mesh(levels: DataFrame, filter_size: int = 3, neighbours: int = 10) -> DataFrame:
    """(frame, bx, by, level) of all boxes of each frame, filled and median filtered; a frame without a known box has none."""

    def of_frame(rows: pd.DataFrame) -> pd.DataFrame:
        bx, by = rows["bx"].to_numpy(int), rows["by"].to_numpy(int)
        grid = np.full((by.max() + 1, bx.max() + 1), np.nan)
        grid[by, bx] = rows["level"].to_numpy(float)
        if not np.isfinite(grid).any():
            return pd.DataFrame({"frame": named(None, 0), "bx": [], "by": [], "level": []})
        smooth = median_filtered(filled_by_distance(grid, neighbours), filter_size)
        y, x = np.mgrid[: grid.shape[0], : grid.shape[1]]
        return pd.DataFrame({"frame": named(rows["frame"].iloc[0], x.size), "bx": x.ravel(), "by": y.ravel(), "level": smooth.ravel()})

    kind = levels.schema["frame"].dataType.simpleString()
    return levels.groupBy("frame").applyInPandas(of_frame, f"frame {kind}, bx long, by long, level double")


def drawn_out(planes: DataFrame, smooth: DataFrame, box: int, name: str = "background") -> DataFrame:
    """Adds each pixel's level: linear between the middles of the four boxes about it, and the nearest box's beyond the outermost middles."""
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    spread = smooth.withColumn("c", corner).select("frame", (F.col("bx") - F.col("c.i")).alias("cx"), (F.col("by") - F.col("c.j")).alias("cy"), "level", "c.i", "c.j")
    cells = spread.groupBy("frame", "cx", "cy").agg(*(F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("level"))).alias(f"l{i}{j}") for i in (0, 1) for j in (0, 1)))
    level = lambda i, j: F.coalesce(f"l{i}{j}", f"l{1 - i}{j}", f"l{i}{1 - j}", f"l{1 - i}{1 - j}")
    cells = cells.select("frame", "cx", "cy", *(level(i, j).alias(f"m{i}{j}") for i in (0, 1) for j in (0, 1)))
    g = lambda c: (F.col(c) + 0.5) / box - 0.5
    at = planes.drop(name).withColumns({"cx": F.floor(g("x")), "cy": F.floor(g("y"))})
    u, v = g("x") - F.col("cx"), g("y") - F.col("cy")
    value = (1 - u) * ((1 - v) * F.col("m00") + v * F.col("m01")) + u * ((1 - v) * F.col("m10") + v * F.col("m11"))
    return at.join(cells, ["frame", "cx", "cy"], "left").select(*planes.drop(name).columns, value.alias(name))


def with_background(planes: DataFrame, nx: int, ny: int, box: int = 4, filter_size: int = 3, exclude: float = 0.5, kappa: float = 3.0, rounds: int = 10, neighbours: int = 10, name: str = "background", bare_frames: bool = True) -> DataFrame:
    """`planes` (frame, x, y, value, and mask, where above 0 excludes) with the background under every pixel.

    A frame all of whose boxes are excluded gets the median of its unmasked pixels, or 0 without any; without `bare_frames` it has no rows.
    """
    side = box_for(box, nx, ny)
    out = drawn_out(planes, mesh(box_levels(planes, side, exclude, kappa, rounds), filter_size, neighbours), side, name)
    if not bare_frames:
        return out.where(F.col(name).isNotNull())
    known = F.col("value").isNotNull() & ~F.isnan("value") & (F.coalesce("mask", F.lit(0)) <= 0 if "mask" in planes.columns else F.lit(True))
    bare = out.where(F.col(name).isNull())
    flat = bare.groupBy("frame").agg(F.percentile(F.when(known, F.col("value").cast("double")), F.lit(0.5)).alias("flat"))
    return out.where(F.col(name).isNotNull()).unionByName(bare.join(flat, "frame").withColumn(name, F.coalesce("flat", F.lit(0.0))).select(*out.columns))
