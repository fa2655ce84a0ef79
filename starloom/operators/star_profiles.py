"""Empirical star profiles fitted tile by tile, and templates of stars put together from them.

A profile is a flattened square of weights on a grid `oversample` times finer than the pixels.  Tiles, their stars and a
profile's cells are bounded in number; frames, stars and groups are not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.kernel_fit import named
from starloom.operators.psf_flux import centred


def tile_side(nx: int, ny: int, across: int, down: int) -> int:
    """Tiles are square; strips beyond the last whole tile belong to none."""
    return min(nx // across, ny // down)


def tile_centres(side: int, across: int, down: int) -> list[tuple[float, float]]:
    """By tile number, row by row."""
    return [((c + 0.5) * side, (r + 0.5) * side) for r in range(down) for c in range(across)]


def spread_weights(offset: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, part to the next, inside) of places on a grid of n cells."""
    inside = (offset >= 0) & (offset <= n - 1)
    low = np.clip(np.floor(offset).astype(int), 0, n - 2)
    return low, offset - low, inside


def profile_design(x: np.ndarray, y: np.ndarray, stars: np.ndarray, oversample: int, n: int) -> np.ndarray:
    """(pixels, n * n): how much of each profile cell falls on each pixel, over all stars (x, y, flux)."""
    a = np.zeros((len(x), n * n))
    pixel = np.arange(len(x))
    for sx, sy, flux in stars:
        c, pc, in_c = spread_weights((x - sx) * oversample + n // 2, n)
        r, pr, in_r = spread_weights((y - sy) * oversample + n // 2, n)
        at = in_c & in_r
        for dr, wr in ((0, 1 - pr), (1, pr)):
            for dc, wc in ((0, 1 - pc), (1, pc)):
                a[pixel[at], (r[at] + dr) * n + c[at] + dc] += flux * (wr * wc)[at]
    return a


def fit_profiles(
    planes: DataFrame, stars: DataFrame, nx: int, ny: int, across: int, down: int, oversample: int = 2, n: int = 23, power: float = 0.8, least_stars: int = 3, correction: Sequence[float] | None = None
) -> DataFrame:
    """(frame, tile, profile, fitted) of planes (frame, x, y, value) and stars (x, y, flux): profiles of sum 1.

    Each tile is a weighted least squares of the profile's cells and a background of six terms: a plane, and a plane
    times the columns' correction, whose zeros mark bad columns.  A pixel weighs its absolute value to minus `power`.  Stars within a
    profile's reach of the tile count.  Tiles with fewer than `least_stars` or a fit without a positive sum get their frame's
    median profile, cell by cell; a frame without any fit gives no rows.
    """
    side = tile_side(nx, ny, across, down)
    margin = (n // 2) * 1.0
    whole = planes.where((F.col("x") < side * across) & (F.col("y") < side * down) & (F.col("x") >= 0) & (F.col("y") >= 0))
    tile = (F.floor(F.col("y") / side) * across + F.floor(F.col("x") / side)).cast("int")
    pixels = whole.where(F.col("value").isNotNull() & ~F.isnan("value")).select("frame", tile.alias("tile"), "x", "y", "value")
    span = lambda c, count: F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - margin) / side)), F.least(F.lit(count - 1), F.floor((F.col(c) + margin) / side)))
    meets = stars.where((F.col("x") > -margin) & (F.col("y") > -margin) & (F.col("x") < side * across + margin) & (F.col("y") < side * down + margin))
    near = meets.select("x", "y", "flux", F.explode(span("x", across)).alias("c")).select("*", F.explode(span("y", down)).alias("r"))
    near = near.groupBy((F.col("r") * across + F.col("c")).cast("int").alias("star_tile")).agg(F.sort_array(F.collect_list(F.struct("x", "y", "flux"))).alias("stars"))
    of_frame = pixels.select("frame", "tile").distinct().join(near, F.col("tile") == F.col("star_tile")).select(F.col("frame").alias("star_frame"), "star_tile", "stars")
    columns = None if correction is None else np.asarray(correction, float)

    def of_tile(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        profile = None
        found = [] if not len(own) else own["stars"].iloc[0]
        if len(found) >= least_stars and len(rows):
            x, y, v = (rows[c].to_numpy(float) for c in ("x", "y", "value"))
            factor = np.ones(len(rows)) if columns is None else columns[x.astype(int)]
            at = factor != 0
            x, y, v, factor = x[at], y[at], v[at], factor[at]
            u, w = (x % side) / side - 0.5, (y % side) / side - 0.5
            ground = np.stack([np.ones_like(u), u, w] + ([] if columns is None else [factor, factor * u, factor * w]), axis=1)
            a = np.hstack([profile_design(x, y, np.array([(s["x"], s["y"], s["flux"]) for s in found]), oversample, n), ground])
            weight = np.sqrt(np.maximum(np.abs(v), 1e-6) ** -power)[:, None]
            solution = np.linalg.lstsq(a * weight, v * weight[:, 0], rcond=None)[0][: n * n]
            if np.isfinite(solution).all() and solution.sum() > 0:
                profile = (solution / solution.sum()).tolist()
        return pd.DataFrame({"frame": named(key[0], 1), "tile": [key[1]], "profile": [profile]})

    kind = planes.schema["frame"].dataType.simpleString()
    fits = pixels.groupBy("frame", "tile").cogroup(of_frame.groupBy("star_frame", "star_tile")).applyInPandas(of_tile, f"frame {kind}, tile int, profile array<double>")

    def filled(rows: pd.DataFrame) -> pd.DataFrame:
        good = rows["profile"].notna()
        middle = np.median(np.stack(rows["profile"][good].to_list()), axis=0) if good.any() else None
        out = pd.DataFrame({"frame": named(rows["frame"].iloc[0], across * down), "tile": range(across * down)}).merge(rows[good][["tile", "profile"]], on="tile", how="left")
        out["fitted"] = out["profile"].notna()
        out["profile"] = [p if ok else middle for p, ok in zip(out["profile"], out["fitted"])]
        return out if middle is not None else out.iloc[:0]

    return fits.groupBy("frame").applyInPandas(filled, f"frame {kind}, tile int, profile array<double>, fitted boolean")


def zoomed(profile: np.ndarray, factor: float) -> np.ndarray:
    """Linear between cells, corners on corners, on an odd number of cells, with sum 1."""
    n = profile.shape[0]
    m = round(n * factor)
    place = np.linspace(0, n - 1, m) if m > 1 else np.zeros(1)
    low = np.clip(np.floor(place).astype(int), 0, max(0, n - 2))
    part = place - low
    lines = profile[low] * (1 - part)[:, None] + profile[np.minimum(low + 1, n - 1)] * part[:, None]
    image = lines[:, low] * (1 - part) + lines[:, np.minimum(low + 1, n - 1)] * part
    image = centred(image, m + (m % 2 == 0))
    return image / image.sum() if image.sum() > 0 else image


def finer_profiles(profiles: DataFrame, factor: float) -> DataFrame:
    """`profile` on a grid `factor` times finer."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            squares = (np.asarray(p, float).reshape(round(len(p) ** 0.5), -1) for p in part["profile"])
            yield part.assign(profile=[zoomed(p, factor).ravel().tolist() for p in squares])

    return profiles.mapInPandas(run, profiles.schema)


def nearest_centre(centres: Sequence[tuple[float, float]]) -> Column:
    """The number of the centre nearest to (x, y), the first of equals."""
    away = [F.struct((F.pow(F.col("x") - cx, 2) + F.pow(F.col("y") - cy, 2)).alias("d"), F.lit(k).alias("tile")) for k, (cx, cy) in enumerate(centres)]
    return F.array_min(F.array(*away))["tile"]


def star_template(stars: DataFrame, profiles: DataFrame, keys: Sequence[str], centres: Sequence[tuple[float, float]], oversample: int, nx: int, ny: int) -> DataFrame:
    """(keys, x, y, value) of the pixels that stars (x, y, flux) reach, with each group's profiles (keys, tile, profile).

    Stars without the keys belong to every group, stars with them to their own.  Stars outside the frame are left out.  A star's profile is moved by its part of a fine cell, linear between cells and 0 beyond the
    outermost, cut at the frame's edge, and fine cells are summed to pixels.
    """
    inside = stars.where((F.col("x") >= 0) & (F.col("x") < nx) & (F.col("y") >= 0) & (F.col("y") < ny))
    own = [k for k in keys if k in stars.columns]
    placed = inside.select(*own, "flux", nearest_centre(centres).alias("tile"), (F.col("x") * oversample).alias("fx"), (F.col("y") * oversample).alias("fy"))
    # a star's four weights, on its nearest fine cell and the next ones, are summed over the stars that share that cell and the sides of the next ones
    shift = {c: F.col(f"f{c}") - F.rint(f"f{c}") for c in "yx"}
    weight = lambda c, step: F.abs(shift[c]) if step else 1 - F.abs(shift[c])
    steps = [(a, b) for a in (0, 1) for b in (0, 1)]
    cell = [*own, "tile", F.rint("fy").alias("ry"), F.rint("fx").alias("rx"), F.signum(shift["y"]).cast("int").alias("sy"), F.signum(shift["x"]).cast("int").alias("sx")]
    sums = placed.groupBy(*cell).agg(*(F.sum(F.col("flux") * weight("y", a) * weight("x", b)).alias(f"w{a}{b}") for a, b in steps))

    n = F.sqrt(F.size("profile")).cast("int")
    side = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    own_profile = [k for k in keys if k in profiles.columns]
    cells = profiles.select(*own_profile, "tile", n.alias("n"), F.posexplode("profile").alias("k", "weight"))
    cells = cells.withColumns({"i": F.floor(F.col("k") / F.col("n")), "j": F.col("k") % F.col("n")}).withColumn("sy", side).withColumn("sx", side)

    def reached(at: Column, sign: Column) -> Column:
        """No part of a moved profile lies beyond its outermost cells."""
        return (at >= F.when(sign > 0, 1).otherwise(0)) & (at <= F.col("n") - F.when(sign < 0, 2).otherwise(1))

    half = F.floor(F.col("n") / 2)
    by_step = []
    for a, b in steps:
        r, c = F.col("i") + a * F.col("sy"), F.col("j") + b * F.col("sx")
        used = reached(r, F.col("sy")) & reached(c, F.col("sx")) & (F.col("sy") != 0 if a else F.lit(True)) & (F.col("sx") != 0 if b else F.lit(True))
        by_step.append(F.when(used, F.struct((r - half).alias("dy"), (c - half).alias("dx"), F.lit(2 * a + b).alias("step"), "weight")))
    stencil = cells.select(*own_profile, "tile", "sy", "sx", F.explode(F.array_compact(F.array(*by_step))).alias("o")).select(*own_profile, "tile", "sy", "sx", "o.*")
    met = sums.join(stencil, ["tile", "sy", "sx", *(k for k in own if k in own_profile)])
    share = F.when(F.col("step") == 0, F.col("w00")).when(F.col("step") == 1, F.col("w01")).when(F.col("step") == 2, F.col("w10")).otherwise(F.col("w11"))
    fine = met.select(*keys, (F.col("rx") + F.col("dx")).alias("gx"), (F.col("ry") + F.col("dy")).alias("gy"), (share * F.col("weight")).alias("value"))
    fine = fine.where((F.col("gx") >= 0) & (F.col("gx") < nx * oversample) & (F.col("gy") >= 0) & (F.col("gy") < ny * oversample))
    return fine.groupBy(*keys, F.floor(F.col("gx") / oversample).cast("long").alias("x"), F.floor(F.col("gy") / oversample).cast("long").alias("y")).agg(F.sum("value").alias("value"))
