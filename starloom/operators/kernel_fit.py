"""Kernel fit between images: the kernel that turns a template into each frame, fitted on stamps, and the frame less the convolved template.

Planes are rows (frame, x, y, value), with `noise` and `mask` if they have them.  The kernel is a sum of fixed basis images,
whose coefficients are polynomials of the place; the background is a polynomial as well.  All unknowns are linear, so every
stamp becomes one Gram matrix and right side, and a frame is solved from its stamps' sums:
stamps that fit badly are clipped without touching a pixel again.  Both the stamps' sums and the convolution work on tiles with a margin.

A stamp and a tile have a bounded number of pixels, a frame a bounded number of stamps; any number of frames run side by side.
Null and NaN pixels, and those that the mask marks or whose noise isn't positive, don't count, nor do pixels whose kernel reaches a missing template pixel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KernelModel:
    """Gaussians exp(-s r^2) for each s of `falloffs` times monomials of up to `degrees`; the place's polynomials are over x / width and y / height."""

    half: int
    falloffs: tuple[float, ...]
    degrees: tuple[int, ...]
    kernel_order: int
    background_order: int
    stamp_half: int
    width: int
    height: int

    @property
    def reach(self) -> int:
        return self.half + self.stamp_half


def basis_images(half: int, falloffs: tuple[float, ...], degrees: tuple[int, ...]) -> np.ndarray:
    """(n, side, side) over (y, x).  Images even in both directions have sum 1, less the first image from the second on; so only the first has a sum."""
    u = np.arange(-half, half + 1, dtype=float)
    images: list[np.ndarray] = []
    for fall, degree in zip(falloffs, degrees, strict=True):
        bell = np.exp(-fall * u * u)
        for i, j in monomials(degree):
            along_x, along_y = bell * u**i, bell * u**j
            if i % 2 == 0 and j % 2 == 0:
                image = np.outer(along_y / along_y.sum(), along_x / along_x.sum())
                images.append(image - images[0] if images else image)
            else:
                images.append(np.outer(along_y, along_x))
    return np.array(images)


def monomials(order: int) -> list[tuple[int, int]]:
    """Exponents of x and y."""
    return [(i, j) for i in range(order + 1) for j in range(order + 1 - i)]


def powers(x: np.ndarray, y: np.ndarray, order: int) -> np.ndarray:
    """(n monomials, *shape)"""
    return np.array([x**i * y**j for i, j in monomials(order)])


def n_unknowns(model: KernelModel) -> int:
    n = len(basis_images(model.half, model.falloffs, model.degrees))
    return 1 + (n - 1) * len(monomials(model.kernel_order)) + len(monomials(model.background_order))


def design(parts: np.ndarray, x: np.ndarray, y: np.ndarray, model: KernelModel) -> np.ndarray:
    """(unknowns, *shape): the first basis image's coefficient is the same everywhere, so the kernel's sum is."""
    sx, sy = x / model.width, y / model.height
    places, ground = powers(sx, sy, model.kernel_order), powers(sx, sy, model.background_order)
    varied = parts[1:, None] * places[None]
    return np.concatenate((parts[:1], varied.reshape(-1, *x.shape), ground))


def named(value: object, n: int) -> pd.Series:
    """A name in every row, as objects: strings too can go back to Spark."""
    return pd.Series([value] * n, dtype=object)


def dense(rows: pd.DataFrame, column: str, x0: int, y0: int, width: int, height: int) -> np.ndarray:
    """Missing pixels are NaN."""
    out = np.full((height, width), np.nan)
    out[rows["y"].to_numpy() - y0, rows["x"].to_numpy() - x0] = rows[column].to_numpy(float)
    return out


def convolutions(plane: np.ndarray, images: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The plane convolved with every image where the kernel lies inside, and which of these pixels have no missing one under the kernel."""
    side = images.shape[1]
    shape = tuple(n + side - 1 for n in plane.shape)
    inside = (slice(None), slice(side - 1, plane.shape[0]), slice(side - 1, plane.shape[1]))
    known = np.isfinite(plane)
    spectrum = np.fft.rfft2(np.where(known, plane, 0.0), shape)
    parts = np.fft.irfft2(spectrum * np.fft.rfft2(images, shape), shape)[inside]
    if known.all():
        return parts, np.ones(parts.shape[1:], bool)
    gaps = np.fft.irfft2(np.fft.rfft2(~known * 1.0, shape) * np.fft.rfft2(np.ones((side, side)), shape), shape)[inside[1:]]
    return parts, gaps < 0.5


def tiled(planes: DataFrame, tile: int, margin: int) -> DataFrame:
    """Pixels with the tile (tx, ty) that they lie in, and again with every other one whose margin they lie in."""
    reach = lambda c: F.explode(F.sequence(F.floor((F.col(c) - margin) / tile), F.floor((F.col(c) + margin) / tile)))
    return planes.select("*", reach("x").alias("tx")).select("*", reach("y").alias("ty"))


def stamp_sums(science: DataFrame, template: DataFrame, stamps: DataFrame, model: KernelModel, tile: int = 96) -> DataFrame:
    """(frame, stamp, gram, side, squares, n_pix): the normal equations of each stamp (frame, stamp, cx, cy), made where the tile of its middle is."""
    inputs = science.select("frame", "x", "y", "value", *(F.col(c) if c in science.columns else F.lit(v).alias(c) for c, v in (("noise", 1.0), ("mask", 0))))
    usable = F.col("value").isNotNull() & ~F.isnan("value") & (F.col("noise") > 0) & (F.coalesce("mask", F.lit(0)) == 0)
    weight = F.when(usable, 1 / (F.col("noise") * F.col("noise"))).otherwise(0.0)
    images = tiled(inputs.select("frame", "x", "y", F.when(usable, F.col("value")).otherwise(0.0).alias("value"), weight.alias("weight")), tile, model.stamp_half)
    sides = tiled(template.select("frame", "x", "y", "value", F.lit(None).cast("double").alias("weight")), tile, model.reach)
    work = stamps.select(F.col("frame").alias("own_frame"), F.floor(F.col("cx") / tile).alias("own_tx"), F.floor(F.col("cy") / tile).alias("own_ty"), "stamp", "cx", "cy")

    def of_tile(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(rows):
            basis = basis_images(model.half, model.falloffs, model.degrees)
            x0, y0, half = int(key[1]) * tile, int(key[2]) * tile, model.stamp_half
            width, size = tile + 2 * half, 2 * half + 1
            is_template = rows["weight"].isna()
            around = dense(rows[is_template], "value", x0 - model.reach, y0 - model.reach, tile + 2 * model.reach, tile + 2 * model.reach)
            parts, sound = convolutions(around, basis)
            values, weights = (np.nan_to_num(dense(rows[~is_template], c, x0 - half, y0 - half, width, width)) for c in ("value", "weight"))
            y, x = np.mgrid[y0 - half : y0 - half + width, x0 - half : x0 - half + width].astype(float)
            whole, weights = design(parts, x, y, model), np.where(sound, weights, 0.0)
            for stamp, cx, cy in zip(own["stamp"], own["cx"], own["cy"]):
                at = (slice(int(cy) - y0, int(cy) - y0 + size), slice(int(cx) - x0, int(cx) - x0 + size))
                a, w, v = whole[:, *at].reshape(len(whole), -1), weights[at].ravel(), values[at].ravel()
                aw = a * w
                out.append((stamp, (aw @ a.T).ravel(), aw @ v, float(w @ (v * v)), int((w > 0).sum())))
        stamp, gram, side, squares, n_pix = zip(*out) if out else ([],) * 5
        return pd.DataFrame({"frame": named(key[0], len(out)), "stamp": pd.Series(stamp, dtype=object), "gram": pd.Series(gram, dtype=object), "side": pd.Series(side, dtype=object), "squares": list(squares), "n_pix": list(n_pix)})

    kinds = f"frame {stamps.schema['frame'].dataType.simpleString()}, stamp {stamps.schema['stamp'].dataType.simpleString()}"
    pixels = images.unionByName(sides).groupBy("frame", "tx", "ty").cogroup(work.groupBy("own_frame", "own_tx", "own_ty"))
    return pixels.applyInPandas(of_tile, f"{kinds}, gram array<double>, side array<double>, squares double, n_pix long")


def solve_clipped(gram: np.ndarray, side: np.ndarray, squares: np.ndarray, n_pix: np.ndarray, kappa: float, rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(solution, used stamps, chi2 per pixel) of stacked normal equations; stamps more than kappa deviations worse than the mean are dropped and the rest solved again."""
    used = n_pix > 0
    while True:
        g, b = gram[used].sum(axis=0), side[used].sum(axis=0)
        scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))  # columns of equal length: the rank is judged by direction
        solution = np.linalg.lstsq(g / np.outer(scale, scale), b / scale, rcond=1e-13)[0] / scale
        misfit = squares - 2 * side @ solution + np.einsum("i,sij,j->s", solution, gram, solution)
        merit = np.maximum(misfit, 0.0) / np.maximum(n_pix, 1)
        kept = used & (merit <= merit[used].mean() + kappa * merit[used].std() + 1e-12 * squares.max())
        rounds -= 1
        if rounds <= 0 or kept.sum() == used.sum():
            return solution, used, float(np.maximum(misfit[used].sum(), 0.0) / max(1, n_pix[used].sum()))
        used = kept


def fit_kernels(science: DataFrame, template: DataFrame, stamps: DataFrame, model: KernelModel, kappa: float = 3.0, rounds: int = 5) -> DataFrame:
    """(frame, solution, kernel_sum, chi2, n_used, n_stamps) of each frame with a stamp that has usable pixels."""
    p = n_unknowns(model)

    def of_frame(rows: pd.DataFrame) -> pd.DataFrame:
        gram = np.stack(rows["gram"].to_list()).reshape(-1, p, p)
        solution, used, chi2 = solve_clipped(gram, np.stack(rows["side"].to_list()), rows["squares"].to_numpy(), rows["n_pix"].to_numpy(), kappa, rounds)
        return pd.DataFrame({"frame": named(rows["frame"].iloc[0], 1), "solution": [solution], "kernel_sum": [float(solution[0])], "chi2": [chi2], "n_used": [int(used.sum())], "n_stamps": [len(rows)]})

    sums = stamp_sums(science, template, stamps, model).where("n_pix > 0")
    return sums.groupBy("frame").applyInPandas(of_frame, f"frame {stamps.schema['frame'].dataType.simpleString()}, solution array<double>, kernel_sum double, chi2 double, n_used long, n_stamps long")


def kernel_at(solution: np.ndarray, model: KernelModel, x: float, y: float) -> np.ndarray:
    """The kernel image at a place."""
    images = basis_images(model.half, model.falloffs, model.degrees)
    n = len(monomials(model.kernel_order))
    varied = np.asarray(solution)[1 : 1 + (len(images) - 1) * n].reshape(-1, n) @ powers(np.float64(x / model.width), np.float64(y / model.height), model.kernel_order)
    return np.tensordot(np.concatenate(([solution[0]], varied)), images, axes=1)


def kernel_images(solutions: DataFrame, model: KernelModel, x: float, y: float) -> DataFrame:
    """(frame, kx, ky, weight) of every frame's kernel at one place, kx and ky from its middle."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ky, kx = np.mgrid[-model.half : model.half + 1, -model.half : model.half + 1]
        for part in parts:
            for frame, solution in zip(part["frame"], part["solution"]):
                yield pd.DataFrame({"frame": named(frame, kx.size), "kx": kx.ravel(), "ky": ky.ravel(), "weight": kernel_at(solution, model, x, y).ravel()})

    kind = solutions.schema["frame"].dataType.simpleString()
    return solutions.select("frame", "solution").mapInPandas(run, f"frame {kind}, kx int, ky int, weight double")


def convolve_planes(template: DataFrame, solutions: DataFrame, model: KernelModel, tile: int = 96) -> DataFrame:
    """(frame, x, y, convolved, background): the template under each frame's kernel, where no pixel under the kernel is missing."""
    pixels = tiled(template.select("frame", "x", "y", "value"), tile, model.half)
    work = template.select("frame", F.floor(F.col("x") / tile).alias("tx"), F.floor(F.col("y") / tile).alias("ty")).distinct().join(solutions.select("frame", "solution"), "frame")
    work = work.select(F.col("frame").alias("own_frame"), F.col("tx").alias("own_tx"), F.col("ty").alias("own_ty"), "solution")

    def of_tile(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return pd.DataFrame({"frame": named(None, 0), "x": [], "y": [], "convolved": [], "background": []})
        x0, y0 = int(key[1]) * tile, int(key[2]) * tile
        side = tile + 2 * model.half
        parts, sound = convolutions(dense(rows, "value", x0 - model.half, y0 - model.half, side, side), basis_images(model.half, model.falloffs, model.degrees))
        y, x = np.mgrid[y0 : y0 + tile, x0 : x0 + tile]
        a, s = design(parts, x.astype(float), y.astype(float), model), own["solution"].iloc[0]
        n_ground = len(monomials(model.background_order))
        whole, ground = np.tensordot(s[:-n_ground], a[:-n_ground], axes=1), np.tensordot(s[-n_ground:], a[-n_ground:], axes=1)
        return pd.DataFrame({"frame": named(key[0], int(sound.sum())), "x": x[sound], "y": y[sound], "convolved": whole[sound], "background": ground[sound]})

    kind = template.schema["frame"].dataType.simpleString()
    return pixels.groupBy("frame", "tx", "ty").cogroup(work.groupBy("own_frame", "own_tx", "own_ty")).applyInPandas(of_tile, f"frame {kind}, x long, y long, convolved double, background double")


def subtract(science: DataFrame, convolved: DataFrame) -> DataFrame:
    """Adds diff, convolved and background to the science pixels whose template could be convolved."""
    return science.join(convolved, ["frame", "x", "y"]).withColumn("diff", F.col("value") - F.col("convolved") - F.col("background"))
