"""Point-spread flux: each source's flux over a polynomial surface, fitted in every epoch's pixels about it.

The fit is linear, so an epoch and source need only window sums of products, which Spark adds up in its own aggregation; the
small systems are solved in batches.  A source's window has a bounded number of pixels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.kernel_fit import monomials, named


def moved(image: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """The image moved by a part of a pixel, linear between pixels; what comes from beyond its outermost pixels is 0."""
    for axis, shift in ((0, dy), (1, dx)):
        n = image.shape[axis]
        source = np.arange(n) - shift
        low = np.clip(np.floor(source).astype(int), 0, n - 1)
        part = np.where((source >= 0) & (source <= n - 1), source - low, np.nan)
        shape = (-1, 1) if axis == 0 else (1, -1)
        part = part.reshape(shape)
        image = np.nan_to_num((1 - part) * image.take(low, axis) + part * image.take(np.minimum(low + 1, n - 1), axis))
    return image


def block_sums(image: np.ndarray, factor: int) -> np.ndarray:
    h, w = (n // factor * factor for n in image.shape)
    return image[:h, :w].reshape(h // factor, factor, w // factor, factor).sum(axis=(1, 3))


def centred(image: np.ndarray, size: int) -> np.ndarray:
    """Cropped or padded with 0 to a square, about the middle."""
    out = np.zeros((size, size))
    to, of = zip(*(((max(0, (size - n) // 2), max(0, (n - size) // 2))) for n in image.shape))
    span = [min(n, size) for n in image.shape]
    out[to[0] : to[0] + span[0], to[1] : to[1] + span[1]] = image[of[0] : of[0] + span[0], of[1] : of[1] + span[1]]
    return out


def located(profile: np.ndarray, oversample: int, column: float, row: float, size: int) -> np.ndarray:
    """The profile (oversampled, square) on a stamp's own pixels, centred at (column, row), with sum 1."""
    half = profile.shape[0] / 2
    stamp = centred(block_sums(moved(profile, row * oversample - half, column * oversample - half), oversample), size)
    return stamp / stamp.sum() if stamp.sum() > 0 else stamp


def psf_stamps(sources: DataFrame, key: str | Sequence[str], oversample: int, size: int) -> DataFrame:
    """(key, x, y, u, v, psf) of sources (key, px, py, profile): the pixels of a square about each, u and v from its middle.

    `key` is one column or several, such as epoch and source.  `profile` is the flattened square of an oversampled point-spread function.  Pixel centres are at whole coordinates.
    """

    keys = [key] if isinstance(key, str) else list(key)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, u = np.mgrid[:size, :size]
        middle = size / 2 - 0.5
        for part in parts:
            for *names, px, py, profile in part[[*keys, "px", "py", "profile"]].itertuples(index=False):
                side = round(len(profile) ** 0.5)
                ix, iy = int(np.floor(px + 0.5)), int(np.floor(py + 0.5))
                psf = located(np.asarray(profile, float).reshape(side, side), oversample, middle + px - ix, middle + py - iy, size)
                x, y = u + ix - size // 2, v + iy - size // 2
                yield pd.DataFrame({k: named(name, u.size) for k, name in zip(keys, names)} | {"x": x.ravel(), "y": y.ravel(), "u": (u - middle).ravel(), "v": (v - middle).ravel(), "psf": psf.ravel()})

    kinds = ", ".join(f"{k} {sources.schema[k].dataType.simpleString()}" for k in keys)
    known = sources.where("px IS NOT NULL AND py IS NOT NULL AND profile IS NOT NULL").select(*keys, "px", "py", "profile")
    return known.mapInPandas(run, f"{kinds}, x long, y long, u double, v double, psf double")


def fit_flux(pixels: DataFrame, stamps: DataFrame, keys: Sequence[str], order: int | None = 3, variance: bool = False) -> DataFrame:
    """(keys, flux, eflux, sky, chi2, n_pix): `keys` names the epoch of pixels (epoch, x, y, value, noise) and the source of stamps (source, x, y, u, v, psf).

    Stamps that have the epoch as well are that epoch's.  Minimises the sum of squares over the absolute noise, where noise that is unknown,
    infinite or 0 counts as 1, and eflux comes from the inverse of that sum's matrix of second derivatives; with `variance`,
    squares over noise squared and the usual covariance, without pixels whose noise isn't above 0.  `order` None fits no surface; sky is its value at
    the window's middle.  Pixels without a value don't count.  With fewer pixels than unknowns, or where the psf
    can't be told from the surface, flux and eflux are null.
    """
    noise = F.abs(F.col("noise") if "noise" in pixels.columns else F.lit(1.0))
    sound = (noise > 1e-30) & (noise < float("inf"))
    known = F.col("value").isNotNull() & ~F.isnan("value") & F.col("psf").isNotNull()
    if variance:
        known, w = known & sound & (F.col("noise") > 0 if "noise" in pixels.columns else F.lit(True)), 1 / (noise * noise)
    else:
        w = 1 / F.when(sound, noise).otherwise(1.0)
    surface = [] if order is None else [F.pow("u", F.lit(i)) * F.pow("v", F.lit(j)) for i, j in monomials(order)]
    terms: list[Column] = [F.col("psf"), *surface]
    m = len(terms)
    rows = pixels.join(stamps, ["x", "y", *(k for k in keys if k in pixels.columns and k in stamps.columns)]).where(known).withColumn("__w", w).withColumn("__t", F.array(*terms))
    t = lambda i: F.col("__t")[i]
    gram = [F.sum(F.col("__w") * t(i) * t(j)) for i in range(m) for j in range(i + 1)]
    side = [F.sum(F.col("__w") * t(i) * F.col("value")) for i in range(m)]
    sums = rows.groupBy(*keys).agg(F.array(*gram).alias("gram"), F.array(*side).alias("side"), F.sum(F.col("__w") * F.col("value") * F.col("value")).alias("squares"), F.count(F.lit(1)).alias("n_pix"))
    lower = np.tril_indices(m)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            g = np.zeros((len(part), m, m))
            g[:, lower[0], lower[1]] = np.stack(part["gram"].to_list())
            g += np.tril(g, -1).transpose(0, 2, 1)
            b = np.stack(part["side"].to_list())
            length = np.sqrt(np.maximum(np.einsum("kii->ki", g), 1e-300))
            scaled = g / length[:, :, None] / length[:, None, :]
            sound = (part["n_pix"].to_numpy() >= m) & (np.linalg.eigvalsh(scaled)[:, 0] > 1e-12)
            inverse = np.linalg.inv(np.where(sound[:, None, None], scaled, np.eye(m)))
            solution = np.einsum("kij,kj->ki", inverse, b / length) / length
            spread = np.sqrt(inverse[:, 0, 0]) / length[:, 0] * (1.0 if variance else 0.5**0.5)
            left = part["squares"].to_numpy() - np.einsum("ki,ki->k", solution, b)
            out = part[list(keys)].copy()
            for name, values in (("flux", solution[:, 0]), ("eflux", spread), ("sky", solution[:, 1] if m > 1 else np.zeros(len(part))), ("chi2", np.maximum(left, 0.0))):
                out[name] = pd.Series(values, index=out.index).where(sound).astype(object).where(sound, None)
            out["n_pix"] = part["n_pix"]
            yield out

    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(run, f"{kinds}, flux double, eflux double, sky double, chi2 double, n_pix long")
