"""Forced photometry: fluxes at given places in every epoch, whether or not something is seen there.

Pixels are rows (frame, x, y, value) with `noise` and `mask` if they have them, places rows (frame, source, target_x, target_y) as
`manifest.forced_positions` gives them.  Each place is widened to the pixels of its window, which meet the planes by an equality
join on (frame, x, y); a window has a bounded number of pixels, epochs and sources are any number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import psf_flux, star_profiles
from starloom.operators.pixels import _deviation, _median, clipped

KEYS = ["frame", "source"]


def windows(places: DataFrame, half: int) -> DataFrame:
    """(frame, source, x, y, dx, dy) of the squares about the pixel nearest to each place; unknown places have none."""
    span = F.explode(F.sequence(F.lit(-half), F.lit(half)))
    known = places.where("target_x IS NOT NULL AND target_y IS NOT NULL AND NOT isnan(target_x) AND NOT isnan(target_y)")
    at = known.select(*KEYS, F.rint("target_x").cast("long").alias("cx"), F.rint("target_y").cast("long").alias("cy"))
    square = at.withColumn("dx", span).withColumn("dy", span)
    return square.select(*KEYS, (F.col("cx") + F.col("dx")).alias("x"), (F.col("cy") + F.col("dy")).alias("y"), "dx", "dy")


def unmasked(pixels: DataFrame) -> DataFrame:
    """(frame, x, y, value, noise): masked and NaN values are null."""
    bad = F.isnan("value") | (F.coalesce("mask", F.lit(0)) > 0 if "mask" in pixels.columns else F.lit(False))
    noise = F.col("noise").cast("double") if "noise" in pixels.columns else F.lit(None).cast("double")
    return pixels.select("frame", "x", "y", F.when(~bad, F.col("value").cast("double")).alias("value"), noise.alias("noise"))


def aperture_fluxes(pixels: DataFrame, places: DataFrame, target: int = 3, inner: int = 5, outer: int = 9, kappa: float = 3.0, rounds: int = 5) -> DataFrame:
    """(frame, source, flux, sky, flux_wo_sky, eflux, n_pix) over a square of `target` pixels a side.

    sky is the area times the clipped median of the pixels between squares of `inner` and `outer` a side, 0 without any.  eflux
    comes from the noise if it is known in the target, else from the clipped sky's deviation times the area.
    """
    near = unmasked(pixels).join(windows(places, outer // 2), ["frame", "x", "y"])
    within = lambda side: (F.abs("dx") <= side // 2) & (F.abs("dy") <= side // 2)
    inside = lambda c: F.when(within(target), F.col(c))
    rows = near.groupBy(*KEYS).agg(
        F.sum(inside("value")).alias("flux"),
        F.sqrt(F.sum(inside("noise") * inside("noise"))).alias("noise"),
        F.count(inside("value")).alias("n_pix"),
        F.sort_array(F.collect_list(F.when(~within(inner), F.col("value")))).alias("ring"),
    )
    for _ in range(rounds):
        rows = rows.withColumn("ring", clipped("ring", kappa))
    known, area = F.size("ring") > 0, target * target
    sky = F.when(known, _median("ring") * area).otherwise(0.0)
    return rows.select(*KEYS, "flux", sky.alias("sky"), (F.col("flux") - sky).alias("flux_wo_sky"), F.coalesce("noise", F.when(known, _deviation("ring") * area)).alias("eflux"), "n_pix")


def profile_fluxes(
    pixels: DataFrame, places: DataFrame, profiles: DataFrame, centres: Sequence[tuple[float, float]], oversample: int = 2, size: int = 15, order: int | None = 3, variance: bool = False
) -> DataFrame:
    """(frame, source, flux, eflux, sky, chi2, n_pix) by fits of the profile (frame if they have it, tile, profile) of the tile whose centre is nearest."""
    tiled = places.withColumns({"x": F.col("target_x"), "y": F.col("target_y")}).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    tiled = tiled.select(*KEYS, F.col("x").alias("px"), F.col("y").alias("py"), star_profiles.nearest_centre(centres).alias("tile"))
    sources = tiled.join(profiles, ["tile", *(["frame"] if "frame" in profiles.columns else [])])
    return psf_flux.fit_flux(unmasked(pixels), psf_flux.psf_stamps(sources, KEYS, oversample, size), KEYS, order, variance)


def forced_photometry(pixels: DataFrame, places: DataFrame, profiles: DataFrame, centres: Sequence[tuple[float, float]], oversample: int = 2, size: int = 15, order: int | None = 3, aperture: tuple[int, int, int] = (3, 5, 9)) -> DataFrame:
    """One row per place: psf_flux, psf_eflux, psf_chi2 and ap_flux, ap_sky, ap_flux_wo_sky, ap_eflux; null where the place or its pixels are missing."""
    fitted = profile_fluxes(pixels, places, profiles, centres, oversample, size, order).select(*KEYS, *(F.col(c).alias(f"psf_{c}") for c in ("flux", "eflux", "chi2")))
    summed = aperture_fluxes(pixels, places, *aperture).select(*KEYS, *(F.col(c).alias(f"ap_{c}") for c in ("flux", "sky", "flux_wo_sky", "eflux")))
    return places.join(fitted, KEYS, "left").join(summed, KEYS, "left")
