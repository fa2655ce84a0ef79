"""Forced photometry over epochs and sources against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import forced, pixels, psf_flux, star_profiles


def planes_of(spark, planes, noise=None):
    rows = [(f, x, y, None if np.isnan(v) else float(v), noise) for f, p in planes.items() for y, line in enumerate(p) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, "frame long, x long, y long, value double, noise double")


def plain_aperture(plane, cx, cy, target, inner, outer, noise=None):
    ny, nx = plane.shape
    at = lambda s: [(y, x) for y in range(cy - s // 2, cy + s // 2 + 1) for x in range(cx - s // 2, cx + s // 2 + 1) if 0 <= x < nx and 0 <= y < ny and np.isfinite(plane[y, x])]
    ring = np.array([plane[p] for p in at(outer) if p not in set(at(inner))])
    for _ in range(5):
        ring = ring[np.abs(ring - np.median(ring)) <= 3 * ring.std()]
    flux, sky = sum(plane[p] for p in at(target)), np.median(ring) * target**2
    return flux, sky, flux - sky, ring.std() * target**2 if noise is None else noise * len(at(target)) ** 0.5


PLACES = "frame long, source string, target_x double, target_y double"


def test_a_bright_pixel_on_a_flat_sky(spark):
    plane = np.full((11, 11), 2.0)
    plane[5, 5] = 20.0
    r = forced.aperture_fluxes(planes_of(spark, {1: plane}), spark.createDataFrame([(1, "a", 5.2, 4.8)], PLACES)).first()
    assert (r.flux, r.sky, r.flux_wo_sky, r.eflux, r.n_pix) == (36.0, 18.0, 18.0, 0.0, 9)


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_rings_without_a_pixel_have_no_sky(spark, rounds):
    lit = spark.createDataFrame([(f, x, 5, 3.0) for f, last in ((1, 7), (2, 9)) for x in range(5, last)], "frame long, x long, y long, value double")
    places = spark.createDataFrame([(f, "s", 5.0, 5.0) for f in (1, 2)], PLACES)
    found = {r.frame: r for r in forced.aperture_fluxes(lit, places, rounds=rounds).collect()}
    assert (found[1].flux, found[1].sky, found[1].flux_wo_sky, found[1].eflux, found[1].n_pix) == (6.0, 0.0, 6.0, None, 2)
    assert (found[2].flux, found[2].sky, found[2].flux_wo_sky, found[2].eflux, found[2].n_pix) == (6.0, 27.0, -21.0, 0.0, 2)
    star = spark.createDataFrame([(1, 5, 5)], "k long, rx long, ry long")
    r = pixels.square_photometry(lit.where("frame = 1").drop("frame"), star, "k", 3, 5, 9, rounds=rounds).first()
    assert (r.flux, r.sky, r.flux_wo_sky, r.eflux) == (6.0, None, None, None)


@pytest.mark.parametrize("noise", [None, 1.5])
def test_apertures_by_a_plain_version(spark, noise):
    rng = np.random.default_rng(8)
    planes = {f: rng.normal(10, 2, (30, 40)) + (rng.random((30, 40)) < 0.03) * 200 for f in (1, 2)}
    planes[2][12, 9] = np.nan
    places = [(f, s, x + f / 5, y) for f in (1, 2) for s, x, y in (("a", 10.0, 12.0), ("b", 25.5, 14.5), ("edge", 1.0, 28.0))]
    df = spark.createDataFrame(places + [(1, "lost", None, 3.0), (2, "out", 300.0, 3.0), (3, "no frame", 5.0, 5.0)], PLACES)
    found = {(r.frame, r.source): r for r in forced.aperture_fluxes(planes_of(spark, planes, noise), df, 3, 5, 11).collect()}
    assert set(found) == {(f, s) for f, s, _, _ in places}
    for f, s, x, y in places:
        r = found[f, s]
        assert np.allclose([r.flux, r.sky, r.flux_wo_sky], plain_aperture(planes[f], round(x), round(y), 3, 5, 11)[:3])
        if (f, s) != (2, "a"):  # there a pixel of the target has noise but no value
            assert np.isclose(r.eflux, plain_aperture(planes[f], round(x), round(y), 3, 5, 11, noise)[3])


def test_planted_fluxes_come_back(spark):
    """Sources that move between epochs, under profiles that differ by tile."""
    u = np.arange(23) - 11
    shapes = [np.exp(-k * (u[:, None] ** 2 + u[None, :] ** 2)) for k in (0.06, 0.12)]
    centres = star_profiles.tile_centres(30, 2, 1)
    profiles = spark.createDataFrame([(t, p.ravel().tolist()) for t, p in enumerate(shapes)], "tile int, profile array<double>")
    places = [(f, s, x + 0.13 * f, y - 0.21 * f) for f in range(3) for s, x, y in (("a", 14.0, 15.0), ("b", 45.0, 14.0))]
    df = spark.createDataFrame(places + [(0, "lost", None, None)], PLACES)
    planes = {f: np.full((30, 60), 4.0) + 0.05 * np.arange(60)[None, :] for f in range(3)}
    for f, s, x, y in places:
        ix, iy = int(np.floor(x + 0.5)), int(np.floor(y + 0.5))
        planes[f][iy - 7 : iy + 8, ix - 7 : ix + 8] += (300 if s == "a" else 80 + f) * psf_flux.located(shapes[0 if s == "a" else 1], 2, 7 + x - ix, 7 + y - iy, 15)
    out = {(r.frame, r.source): r for r in forced.forced_photometry(planes_of(spark, planes).withColumn("mask", F.lit(0)), df, profiles, centres).collect()}
    assert len(out) == 7 and out[0, "lost"].psf_flux is None and out[0, "lost"].ap_flux is None
    for f, s, _, _ in places:
        assert abs(out[f, s].psf_flux - (300 if s == "a" else 80 + f)) < 1e-6 and out[f, s].psf_chi2 < 1e-9 and out[f, s].ap_flux > 0
    by_frame = profiles.withColumn("frame", F.lit(1).cast("long"))
    assert {r.frame for r in forced.profile_fluxes(planes_of(spark, planes), df, by_frame, centres).collect()} == {1}
