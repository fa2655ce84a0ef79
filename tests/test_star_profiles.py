"""Profiles fitted on planted stars, and star templates against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import star_profiles


def bell(n, fall=0.12):
    u = np.arange(n) - n // 2
    p = np.exp(-fall * (u[:, None] ** 2 + 0.8 * u[None, :] ** 2)) + 0.02 * (u[None, :] > 0)
    return p / p.sum()


def plain_plane(stars, profile, oversample, nx, ny):
    """Each pixel's sum of the profile, linear between cells, over all stars."""
    n, out = len(profile), np.zeros((ny, nx))
    for sx, sy, flux in stars:
        for y in range(ny):
            for x in range(nx):
                a, b = (y - sy) * oversample + n // 2, (x - sx) * oversample + n // 2
                if 0 <= a <= n - 1 and 0 <= b <= n - 1:
                    i, j = min(int(a), n - 2), min(int(b), n - 2)
                    p, q = a - i, b - j
                    out[y, x] += flux * ((1 - p) * ((1 - q) * profile[i, j] + q * profile[i, j + 1]) + p * ((1 - q) * profile[i + 1, j] + q * profile[i + 1, j + 1]))
    return out


def test_planted_profiles_come_back(spark):
    rng = np.random.default_rng(5)
    nx = ny = 41  # a strip beyond the tiles
    stars = np.column_stack((rng.uniform(-2, 15.5, 60), rng.uniform(-2, 38, 60), rng.uniform(0.2, 1, 60)))
    planes = {f: 900 * plain_plane(stars, bell(9, fall), 2, nx, ny) + 5 + 0.1 * np.arange(nx)[None, :] for f, fall in ((1, 0.12), (2, 0.2))}
    pixels = spark.createDataFrame([(f, x, y, float(p[y, x])) for f, p in planes.items() for y in range(ny) for x in range(nx)], "frame long, x long, y long, value double")
    df = spark.createDataFrame([tuple(map(float, s)) for s in stars], "x double, y double, flux double")
    found = {(r.frame, r.tile): r for r in star_profiles.fit_profiles(pixels, df, nx, ny, 2, 2, oversample=2, n=9).collect()}
    assert set(found) == {(f, t) for f in (1, 2) for t in range(4)}
    for f, fall in ((1, 0.12), (2, 0.2)):
        assert [found[f, t].fitted for t in range(4)] == [True, False, True, False]  # no stars to the right
        for t in (0, 2):
            assert np.allclose(found[f, t].profile, bell(9, fall).ravel(), atol=1e-6)
        middle = np.median([found[f, 0].profile, found[f, 2].profile], axis=0)
        assert np.allclose(found[f, 1].profile, middle) and np.allclose(found[f, 3].profile, middle)
    bad = pixels.withColumn("value", F.when(F.col("x") == 7, -1e9).otherwise(F.col("value")))
    correction = [0.0 if x == 7 else 1.0 + 0.01 * (x % 3) for x in range(nx)]
    again = star_profiles.fit_profiles(bad.where("frame = 1"), df, nx, ny, 2, 2, oversample=2, n=9, correction=correction).where("tile = 0").first()
    assert np.allclose(again.profile, bell(9).ravel(), atol=1e-6)
    assert star_profiles.fit_profiles(pixels, df.limit(2), nx, ny, 2, 2, n=9).isEmpty() and star_profiles.fit_profiles(pixels.limit(0), df, nx, ny, 2, 2, n=9).isEmpty()


def plain_template(stars, profiles, centres, oversample, nx, ny):
    """A canvas of fine cells: each star's profile moved, cut and added, then summed in blocks."""
    canvas = np.zeros((ny * oversample, nx * oversample))
    for x, y, flux in stars:
        if not (0 <= x < nx and 0 <= y < ny):
            continue
        p = profiles[int(np.argmin([np.hypot(x - a, y - b) for a, b in centres]))]
        n = len(p)
        sx, sy = x * oversample - round(x * oversample), y * oversample - round(y * oversample)
        for i in range(n):
            for j in range(n):
                a, b = i - sy, j - sx
                gy, gx = round(y * oversample) - n // 2 + i, round(x * oversample) - n // 2 + j
                if 0 <= a <= n - 1 and 0 <= b <= n - 1 and 0 <= gy < len(canvas) and 0 <= gx < len(canvas[0]):
                    i0, j0 = int(np.floor(a)), int(np.floor(b))
                    i1, j1 = min(i0 + 1, n - 1), min(j0 + 1, n - 1)
                    u, v = a - i0, b - j0
                    canvas[gy, gx] += flux * ((1 - u) * ((1 - v) * p[i0, j0] + v * p[i0, j1]) + u * ((1 - v) * p[i1, j0] + v * p[i1, j1]))
    return canvas.reshape(ny, oversample, nx, oversample).sum(axis=(1, 3))


@pytest.mark.parametrize("oversample,n", [(2, 7), (3, 8)])
def test_templates_by_a_plain_version(spark, oversample, n):
    rng = np.random.default_rng(2)
    stars = [(float(x), float(y), float(f)) for x, y, f in zip(rng.uniform(-3, 23, 40), rng.uniform(-3, 18, 40), rng.uniform(1, 9, 40))] + [(5.0, 5.0, 2.0), (4.25, 4.5, 2.0)]
    centres = star_profiles.tile_centres(10, 2, 2)
    rows = [(g, t, rng.random((n, n))) for g in "ab" for t in range(4)]
    profiles = spark.createDataFrame([(g, t, p.ravel().tolist()) for g, t, p in rows], "grp string, tile int, profile array<double>")
    found = star_profiles.star_template(spark.createDataFrame(stars, "x double, y double, flux double"), profiles, ["grp"], centres, oversample, 20, 15).collect()
    for g in "ab":
        expected = plain_template(stars, [p for h, _, p in rows if h == g], centres, oversample, 20, 15)
        plane = np.zeros((15, 20))
        for r in found:
            if r.grp == g:
                plane[r.y, r.x] = r.value
        assert np.allclose(plane, expected)


def test_finer_profiles(spark):
    p = bell(5)
    assert np.allclose(star_profiles.zoomed(p, 1.0), p)
    fine = star_profiles.zoomed(p, 9 / 2)  # 22.5 cells round to 22, and 23 is odd
    assert fine.shape == (23, 23) and abs(fine.sum() - 1) < 1e-12 and not fine[-1].any()
    linear = star_profiles.zoomed(np.outer(np.ones(3), [1.0, 2.0, 3.0]), 5 / 3)
    assert np.allclose(linear[0] / linear[0, 0], [1, 1.5, 2, 2.5, 3])
    out = star_profiles.finer_profiles(spark.createDataFrame([("a", 0, p.ravel().tolist())], "grp string, tile int, profile array<double>"), 4.5).first()
    assert np.allclose(out.profile, fine.ravel())
