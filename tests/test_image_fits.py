"""Kernel fits between images and point-spread fluxes against plain numpy versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import kernel_fit, psf_flux

MODEL = kernel_fit.KernelModel(half=3, falloffs=(0.5, 0.15), degrees=(2, 1), kernel_order=1, background_order=1, stamp_half=5, width=70, height=60)


def rows_of(planes, name="value"):
    return [(f, x, y, float(v)) for f, plane in planes.items() for y, line in enumerate(plane) for x, v in enumerate(line)]


def as_plane(rows, column, nx, ny):
    out = np.full((ny, nx), np.nan)
    for r in rows:
        out[r.y, r.x] = r[column]
    return out


def plain_convolved(template, kernel_of):
    """Pixel by pixel, with the kernel at each."""
    ny, nx = template.shape
    h = MODEL.half
    out = np.full(template.shape, np.nan)
    for y in range(h, ny - h):
        for x in range(h, nx - h):
            k = kernel_of(x, y)
            out[y, x] = sum(k[v + h, u + h] * template[y - v, x - u] for v in range(-h, h + 1) for u in range(-h, h + 1))
    return out


@pytest.fixture(scope="module")
def sky():
    rng = np.random.default_rng(7)
    p = kernel_fit.n_unknowns(MODEL)
    template, truth, science = {}, {}, {}
    for f in (1, 2):
        template[f] = rng.gamma(2.0, 50.0, (60, 70))
        truth[f] = np.concatenate(([1.25 + f / 10], rng.normal(0, 0.05, p - 4), [30.0, 4.0, -6.0]))
        ground = sum(c * (np.arange(70)[None, :] / 70) ** i * (np.arange(60)[:, None] / 60) ** j for c, (i, j) in zip(truth[f][-3:], kernel_fit.monomials(1)))
        science[f] = plain_convolved(template[f], lambda x, y: kernel_fit.kernel_at(truth[f], MODEL, x, y)) + ground
    stamps = [(f, k, 10 + 12 * (k % 5), 10 + 13 * (k // 5)) for f in (1, 2) for k in range(20)]
    return template, science, truth, stamps


def test_basis_images_by_definition():
    images = kernel_fit.basis_images(2, (0.5, 0.2), (1, 2))
    places = [(s, i, j) for s, d in ((0.5, 1), (0.2, 2)) for i in range(d + 1) for j in range(d + 1 - i)]
    assert len(images) == len(places) == 9
    for n, (s, i, j) in enumerate(places):
        plain = np.array([[x**i * y**j * np.exp(-s * (x * x + y * y)) for x in range(-2, 3)] for y in range(-2, 3)])
        if i % 2 == 0 and j % 2 == 0:
            plain = plain / plain.sum() - (images[0] if n else 0)
        assert np.allclose(images[n], plain)
    assert np.allclose(images.sum(axis=(1, 2)), [1] + [0] * 8)


def frames(spark, planes, extra=()):
    return spark.createDataFrame([r for r in rows_of(planes)], "frame long, x long, y long, value double")


def test_a_planted_kernel_comes_back(spark, sky):
    template, science, truth, stamps = sky
    s = frames(spark, science).withColumn("noise", F.lit(2.0)).withColumn("mask", F.when((F.col("x") == 30) & (F.col("y") < 40), 4).otherwise(0))
    s = s.withColumn("value", F.when(F.col("mask") > 0, 1e6).otherwise(F.col("value")))  # wrong, but masked
    s = s.withColumn("value", F.when((F.abs(F.col("x") - 34) < 3) & (F.abs(F.col("y") - 36) < 3), F.col("value") + 4000).otherwise(F.col("value")))  # stamps to be clipped
    fitted = kernel_fit.fit_kernels(s, frames(spark, template), spark.createDataFrame(stamps, "frame long, stamp long, cx long, cy long"), MODEL)
    found = {r.frame: r for r in fitted.collect()}
    for f in (1, 2):
        assert np.allclose(found[f].solution, truth[f], atol=1e-6) and abs(found[f].kernel_sum - truth[f][0]) < 1e-6
        assert found[f].n_stamps == 20 and 15 <= found[f].n_used < 20 and found[f].chi2 < 1e-9
    images = kernel_fit.kernel_images(fitted, MODEL, 20.0, 30.0).collect()
    for f in (1, 2):
        k = kernel_fit.kernel_at(truth[f], MODEL, 20.0, 30.0)
        assert all(abs(r.weight - k[r.ky + 3, r.kx + 3]) < 1e-6 for r in images if r.frame == f) and len(images) == 98


@pytest.mark.parametrize("tile", [16, 23, 96])
def test_convolution_by_tiles(spark, sky, tile):
    template, science, truth, _ = sky
    holed = {f: np.where((np.arange(70)[None, :] == 40) & (np.arange(60)[:, None] == 30), np.nan, p) for f, p in template.items()}
    solutions = spark.createDataFrame([(f, t.tolist()) for f, t in truth.items()], "frame long, solution array<double>")
    found = kernel_fit.convolve_planes(frames(spark, holed), solutions, MODEL, tile).collect()
    near = (abs(np.arange(70)[None, :] - 40) <= 3) & (abs(np.arange(60)[:, None] - 30) <= 3)
    for f in (1, 2):
        plane = as_plane([r for r in found if r.frame == f], "convolved", 70, 60) + as_plane([r for r in found if r.frame == f], "background", 70, 60)
        expected = np.where(near, np.nan, science[f])
        assert np.allclose(plane, expected, atol=1e-8, equal_nan=True)
    assert len(found) == len({(r.frame, r.x, r.y) for r in found})


def test_what_is_left_after_subtraction(spark, sky):
    template, science, truth, stamps = sky
    s = frames(spark, science).withColumn("value", F.col("value") + F.when((F.col("x") == 33) & (F.col("y") == 41), 500.0).otherwise(0.0))
    t, at = frames(spark, template), spark.createDataFrame(stamps, "frame long, stamp long, cx long, cy long")
    masked = s.withColumn("mask", ((F.col("x") == 33) & (F.col("y") == 41)).cast("int"))
    solutions = kernel_fit.fit_kernels(masked, t, at, MODEL)
    left = kernel_fit.subtract(s, kernel_fit.convolve_planes(t, solutions, MODEL)).where(F.abs("diff") > 1e-5).select("frame", "x", "y", F.round("diff", 5)).collect()
    assert sorted(map(tuple, left)) == [(1, 33, 41, 500.0), (2, 33, 41, 500.0)]


def test_frames_with_names(spark, sky):
    template, science, truth, stamps = sky
    name = F.concat(F.lit("frame "), "frame")
    s, t = (frames(spark, {2: p[2]}).withColumn("frame", name) for p in (science, template))
    at = spark.createDataFrame([r for r in stamps if r[0] == 2], "frame long, stamp long, cx long, cy long").withColumns({"frame": name, "stamp": F.col("stamp").cast("string")})
    fitted = kernel_fit.fit_kernels(s, t, at, MODEL)
    assert np.allclose(fitted.first().solution, truth[2], atol=1e-6)
    assert {r.frame for r in kernel_fit.kernel_images(fitted, MODEL, 1, 1).collect()} == {r.frame for r in kernel_fit.convolve_planes(t, fitted, MODEL).collect()} == {"frame 2"}


def test_stamps_without_pixels(spark, sky):
    template, science, _, _ = sky
    at = spark.createDataFrame([(1, 0, -50, -50), (1, 1, 3, 3)], "frame long, stamp long, cx long, cy long")
    assert kernel_fit.fit_kernels(frames(spark, {1: science[1]}).withColumn("mask", F.lit(1)), frames(spark, {1: template[1]}), at, MODEL).isEmpty()
    assert kernel_fit.fit_kernels(frames(spark, science).limit(0), frames(spark, template).limit(0), at, MODEL).isEmpty()


def plain_flux(value, noise, psf, u, v, order, variance):
    a = np.stack([psf] + ([] if order is None else [u**i * v**j for i, j in kernel_fit.monomials(order)]), axis=1)
    w = 1 / noise**2 if variance else 1 / noise
    root = np.sqrt(w)
    solution = np.linalg.lstsq(a * root[:, None], value * root, rcond=None)[0]
    inverse = np.linalg.inv(a.T @ (a * w[:, None]))
    return solution[0], np.sqrt(inverse[0, 0] * (1 if variance else 0.5)), (w * (value - a @ solution) ** 2).sum()


def bell(side, fall=0.08):
    u = np.arange(side) - (side - 1) / 2
    return np.exp(-fall * (u[:, None] ** 2 + 0.7 * u[None, :] ** 2))


@pytest.mark.parametrize("order,variance", [(None, False), (0, True), (3, False)])
def test_flux_equals_least_squares(spark, order, variance):
    rng = np.random.default_rng(3)
    planes = {e: rng.normal(20, 3, (40, 40)) for e in (0, 1)}
    pixels = spark.createDataFrame([(e, x, y, v, float(rng.uniform(0.5, 2))) for e, x, y, v in rows_of(planes)], "epoch long, x long, y long, value double, noise double")
    pixels = pixels.withColumn("value", F.when((F.col("x") == 12) & (F.col("y") == 12), F.lit(None)).otherwise(F.col("value"))).withColumn("noise", F.when(F.col("x") == 14, 0.0).otherwise(F.col("noise")))
    sources = spark.createDataFrame([(7, 12.3, 11.8, bell(23).ravel().tolist()), (8, 25.0, 24.5, bell(23).ravel().tolist()), (9, 100.0, 3.0, bell(23).ravel().tolist()), (10, None, 3.0, None)], "source long, px double, py double, profile array<double>")
    stamps = psf_flux.psf_stamps(sources, "source", 2, 9)
    found = {(r.epoch, r.source): r for r in psf_flux.fit_flux(pixels, stamps, ["epoch", "source"], order, variance).collect()}
    assert set(found) == {(e, s) for e in (0, 1) for s in (7, 8)}
    data = pixels.join(stamps, ["x", "y"]).where("value IS NOT NULL")
    data = (data.where("noise > 0") if variance else data.withColumn("noise", F.when(F.col("noise") > 0, F.col("noise")).otherwise(1.0))).toPandas()
    for (e, s), r in found.items():
        p = data[(data.epoch == e) & (data.source == s)]
        flux, eflux, chi2 = plain_flux(*(p[c].to_numpy() for c in ("value", "noise", "psf", "u", "v")), order, variance)
        assert np.allclose([r.flux, r.eflux, r.chi2], [flux, eflux, chi2], rtol=1e-8) and r.n_pix == len(p)


def test_a_planted_flux_over_a_surface(spark):
    stamps = psf_flux.psf_stamps(spark.createDataFrame([(1, 10.37, 9.81, bell(23).ravel().tolist())], "source long, px double, py double, profile array<double>"), "source", 2, 11)
    pixels = stamps.select(F.lit(0).alias("epoch"), "x", "y", (750.0 * F.col("psf") + 3 + 0.2 * F.col("u") - 0.1 * F.col("v") * F.col("v")).alias("value"), F.lit(1.5).alias("noise"))
    r = psf_flux.fit_flux(pixels, stamps, ["epoch", "source"]).first()
    assert abs(r.flux - 750) < 1e-6 and abs(r.sky - 3) < 1e-6 and r.chi2 < 1e-9
    few = psf_flux.fit_flux(pixels.where("x = 10"), stamps, ["epoch", "source"]).first()
    flat = psf_flux.fit_flux(pixels, stamps.withColumn("psf", F.lit(1.0)), ["epoch", "source"]).first()
    assert few.flux is None and few.n_pix == 11 and flat.flux is None and flat.eflux is None


def plain_located(profile, oversample, column, row, size):
    """Cell by cell."""
    n = len(profile)
    dy, dx = row * oversample - n / 2, column * oversample - n / 2
    fine = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            a, b = i - dy, j - dx
            if 0 <= a <= n - 1 and 0 <= b <= n - 1:
                i0, j0 = int(a), int(b)
                for di, wi in ((0, 1 - (a - i0)), (1, a - i0)):
                    for dj, wj in ((0, 1 - (b - j0)), (1, b - j0)):
                        if wi * wj:
                            fine[i, j] += wi * wj * profile[i0 + di, j0 + dj]
    m = n // oversample
    coarse = np.array([[fine[oversample * i : oversample * i + oversample, oversample * j : oversample * j + oversample].sum() for j in range(m)] for i in range(m)])
    out, start = np.zeros((size, size)), (size - m) // 2
    for i in range(m):
        for j in range(m):
            if 0 <= i + start < size and 0 <= j + start < size:
                out[i + start, j + start] = coarse[i, j]
    return out / out.sum()


@pytest.mark.parametrize("size", [7, 11, 15])
def test_profiles_on_their_pixels(size):
    for column, row in ((5.0, 5.0), (5.3, 4.6), (5.75, 6.2)):
        assert np.allclose(psf_flux.located(bell(23), 2, column, row, size), plain_located(bell(23), 2, column, row, size))
