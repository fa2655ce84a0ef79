"""Null keys, optional columns, positions through distorted maps, names by their grammar."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import names, wcs
from starloom.operators import manifest, sequence, stats


def by_key(df, *columns):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(k, float(t), v) for k in ("a", None) for t, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0])] + [("b", 0.0, 7.0), ("b", 1.0, None), ("b", 9.0, 8.0)]
    return spark.createDataFrame(rows, "lo string, t double, v double").withColumns({"hi": F.lit("x"), "median": F.lit(1), "place": F.lit(2), "bin": F.lit(3)})


def test_null_keys_stay(keyed):
    clipped = by_key(stats.sigma_clip_mean(keyed, ["lo"], "v", 1.5), "lo", "clipped_mean", "n")
    assert clipped == {"a": (2.5, 4), None: (2.5, 4), "b": (7.5, 2)}
    scale = by_key(stats.robust_sigma(keyed, ["lo"], "v"), "lo", "median", "sigma")
    assert scale["a"] == scale[None] == (3.0, 1.4826) and scale["b"][0] == 7.5
    assert by_key(stats.quantile(keyed, ["lo"], "v", 0.25), "lo", "median") == {"a": (2.0,), None: (2.0,), "b": (7.25,)}
    kept = stats.one_pass_clip(keyed, ["lo"], "v", 1.5)
    assert {k: kept.where(F.col("lo").eqNullSafe(k)).count() for k in ("a", None, "b")} == {"a": 4, None: 4, "b": 2} and kept.columns == keyed.columns
    bounds = stats.sigma_clip(keyed.drop("lo", "hi").withColumn("k", F.lit(None).cast("int")), ["k"], "v").first()
    assert bounds.k is None and bounds.lo < bounds.hi


def test_gaps_and_frames_of_null_keys(keyed):
    gaps = sequence.gap_segments(keyed.where("t != 2"), ["lo"], "t", "v", 1.5)
    assert sorted((str(r.lo), r.t, r.segment) for r in gaps.collect()) == [("None", 0, 0), ("None", 1, 0), ("None", 3, 1), ("None", 4, 1), ("a", 0, 0), ("a", 1, 0), ("a", 3, 1), ("a", 4, 1), ("b", 0, 0), ("b", 1, 0), ("b", 9, 1)]
    smooth = keyed.withColumn("s", F.when(F.col("lo").isNull(), 0.0).otherwise(F.col("v")))
    chosen = {(r.lo, r.t): r.chosen for r in sequence.frame_fallback(smooth, "lo", "v", "s", 1.0).collect()}
    assert len(chosen) == keyed.count() and all(chosen[None, float(t)] == v for t, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0]))


def test_bins_count_rows_without_values(spark):
    """Two values of four rows: the rule for bins of three rows holds, and clips."""
    rows = [("a", 0.0, 1.0), ("a", 1.0, None), ("a", 2.0, 1.0), ("a", 3.0, 50.0), (None, 0.0, 5.0), (None, 1.0, 9.0), (None, 11.0, None)]
    df = spark.createDataFrame(rows, "k string, t double, v double").withColumn("bin", F.lit("mine"))
    found = {(r.k, r.bin): (r.t_mean, r.v_mean, r.n) for r in stats.binned_clip(df.drop("bin"), ["k"], "t", "v", 10.0, 3.0).collect()}
    assert found == {("a", 0): (1.0, 1.0, 2), (None, 0): (0.5, 7.0, 2), (None, 1): (None, None, 0)}
    vectors = spark.createDataFrame([("a", [1.0, None]), ("a", [3.0, None, 5.0]), (None, [2.0]), (None, None)], "place string, x array<double>")
    out = stats.vector_median(vectors.withColumnRenamed("place", "k"), ["k"], "x")
    assert {(r.k, r.place): r.median for r in out.collect()} == {("a", 0): 2.0, ("a", 1): None, ("a", 2): 5.0, (None, 0): 2.0}


CALIB = "product_id string, kernel_sum double, tess_zp double, pos int"


def test_calibration_of_curves_that_have_columns(spark):
    calib = spark.createDataFrame([("tess111", 0.02, 20.0, 1), ("tess222", 0.03, None, 1)], CALIB)
    curve = spark.createDataFrame([("tess111.fits", 100.0, 10.0), ("tess222.fits", 150.0, 15.0)], "filename string, flux double, eflux double")
    own = curve.withColumns({"kernel_sum": F.when(F.col("flux") == 100, 0.5), "sci_zp": F.lit(1)})
    got = {r.filename: r for r in manifest.calibrate(own, calib, order="pos").collect()}
    assert got["tess111.fits"].kernel_sum == 0.5 and got["tess222.fits"].kernel_sum is None and got["tess222.fits"].flux is None
    assert got["tess111.fits"].kernel_ref == 0.5 and abs(got["tess111.fits"].tess_zp - (25 + 2.5 * math.log10(0.5))) < 1e-9 and "sci_zp" not in got["tess111.fits"].asDict()
    empty = curve.withColumns({"kernel_sum": F.lit(None).cast("double"), "tess_zp": F.lit(None).cast("double")})
    looked = {r.filename: (r.kernel_sum, r.tess_zp) for r in manifest.calibrate(empty, calib, order="pos").collect()}
    assert looked["tess111.fits"] == (0.02, 20.0) and abs(looked["tess222.fits"][1] - (25 + 2.5 * math.log10(0.03))) < 1e-9
    zp = {r.filename: (r.kernel_sum, r.tess_zp) for r in manifest.calibrate(curve.withColumn("tess_zp", F.lit(21.0)), calib, order="pos").collect()}
    assert zp == {"tess111.fits": (0.02, 21.0), "tess222.fits": (0.03, 21.0)}
    again = manifest.calibrate(manifest.calibrate(curve, calib, order="pos"), calib, order="pos")
    assert {(r.flux_uncal, r.eflux_uncal) for r in again.collect()} == {(100.0, 10.0), (150.0, 15.0)}
    assert {round(r.flux, 9) for r in again.collect()} == {125.0}


def test_reference_without_optional_columns(spark):
    rows = [("a", 0.0, 0.0, True), ("b", 0.3, 0.0, True), ("c", 0.1, 0.0, True), ("d", None, 0.0, True), ("e", 0.1, 0.0, False)]
    frames = spark.createDataFrame(rows, "path string, delta_x double, delta_y double, ok boolean")
    chosen = manifest.choose_reference(frames, "path", F.col("ok")).first()
    assert chosen.path == "c" and chosen.tier == 0
    angles = frames.withColumns({"earth_deg": F.when(F.col("path") == "b", "50").otherwise("bad"), "moon_deg": F.lit("30")})
    assert manifest.choose_reference(angles, "path", F.col("ok")).first().path == "b"
    raw = frames.withColumns({"delta_x_raw": F.when(F.col("path") == "a", 0.0).otherwise(5.0), "delta_y_raw": F.lit(0.0)})
    assert manifest.choose_reference(raw, "path", F.col("ok")).first().path == "a"


MAPS = [
    (40.0, 60.0, 1024.0, 1000.0, [-0.0057, 0.0004, 0.0003, 0.0058], [(2, 0, 3e-6), (1, 1, -2e-6), (0, 3, 1e-10)], [(0, 2, -4e-6), (2, 0, 1e-6)]),
    (359.9, -89.0, 10.5, 20.5, [0.005, 0.0, 0.0, 0.005], [], None),
]


def plain_sky(x, y, m):
    ra0, dec0, x0, y0, cd, a, b = m
    u, v = x - x0, y - y0
    u, v = u + sum(c * u**p * v**q for p, q, c in a or []), v + sum(c * u**p * v**q for p, q, c in b or [])
    xi, eta = np.radians(cd[0] * u + cd[1] * v), np.radians(cd[2] * u + cd[3] * v)
    east, north, a0, d0 = xi, eta, np.radians(ra0), np.radians(dec0)
    out = np.array([np.cos(d0) * np.cos(a0), np.cos(d0) * np.sin(a0), np.sin(d0)])
    e, n = np.array([-np.sin(a0), np.cos(a0), 0]), np.array([-np.sin(d0) * np.cos(a0), -np.sin(d0) * np.sin(a0), np.cos(d0)])
    r = out + east * e + north * n
    r = r / np.linalg.norm(r)
    return np.degrees(np.arctan2(r[1], r[0])) % 360, np.degrees(np.arcsin(r[2]))


def test_distorted_maps(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(x), float(y), m) for k, m in enumerate(MAPS) for x, y in rng.uniform(0, 2048, (20, 2))]
    df = spark.createDataFrame(rows, f"k int, x double, y double, m {wcs.SKY_MAP}")
    ra, dec = wcs.pixel_to_sky(F.col("x"), F.col("y"), F.col("m"))
    sky = df.select("*", ra.alias("ra"), dec.alias("dec"))
    back = wcs.sky_to_pixel(F.col("ra"), F.col("dec"), F.col("m"))
    for r in sky.select("*", back[0].alias("bx"), back[1].alias("by")).collect():
        assert np.allclose([r.ra, r.dec], plain_sky(r.x, r.y, MAPS[r.k]), atol=1e-9)
        assert np.allclose([r.bx, r.by], [r.x, r.y], atol=1e-6)
    far = wcs.sky_to_pixel(F.lit(220.0), F.lit(-60.0), F.col("m"))
    assert {r[0] for r in df.where("k = 0").select(far[0]).collect()} == {None}
    assert abs(wcs.separation(0.0, 90.0, 123.0, 90.0)) < 1e-12 and abs(wcs.separation(359.5, 0.0, 0.5, 0.0) - 1) < 1e-12


def test_forced_positions_on_the_sky(spark):
    ra, dec = plain_sky(1100.0, 900.0, MAPS[0])
    rows = [(0, MAPS[0], 500.0, 600.0, True), (1, None, None, 601.0, True), (2, MAPS[0], 502.0, 602.0, False)]
    frames = spark.createDataFrame(rows, f"pos int, sky_map {wcs.SKY_MAP}, x_pix double, y_pix double, ok boolean")
    found = {r.pos: (r.target_x, r.target_y) for r in manifest.forced_positions(frames, "sky", (100.0, 50.0), ra=float(ra), dec=float(dec)).collect()}
    assert np.allclose(found[0], (1000, 850), atol=1e-6) and found[1] == (None, None) and np.allclose(found[2], found[0])
    science = {r.pos: (r.target_x, r.target_y) for r in manifest.forced_positions(frames, "sky", (100.0, 50.0), (float(ra), float(dec)), F.col("ok"), ra=float(ra), dec=float(dec) + 1e-6).collect()}
    assert science == {0: (400.0, 550.0), 1: (None, None), 2: (None, None)}
    away = manifest.forced_positions(frames, "sky", (100.0, 50.0), (float(ra), float(dec)), F.col("ok"), ra=float(ra), dec=float(dec) + 1e-3).where("pos = 0").first()
    assert abs(away.target_y - 850) > 0.01
    fixed = manifest.forced_positions(frames, "fixed", x=3, y=4).first()
    assert (fixed.target_x, fixed.target_y) == (3.0, 4.0)
    with pytest.raises(ValueError):
        manifest.forced_positions(frames, "primary")


def test_template_names(spark):
    good = {
        "sky_template_s0020_3_3_dx-0.000_dy0.010.fits": (20, 3, 3, None, None, None, None, 0.0, 0.01),
        "/d/SKY_Template_S1_2_3_X0-10_Y5-20_os9_dx+.5_dy7.FITS.GZ": (1, 2, 3, 0, 10, 5, 20, 0.5, 7.0),
    }
    bad = ["sky_template_s1_2_3_x0-10_dx0_dy0.fits", "sky_template_s1_2_3_dy0_dx0.fits", "sky_template_s1_2_dx0_dy0.fits", "sky_template_s1_2_3_dx0_dx0_dy0.fits", "sky_template_s1_2_3_dx0_dy0.fit", "sky_templates_s1_2_3_dx0_dy0.fits", "sky_template_s1_2_3_x0_y0-3_dx0_dy0.fits", "sky_template_s1_2_3_dx1.2.3_dy0.fits", "sky_template_s1_2_3_os_dx0_dy0.fits", "9_template_s1_2_3_dx0_dy0.fits", "", None]
    df = spark.createDataFrame([(n,) for n in [*good, *bad]], "name string").select("name", names.template_name(F.col("name")).alias("t"), names.template_name(F.col("name"), "Sky").alias("own"), names.template_name(F.col("name"), "other").alias("other"))
    for r in df.collect():
        assert (None if r.t is None else tuple(r.t)) == good.get(r.name) and r.own == r.t and r.other is None


def test_normalised_targets(spark):
    rows = [("a b", "1", "2", None, None, None), ("c/d", "1", "2", None, None, None), ("e", None, None, "7", "-7", None), ("f", "1", "2", "3", "4", None), ("g", "1", None, None, None, None), ("h", "one", "2", None, None, None), ("i", None, None, "1", "1", None), (" i ", None, None, "2", "2", None), (" ", "1", "2", None, None, None), (None, "1", "2", None, None, None)]
    df = spark.createDataFrame(rows, "name string, ra string, dec string, dx string, dy string, note string")
    found = [(r.name, r.position_mode, r.ra, r.dx, r.problem) for r in manifest.checked_targets(df).collect()]
    assert ("a_b", "sky", 1.0, None, None) in found and ("e", "offset", None, 7.0, None) in found
    wrong = sorted(str(r[4]) for r in found if r[4])
    assert wrong == ["a name must be unique"] * 2 + ["no usable name"] * 3 + ["one of (ra, dec), (dx, dy), (x, y) must be given"] * 2 + ["places must be numbers"]
    good = manifest.normalized_targets(df.where("name IN ('a b', 'e')"))
    assert {r.name for r in good.collect()} == {"a_b", "e"} and "problem" not in good.columns
    with pytest.raises(Exception, match="a name must be unique"):
        manifest.normalized_targets(df.where("trim(name) = 'i'")).collect()
    fixed = manifest.checked_targets(spark.createDataFrame([("p", 1.5, 2.5)], "name string, x double, y double")).first()
    assert (fixed.position_mode, fixed.x, fixed.y, fixed.problem) == ("fixed", 1.5, 2.5, None)


def test_places_of_all_targets_in_all_frames(spark):
    ra, dec = plain_sky(1100.0, 900.0, MAPS[0])
    frames = spark.createDataFrame([(0, 10.0, 20.0, MAPS[0]), (1, 12.0, 22.0, None)], f"frame int, x double, y double, sky_map {wcs.SKY_MAP}")
    entries = spark.createDataFrame([("s", float(ra), float(dec), None, None, None, None), ("o", None, None, 7.0, -7.0, None, None), ("f", None, None, None, None, 3.0, 4.0)], "name string, ra double, dec double, dx double, dy double, x double, y double")
    places = manifest.target_places(frames, manifest.normalized_targets(entries), (100.0, 50.0))
    found = {(r.frame, r.source): (r.target_x, r.target_y) for r in places.collect()}
    assert np.allclose(found.pop((0, "s")), (1000, 850), atol=1e-6)
    assert found == {(1, "s"): (None, None), (0, "o"): (17.0, 13.0), (1, "o"): (19.0, 15.0), (0, "f"): (3.0, 4.0), (1, "f"): (3.0, 4.0)}
    assert manifest.target_places(frames.drop("sky_map"), manifest.normalized_targets(entries)).count() == 6
