"""What SQL can't express: greedy thinning, streams."""

import math
import random

from pyspark.sql import functions as F

import numpy as np
import pytest

from starloom.functions import names, scalars, wcs
from starloom.operators import manifest, pixels, select, sequence, spatial, state, stats
from starloom.sources import catalogues, sinks
from starloom.streaming import gather


def test_greedy_thin(spark):
    rng = random.Random(3)
    points = [(i, rng.randint(0, 60), rng.randint(0, 60), float(rng.randint(0, 9))) for i in range(300)]
    kept = []
    for p in sorted(points, key=lambda p: (-p[3], p[0])):
        if all(math.hypot(p[1] - q[1], p[2] - q[2]) > 5 for q in kept):
            kept.append(p)
    df = spark.createDataFrame(points, "k long, x long, y long, b double")
    found = {r.k for r in spatial.greedy_thin(df, "k", "b", 5.0).collect()}
    assert found == {p[0] for p in kept}
    assert spatial.greedy_thin(df.where("false"), "k", "b", 5.0).count() == 0


def test_nearest_at_any_distance(spark):
    rng = random.Random(4)
    points = [(i, float(rng.randint(-500, 500)), float(rng.randint(-500, 500))) for i in range(80)]
    tiles = [(i, rng.randint(0, 30), rng.randint(0, 30)) for i in range(6)]
    left = spark.createDataFrame([*points, (80, None, 1.0), (81, float("nan"), 1.0)], "k long, x double, y double")
    right = spark.createDataFrame([*tiles, (9, None, None)], "r long, rx long, ry long")
    want = {k: min(tiles, key=lambda t: ((x - t[1]) ** 2 + (y - t[2]) ** 2, t[0]))[0] for k, x, y in points}
    assert {r.k: r.r for r in spatial.nearest(left, right, 5.0, "k", "r").collect()} == {**want, 80: None, 81: None}
    assert {r.r for r in spatial.nearest(left, right.where("false"), 5.0, "k", "r").collect()} == {None}


def test_signed_terms(spark):
    rows = spark.createDataFrame([("a+b-c",), ("-a",), ("a+",), ("",), (None,)], "s string")
    got = [r[0] and [tuple(x) for x in r[0]] for r in rows.select(scalars.signed_terms(F.col("s"))).collect()]
    assert got == [[(1, "a"), (1, "b"), (-1, "c")], [(-1, "a")], None, None, None]


def test_keyed_gather(spark, tmp_path):
    rows = [(1, 1, 2), (1, 1, 2), (1, 2, 2), (2, 1, 3), (2, 3, 3), (3, 1, 1), (3, 1, 1)]
    for i, r in enumerate(rows):  # one file a batch, so that parts of a key come apart
        spark.createDataFrame([r], "k long, part long, wanted long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, part long, wanted long").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = gather.keyed_gather(stream, "k", "part", "wanted", wait_ms=None).writeStream.format("memory").queryName("gathered").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    ended = q.awaitTermination(60)
    q.stop()
    assert ended
    assert sorted(map(tuple, spark.table("gathered").collect())) == [(1, 2, True), (3, 1, True)]


def test_window_counts(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:05:00", "b"), ("2024-01-01 03:00:00", "a")]
    spark.createDataFrame(rows, "ts string, kind string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "in"))
    q = gather.window_counts(stream, "ts", "kind").writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    ended = q.awaitTermination(60)
    q.stop()
    assert ended
    assert sorted((r.start.hour, r.kind, r.n) for r in spark.table("counted").collect()) == [(0, "a", 2), (1, "b", 1)]


def test_terms_with_spaces(spark):
    rows = spark.createDataFrame([("hp_d + hp_b - bkg_temp_smooth",), (" - hp_d + hp_b",), ("a + b )",), ("a b",), ("1a",)], "s string")
    got = [r[0] and [tuple(x) for x in r[0]] for r in rows.select(scalars.signed_terms(F.col("s"))).collect()]
    assert got == [[(1, "hp_d"), (1, "hp_b"), (-1, "bkg_temp_smooth")], [(-1, "hp_d"), (1, "hp_b")], None, None, None]


def test_polygon_boundary(spark):
    corners = [(0, 0), (4, 0), (4, 4), (0, 4)]
    points = [(x / 2, y / 2) for x in range(-1, 10) for y in range(-1, 10)]

    def plain(x, y):
        inside, (x1, y1) = False, corners[0]
        for x2, y2 in [*corners[1:], corners[0]]:
            if min(y1, y2) < y <= max(y1, y2) and x <= max(x1, x2) and (x1 == x2 or x <= (y - y1) * (x2 - x1) / (y2 - y1) + x1):
                inside = not inside
            x1, y1 = x2, y2
        return inside

    df = spark.createDataFrame(points, "x double, y double")
    got = {(r.x, r.y): r.i for r in df.select("x", "y", scalars.in_polygon(F.col("x"), F.col("y"), corners).alias("i")).collect()}
    assert got == {p: plain(*p) for p in points} and any(got.values())


def test_names(spark):
    one = lambda text, f: spark.createDataFrame([(text,)], "s string").select(f(F.col("s")).alias("v")).first().v
    assert one("/a/tess2020019142923-s0020-3-3-0165-s_ffic.fits", names.product_id) == "tess2020019142923"
    assert one("tess111_hp_d.fits.gz", names.strip_fits_suffix) == "tess111_hp_d" and one("x.tar.gz", names.strip_fits_suffix) == "x.tar"
    assert one(".hidden", names.strip_fits_suffix) == ".hidden" and one("a.FITS.GZ", names.is_fits_name) is True
    assert tuple(one("ws/tess111_hp_d.fits", names.parse_workspace_stem)) == ("tess111", "hp_d") and one("hp_d", names.product_id) is None
    t = one("x/sky_template_s0020_3_3_x1068-2092_y1039-2048_dx-0.000_dy0.010.fits", names.template_name)
    assert tuple(t) == (20, 3, 3, 1068, 2092, 1039, 2048, -0.0, 0.01)
    assert tuple(one("sky_template_s0001_1_2_os3_dx.5_dy-1.fits.gz", names.template_name)) == (1, 1, 2, None, None, None, None, 0.5, -1.0)
    assert one("sky_template_s1_dx0_dy0.fits", names.template_name) is None
    assert [tuple(x) for x in one("S44C2D1; S45C1D4", names.coverage)] == [(44, 2, 1), (45, 1, 4)] and one(" ; ", names.coverage) == []
    with pytest.raises(Exception, match="no coverage token"):
        one("S44C2", names.coverage)
    assert tuple(one("20/3/ 3", names.chip)) == (20, 3, 3) and one("20/3", names.chip) is None
    assert one("SN 2020ut ", names.event_name) == "2020ut" and one(None, names.event_name) == "unknown"
    assert one(" a b//", names.light_curve_name) is None and one("__a  (b)_", names.light_curve_name) == "a_b" and one("..", names.light_curve_name) is None
    assert tuple(one("skycell.2556.082", names.cell_id)) == (2556, 8, 2) and one("r_skycell.2556.082.fits", names.cell_name) == "skycell.2556.082"
    df = spark.createDataFrame([(["aaa", "bb", "c" * 12, "d"],), ([],)], "lines array<string>")
    assert [r[0] for r in df.select(names.pack_lines(F.col("lines"), 6)).collect()] == [["aaa\nbb", "c" * 6, "c" * 6, "d"], []]


def test_calibration(spark):
    curve = spark.createDataFrame([("tess111-a.fits", 100.0, 10.0), ("tess222-a.fits", 150.0, 15.0), ("other.fits", 7.0, 1.0)], "filename string, flux double, eflux double")
    calib = spark.createDataFrame([("tess111", 0.02, None, 1), ("tess222", 0.03, None, 1), ("tess111", 9.0, None, 2)], "product_id string, kernel_sum double, tess_zp double, pos int")
    got = {r.filename: r for r in manifest.calibrate(curve, calib, order="pos").collect()}
    a, b = got["tess111-a.fits"], got["tess222-a.fits"]
    assert abs(a.kernel_ref - 0.025) < 1e-12 and abs(a.flux - b.flux) < 1e-9 and a.flux_uncal == 100.0 and got["other.fits"].flux is None
    zp = 25 + 2.5 * math.log10(0.02)
    assert abs(a.tess_zp - zp) < 1e-9 and abs(a.tmag - (zp - 5)) < 1e-9 and abs(a.flux_jy - 2416 * 10 ** (-0.4 * (zp - 5))) < 1e-9
    plain = manifest.calibrate(curve, calib.limit(0), order="pos").collect()
    assert [(r.flux, r.flux_uncal) for r in plain] == [(100.0, 100.0), (150.0, 150.0), (7.0, 7.0)]
    ten = spark.createDataFrame([(0.021,)] * 10 + [(0.5,), (-1.0,), (None,)], "k double")
    assert round(stats.positive_clipped_mean(ten, "k").first().reference, 3) == 0.021
    assert round(spark.range(1).select(scalars.zero_point(F.lit(0.02149))).first()[0], 4) == 20.8306


def test_reference_frame(spark):
    schema = "path string, delta_x double, delta_y double, delta_x_raw double, delta_y_raw double, earth_deg double, moon_deg double, ok boolean"
    pick = lambda rows: manifest.choose_reference(spark.createDataFrame(rows, schema), "path", F.col("ok")).first().path
    rows = [("a", 0.0, 0.0, 0.0, 0.0, 50.0, 30.0, True), ("b", 0.2, 0.0, 1.0, 0.0, 50.0, 30.0, True), ("c", 0.4, 0.0, 0.4, 0.0, 50.0, 30.0, True)]
    assert pick(rows) == "a"  # b is off its raw place, a and c tie
    assert pick([(p, x, 0.0, x, 0.0, e, 30.0, True) for p, x, e in (("a", 0.0, 10.0), ("b", 0.3, 50.0), ("c", 0.1, 10.0))]) == "b"
    moved = manifest.reanchor(spark.createDataFrame([("a", 0.0), ("b", 0.12), ("c", 0.25)], "path string, delta_x double"), ["delta_x"], F.col("path") == "b")
    assert {r.path: round(r.delta_x, 6) for r in moved.collect()} == {"a": -0.12, "b": 0.0, "c": 0.13}


def test_groups_and_templates(spark):
    rows = [(1, 0.0, 0.004, True), (2, 0.02, 0.0, True), (3, 0.001, 0.0, True), (4, None, 0.0, True), (5, 0.02, 0.0, False)]
    got = stats.first_seen_groups(spark.createDataFrame(rows, "pos int, dx double, dy double, ok boolean"), ["pos"], {"dx": 0.01, "dy": 0.01}, F.col("ok"))
    assert {r.pos: r.group_id for r in got.collect()} == {1: 0, 2: 1, 3: 0, 4: -1, 5: -1}
    files = spark.createDataFrame([("t/sky_template_s0020_3_3_dx-0.000_dy0.000.fits",), ("t/sky_template_s0020_3_3_dx0.000_dy0.000.fits.gz",), ("t/readme",)], "path string")
    groups = spark.createDataFrame([(5, 0.0, 0.0), (6, 1.0, 0.0)], "group_id int, group_dx double, group_dy double")
    assert {r.group_id: r.path for r in manifest.match_templates(groups, files, "path", (20, 3, 3)).collect()} == {5: "t/sky_template_s0020_3_3_dx0.000_dy0.000.fits.gz", 6: None}


def test_manifest_lookups(spark):
    frames = spark.createDataFrame([(0, "/a/tess1.fits", 3), (1, "/b/tess1.fits.gz", 4), (2, " ", 5), (3, None, 6)], "pos int, path string, group_id int")
    assert {r.key: r.pos for r in manifest.path_rows(frames, "path", "pos").collect()} == {"/a/tess1.fits": 0, "/b/tess1.fits": 1}
    asked = spark.createDataFrame([("tess1_hp",), ("tess9",)], "id string")
    found = manifest.lookup_first(asked, names.coerced_product_id(F.col("id")), frames, names.coerced_product_id(F.coalesce("path", F.lit(""))), "pos", "group_id", -1)
    assert {r.id: r.group_id for r in found.collect()} == {"tess1_hp": 3, "tess9": -1}
    results = spark.createDataFrame([("tess1", 1, False, "bad"), ("tess1", 2, True, None), ("", 3, True, "x")], "id string, seq int, ok boolean, msg string")
    out = manifest.update_last(frames, names.coerced_product_id(F.coalesce("path", F.lit(""))), results, "id", "seq", {"ok": "hp_ok", "msg": "hp_error"}, {"hp_ok": False, "hp_error": ""})
    assert [(r.pos, r.hp_ok, r.hp_error) for r in out.orderBy("pos").collect()] == [(0, True, ""), (1, True, ""), (2, False, ""), (3, False, "")]
    have = spark.createDataFrame([("/x/1",), ("/y/2",)], "path string")
    asked = spark.createDataFrame([("/x/1", "/y/1"), (None, "/y/2"), ("/x/3", "/y/3")], "a string, b string")
    assert sorted((r.found or "") for r in manifest.ordered_paths(asked, F.col("a"), F.col("b"), have, "path").collect()) == ["", "/x/1", "/y/2"]
    targets = spark.createDataFrame([(20, 3, 3, "2020ut"), (20, 3, 3, "x y"), (21, 1, 1, "z")], "sector int, camera int, ccd int, target_name string")
    assert [r.target_name for r in manifest.find_target(targets, "s0020_c3_k3_x_y").collect()] == ["x y"]
    assert manifest.find_target(targets, "20/3/3").count() == 2 and manifest.find_target(targets, "21,1,1").first().target_name == "z"
    primary = spark.createDataFrame([(10.0, 20.0), (12.0, 22.0)], "x double, y double")
    moved = manifest.forced_positions(primary, "offset", dx=7.0, dy=-7.0).collect()
    assert [(r.target_x, r.target_y) for r in moved] == [(17.0, 13.0), (19.0, 15.0)]


def test_quantiles_of_few_keys(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([None, float("nan"), rng.randint(0, 40) / 4, rng.random()])) for k in "aab" * 400]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    known = {k: np.array([v for j, v in rows if j == k and v is not None and v == v]) for k in "ab"}
    for p in (0.0, 0.05, 0.5, 0.8, 1.0):
        got = {r.k: r.median for r in stats.quantile(df, ["k"], "v", p).collect()}
        assert got.keys() == known.keys() and all(abs(got[k] - np.quantile(known[k], p)) < 1e-12 for k in known)
    got = {r.k: r for r in stats.robust_sigma(df, ["k"], "v").collect()}
    for k, v in known.items():
        assert abs(got[k].sigma - 1.4826 * np.median(abs(v - np.median(v)))) < 1e-9
    flat = spark.createDataFrame([("a", 2.0)] * 5, "k string, v double")
    assert 0 < stats.robust_sigma(flat, ["k"], "v").first().sigma < 1e-11
    assert stats.quantile(df.limit(0), ["k"], "v").count() == 0


def plain_savgol(v, window, order):
    v, out = np.asarray(v, float), np.asarray(v, float).copy()
    size = min(window, len(v) if len(v) % 2 else len(v) - 1)
    if size <= order:
        return out
    for i in range(len(v)):
        first = min(max(i - size // 2, 0), len(v) - size)
        x = np.arange(first, first + size) - i
        out[i] = np.polyval(np.polyfit(x, v[first : first + size], order), 0)
    return out


def test_savgol_by_fits(spark):
    rng = random.Random(6)
    for window, order in ((5, 2), (7, 3), (3, 1)):
        rows = [(n, i, rng.random()) for n in range(1, 12) for i in range(n)]
        got = {(r.k, r.t): r.smooth for r in sequence.savgol(spark.createDataFrame(rows, "k int, t int, v double"), ["k"], "t", "t", "v", window, order).collect()}
        for n in range(1, 12):
            want = plain_savgol([v for k, _, v in rows if k == n], window, order)
            assert np.allclose([got[n, i] for i in range(n)], want)


def test_clipped_savgol(spark):
    v = [math.sin(i / 5) for i in range(60)]
    rows = [("a", float(i + (500 if i >= 30 else 0)), None if i % 9 == 4 else 50.0 if i == 20 else v[i]) for i in range(60)] + [("b", float(i), None) for i in range(3)]
    out = sequence.clipped_savgol(spark.createDataFrame(rows, "k string, t double, v double"), ["k"], "t", "t", "v", 7, 2)
    got = sorted((r.k, r.t, r.segment, r.smooth) for r in out.collect())
    assert [s for k, _, s, _ in got if k == "a"] == [0] * 30 + [1] * 30 and [x for k, *_, x in got if k == "b"] == [0.0] * 3
    assert max(abs(x - v[i]) for i, (*_, x) in enumerate(got[:60])) < 1  # the outlier is gone, gaps are filled


def test_square_photometry(spark):
    plane = [(x, y, 20.0 if (x, y) == (5, 5) else 2.0 + 0.01 * ((x + y) % 2)) for x in range(11) for y in range(11)]
    star = spark.createDataFrame([(1, 5, 5)], "k int, rx int, ry int")
    r = pixels.square_photometry(spark.createDataFrame(plane, "x int, y int, value double"), star, "k", 3, 5, 9).first()
    ring = [v for x, y, v in plane if max(abs(x - 5), abs(y - 5)) in (3, 4)]
    inside = [v for x, y, v in plane if max(abs(x - 5), abs(y - 5)) <= 1]
    assert abs(r.flux - sum(inside)) < 1e-9 and abs(r.sky - 9 * np.median(ring)) < 1e-9 and abs(r.flux_wo_sky - (r.flux - r.sky)) < 1e-12
    assert abs(r.eflux - 9 * np.std(ring)) < 1e-9
    noisy = spark.createDataFrame([(x, y, v, 0.5) for x, y, v in plane], "x int, y int, value double, noise double")
    assert abs(pixels.square_photometry(noisy, star, "k", 3, 5, 9).first().eflux - 1.5) < 1e-9


def test_blocks_and_upsampling(spark):
    plane = spark.createDataFrame([(x, y, float(x + 10 * y)) for x in range(7) for y in range(5)], "x int, y int, value double")
    blocks = pixels.block_reduce(plane, 3, 7, 5)
    assert {(r.bx, r.by): r.mean for r in blocks.collect()} == {(0, 0): 11.0, (1, 0): 14.0}
    up = {(r.x, r.y): r.mean for r in pixels.upsample(blocks, 3, 7, 5, "mean").collect()}
    assert len(up) == 35 and up[6, 4] == 14.0 and up[2, 4] == 11.0


def test_mosaic_takes_the_last_plane(spark):
    planes = spark.createDataFrame([(1, 0, 0, 5.0), (2, 0, 0, 3.0), (3, 0, 0, None)], "plane int, x int, y int, value double")
    assert [r.value for r in pixels.mosaic(planes, {1: (0, 0), 2: (0, 0), 3: (0, 0)}).collect()] == [3.0]


def test_crops_and_grids(spark):
    one = spark.range(1)
    box = lambda mode, *e: one.select(wcs.crop_box(F.lit(100), F.lit(80), F.lit(mode), [F.lit(x).cast("int") for x in e], 4, 6, 10).alias("b")).first().b
    none = (None,) * 4
    assert tuple(box("full", *none)) == (0, 100, 0, 80) and tuple(box("tr", *none)) == (50, 94, 40, 70) and tuple(box("bl", *none)) == (4, 50, 0, 40)
    assert tuple(box("full", None, 30, -5, None)) == (4, 30, 0, 70) and box("full", 60, 30, None, None) is None and box("no", *none) is None
    square = lambda c: one.select(wcs.target_box(F.lit(100), F.lit(80), F.lit(c), F.lit(c), 20).alias("b")).first().b
    assert tuple(square(50)) == (40, 60, 40, 60) and tuple(square(2)) == (0, 20, 0, 20) and tuple(square(79)) == (69, 89, 60, 80)
    points = one.select(F.inline(wcs.grid(2, 1, 2))).collect()
    assert [(r.x, r.y) for r in points] == [(x, y) for y in (-0.25, 0.25) for x in (-0.25, 0.25, 0.75, 1.25)]
    ra, dec = wcs.Tan(200.0, 30.0, 5.0, 5.0, (1, 0, 0, 1), (-0.01, 0.01)).centre(F.lit(10), F.lit(11))
    got = one.select(ra.alias("ra"), dec.alias("dec")).first()
    assert abs(got.ra - 200) < 1e-9 and abs(got.dec - 30) < 1e-9
    before, after = wcs.edge_buffers(F.lit(0), 9.0, 1.0, 5.0)
    assert tuple(one.select(before, after).first()) == (9.0, 1.0)
    cd = one.select(wcs.cd_matrix([F.lit(None).cast("double")] * 4, [F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)], [F.lit(-0.5), F.lit(0.5)], 1.0).alias("m")).first().m
    assert tuple(cd) == (-0.5, 0.0, 0.0, 0.5)


def test_stage_rows_with_holes(spark):
    rows = spark.createDataFrame([("r", "a", "s1", "success", 1), ("r", "a", "s2", "blocked", 1), ("r", "b", "s2", None, None)], "run_id string, target_label string, stage string, status string, attempts int")
    edges = spark.createDataFrame([("s1", "s2")], "before string, after string")
    assert [(r.target_label, r.dependency) for r in state.unmet(rows, edges).collect()] == [("b", "s1")]
    empty = spark.createDataFrame([], "run_id string, target_label string, stage string, artifact_type string, path string")
    active = spark.createDataFrame([("r", "s2")], "run_id string, stage string")
    assert {r.target_label: r.status for r in state.promote(rows, edges, empty, active, "check").where("stage = 's2'").collect()} == {"a": "ready", "b": None}
    assert state.cancel(rows.limit(0), "r", "now").count() == 0
    filled = state.backfill(rows, rows.limit(0), "r", ["s1", "s2", "s3"], ["s3"])
    assert sorted((r.target_label, r.stage, r.status or "") for r in filled.collect()) == [("a", "s1", "success"), ("a", "s2", "blocked"), ("a", "s3", "pending"), ("b", "s1", "external"), ("b", "s2", ""), ("b", "s3", "pending")]


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("sector,camera,ccd,target_ra,target_dec,target_name,enabled\n20,3,3,210.2,81.8, 2020ut ,true\n21,1,1,1.0,2.0,off,no\n22,1,1,1.0,2.0,on,\n")
    got = catalogues.targets(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.sector, r.target_name, r.label) for r in got] == [(20, "2020ut", "s0020_c3_k3_2020ut"), (22, "on", "s0022_c1_k1_on")]
    (tmp_path / "e.csv").write_text("ID,ra,dec,tess_coverage\nSN 2020ut,210.2,81.8,S44C2D1; S45C1D4\n")
    assert [(r.sector, r.target_name) for r in catalogues.targets(spark, str(tmp_path / "e.csv")).collect()] == [(44, "2020ut"), (45, "2020ut")]
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        catalogues.targets(spark, str(tmp_path / "x.csv"))
    (tmp_path / "g.csv").write_text("# note\nsource_id,ra,dec,extra\n1234567890123456789,1.5,,q\n-1,2.5,3.5,q\n")
    stars = catalogues.required(spark, str(tmp_path / "g.csv"), "source_id long, ra double, dec double")
    assert [tuple(r) for r in stars.collect()] == [(1234567890123456789, 1.5, None), (-1, 2.5, 3.5)]
    assert [r.source_id for r in catalogues.unique_stars(stars).collect()] == [1234567890123456789]
    with pytest.raises(ValueError, match="phot"):
        catalogues.required(spark, str(tmp_path / "g.csv"), "source_id long, phot double")
    bright = spark.createDataFrame([("   1 001012.3+123045 5.5",), ("   2 bad              x",), ("   3 235959.9-003000 6.0",)], "value string")
    r = {x.hr: x for x in catalogues.bright_stars(bright).collect()}
    assert set(r) == {1, 3} and abs(r[1].ra - 15 * (10 / 60 + 12.3 / 3600)) < 1e-9 and abs(r[1].dec - (12 + 30 / 60 + 45 / 3600)) < 1e-9 and r[3].dec == -0.5
    out = str(tmp_path / "calib")
    a = spark.createDataFrame([("p1", 1.0), ("p2", 2.0)], "product_id string, kernel_sum double")
    sinks.write_upserted(a, out, ["product_id"])
    sinks.write_upserted(spark.createDataFrame([("p2", 3.0), ("p3", 4.0)], a.schema), out, ["product_id"])
    assert sorted(map(tuple, sinks.latest(spark, out).collect())) == [("p1", 1.0), ("p2", 3.0), ("p3", 4.0)]
    groups = spark.createDataFrame([(1, 0.0, 0.5), (0, 0.0, 0.0), (-1, None, None)], "group_id int, group_dx double, group_dy double")
    sinks.write_handoff(groups, str(tmp_path / "job"), {"sector": 20, "x_min": 0})
    job = catalogues.handoff(spark, str(tmp_path / "job"))
    assert (job.first().sector, [tuple(g) for g in job.first().groups]) == (20, [(0.0, 0.0), (0.0, 0.5)])
    planes = spark.createDataFrame([("f1", 0, 0, 1.0), ("f2", 0, 0, 2.0)], "frame string, x int, y int, value double")
    sinks.write_planes(planes, str(tmp_path / "planes"))
    assert catalogues.planes(spark, str(tmp_path / "planes"), frames=["f2"]).first().value == 2.0
    boxed = catalogues.cropped(spark.createDataFrame([(1, 1, 1.0), (5, 5, 2.0)], "x int, y int, value double"), (4, 8, 4, 8))
    assert [(r.x, r.y) for r in boxed.collect()] == [(1, 1)]
    assert select.keep_one(a, ["product_id"], ["kernel_sum"]).count() == 2


def test_first_valid_wants_enough_rows(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, True)], "k int, ok boolean")
    assert [r.k for r in select.first_valid(df, F.col("ok"), ["k"], 2).orderBy("k").collect()] == [1, 3]
    with pytest.raises(Exception, match="2 valid rows of 3"):
        select.first_valid(df, F.col("ok"), ["k"], 3).collect()


def test_separable_as_the_whole_kernel(spark):
    rng = random.Random(9)
    plane = spark.createDataFrame([(x, y, rng.random()) for x in range(9) for y in range(7) if rng.random() < 0.7], "x int, y int, value double")
    w = [0.2, 0.5, 0.1]
    whole = {(r.x, r.y): r["sum"] for r in pixels.convolve(plane, {(i - 1, j - 1): w[i] * w[j] for i in range(3) for j in range(3)}).collect()}
    parts = {(r.x, r.y): r["sum"] for r in pixels.separable(plane, w).collect()}
    assert whole.keys() == parts.keys() and all(abs(whole[k] - parts[k]) < 1e-12 for k in whole)
    assert abs(sum(pixels.gaussian(1.5)) - 1) < 1e-12


def test_first_seen_and_last_tile(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 7.0), ("b", 1, None)], "k string, i int, v double")
    assert {r.k: (r.first, r.n) for r in select.first_of_group(df, ["k"], ["i"], "v", "first").collect()} == {"a": (7.0, 2), "b": (None, 1)}
    assert {r.k: r.value for r in select.last_wins(df, ["k"], ["i"], "v").collect()} == {"a": 5.0, "b": None}
    assert [(r.i, r.v) for r in select.in_box(df, {"v": (5.0, 7.0)}).collect()] == [(2, 0.0)]
